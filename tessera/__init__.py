"""tessera: a Spark-native library for building text corpora and evaluating
language models and classifiers on them.  Every operator is a plain function
``DataFrame -> DataFrame`` or ``Column -> Column``."""

__version__ = "0.1.0"
