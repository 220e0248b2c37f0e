"""Imports every query module so that the registry is complete."""

from __future__ import annotations

from . import benchmark, corpus, language_model, metrics, tokens  # noqa: F401
from .registry import ORACLES, QUERIES

FLAGSHIP = "lm_perplexity"


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in ORACLES.items() if k in QUERIES}
