"""Headline-query bench: one JSON line with wall seconds per query.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=4 python bench.py

Each query runs to completion through the ``noop`` sink (the whole plan is
executed, nothing is collected to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans import catalog  # noqa: E402
from tessera.session import get_session  # noqa: E402

HEADLINE = [
    "lm_unigram_perplexity", "lm_perplexity", "lm_windows", "lm_top_p", "lm_sample_next",
    "index_articles", "article_parse", "attach_content", "sink_jsonl_roundtrip",
    "metric_dispatch", "metric_spearman", "best_run",
    "vocab_top", "encode_docs", "packed_docs", "nli_repair", "split_union_counts",
    "clf_runs", "pad_to_batch", "label_align", "page_links",
    "stream_article_parse", "stream_token_counts",
    "lm_generate_counts", "lm_trigram_perplexity", "lm_outside_scores", "packed_groups", "clf_logistic_runs",
    "page_tags", "archive_pages", "attach_bucketed", "stream_attach",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    names = sys.argv[1:] or HEADLINE
    parts = int(os.environ.get("BENCH_PARTS", str(2 * cpus)))
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=max(1, parts),
                        extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "4g"),
                               # small inputs: keep at least one partition per core after AQE
                               "spark.sql.adaptive.coalescePartitions.minPartitionNum": str(cpus),
                               "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k"})
    qs = catalog.queries()
    # warm-up: JVM start, class loading and the Python workers
    qs["metric_accuracy"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_wall_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
