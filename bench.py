"""Headline queries, timed: prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` (default 8) choose data and cores. Each
query runs once untimed on the same data, then ``BENCH_RUNS`` times; the best is reported.
"""

from __future__ import annotations

import json
import os
import sys
import time

from briefloom.plans.queries import QUERIES
from briefloom.session import local_session

HEADLINE = (
    "make_pairs_docs",
    "assemble_dialogue",
    "validate_pairs",
    "split_exact",
    "split_stratified",
    "split_manifest",
    "vocab_top",
    "piece_vocab",
    "encode_inputs",
    "encode_unigram",
    "feature_table",
    "collate_batches",
    "length_profile",
    "lead_k",
    "tfidf_extract",
    "textrank",
    "rouge1",
    "rouge2",
    "rougeL",
    "meteor_exact",
    "bleu_corpus",
    "evaluation_report",
    "csv_roundtrip",
    "zip_ingest",
    "stream_features",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        took = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        seconds[name] = round(min(took[1:] or took), 3)
    print(
        json.dumps(
            {
                "metric": "total of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
