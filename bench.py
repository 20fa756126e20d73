"""Times headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder and ``BENCH_CPUS`` the number of local threads. Every
query runs to completion into the no-op sink. ``queries`` holds the first run of each query
after a common warm-up of the session.
"""

from __future__ import annotations

import json
import os
import sys
import time

from folianta.plans import registry
from folianta.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "prepare_corpus", "three_way_split", "corpus_records", "convert_wide_records",
    "scan_records_xml", "html_meta", "extract_links", "fold_text", "pre_tokenize",
    "word_counts", "pair_counts", "bpe_vocab", "bpe_encode", "unigram_vocab",
    "token_vectors", "occurrence_pairs", "input_embedding", "layer_norm", "pca_project",
    "truncated_svd", "feed_forward", "eval_global", "class_report", "batch_predict",
    "run_summary", "run_summary_by_epoch", "latest_records", "incremental_ingest",
    "assign_batches", "group_values",
]


def main() -> None:
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "folianta-bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    spark.read.parquet(f"{SF_DIR}/documents.parquet").groupBy("lang").count().collect()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
