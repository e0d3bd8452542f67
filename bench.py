"""Bench: headline corpus-preparation and metric queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs end to end from the parquet tables and is forced with the ``noop`` sink (full
execution, nothing collected). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "symbol_counts",        # G1: words counted with first occurrence
    "vocab_ids",            # W5/W9: full vocabulary ids without a single-task sort
    "token_positions",      # J1 + W1: encoded stream with global positions
    "windows_fixed",        # W2/W3/G7/F3: training windows
    "bin_sizes",            # G4/G5
    "read_examples",        # bins, slots, masks -> parquet -> read back
    "bpe_roundtrip",        # P6-P10: byte-pair encode + decode
    "ppl_token_weighted",   # G17 + G10
    "context_same_length",  # W7/W8
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tokenloom.plans.queries import clear_corpus_cache, registry
    from tokenloom.session import get_spark

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    qs = registry()
    times = {}
    for k in HEADLINE:
        clear_corpus_cache()  # every query builds its corpus from the tables: end-to-end timing
        t0 = time.time()
        qs[k](spark, sf).write.format("noop").mode("overwrite").save()
        times[k] = round(time.time() - t0, 3)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    n_docs = docs.count()
    total = round(sum(times.values()), 3)
    sfv = sf.rstrip("/").split("sf")[-1]
    print(json.dumps({"metric": "corpus_queries_total", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sfv) if sfv.replace(".", "").isdigit() else sf,
                      "documents": n_docs,
                      "docs_per_sec_encode": round(n_docs / times["token_positions"], 1) if times["token_positions"] else None}))


if __name__ == "__main__":
    main()
