"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores.
Every query warms up on the sibling sf0.001 tables where they exist, then runs once for the clock;
results go to a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time

from murmura.session import local_session
from murmura.suite import CATALOG
from murmura.suite import search as search_suite

HEADLINES = [
    "p10_words",
    "p14_clean_text",
    "f4_tag_topics",
    "f6_opinion_filter",
    "s5_upsert",
    "s11_limit_per_community",
    "a5_top_words",
    "a7_histogram",
    "a9_corpus_profile",
    "n1_compound",
    "n2_polarity",
    "q4_match_term",
    "q7_match_phrase",
    "q11_search_topk",
    "q12_search_page",
    "q14_query_batch",
    "q15_answers",
    "j1_attach_labels",
    "j2_fuse_keywords",
    "a14_weighted_metrics",
    "m6_tfidf",
    "m14_davies_bouldin",
    "m15_cosine_topk",
    "m18_label_comments",
    "w6_build_vocab",
    "w7_early_stop",
    "t1_encode",
    "w9_sample_n",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, int(cores) if cores.isdigit() else 8, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1].split(",") if len(sys.argv) > 1 else HEADLINES
    rows = spark.read.parquet(f"{folder}/documents.parquet").count()
    sibling = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    warm = sibling if os.path.isdir(sibling) else folder
    search_suite.index(spark, warm)
    start = time.time()
    search_suite.index(spark, folder)
    seconds = {"index_build": round(time.time() - start, 3)}
    for name in names:
        query = CATALOG[name][0]
        run(query(spark, warm))
        start = time.time()
        run(query(spark, folder))
        seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    rates = {name: round(rows / s, 1) for name, s in seconds.items() if s > 0}
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "documents_per_second": rates, "sf": scale}))


if __name__ == "__main__":
    main()
