"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query
runs to its last row into a sink that keeps nothing; the best of two runs
counts, and the first two queries only warm the session up.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tiltwatch.config import work_folder  # noqa: E402
from tiltwatch.plans import reports as R  # noqa: E402
from tiltwatch.plans.catalog import all_queries, trained  # noqa: E402
from tiltwatch.session import build_session  # noqa: E402
from tiltwatch.sources import star  # noqa: E402
from tiltwatch.sources.layout import compact_files  # noqa: E402

HEADLINE = (
    "toxic_vs_labelled",
    "messages_per_label",
    "union_of_counts",
    "label_count_histogram",
    "match_share_per_label",
    "toxic_timeline",
    "union_of_times",
    "toxic_in_ranges",
    "region_activity",
    "region_activity_authored",
    "toxic_regions_top5",
    "messages_per_account",
    "toxic_players_top10",
    "prepared_labels",
    "train_validation_split",
    "multilabel_document_scores",
    "document_tokens",
    "sentence_vectors",
    "batch_scoring",
    "stream_scoring",
    "classified_documents",
    "classifier_quality",
)


def run(make) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "tiltwatch-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    for name in HEADLINE[:2]:
        run(lambda: queries[name](spark, folder))
    times = {}
    for name in HEADLINE:
        if name == "classified_documents":
            # The fit is kept for the session, so it is timed by itself.
            start = time.perf_counter()
            trained(spark, folder)
            times["classifier_fit"] = time.perf_counter() - start
        times[name] = min(run(lambda: queries[name](spark, folder)) for _ in range(2))

    # The same report on 5000 small files and after compaction.
    loose, tight = work_folder(spark, "loose"), work_folder(spark, "tight")
    star.chat_pred(spark, folder).repartition(5000).write.parquet(loose)
    times["fragmented_toxic_vs_labelled"] = run(
        lambda: R.toxic_vs_labelled(spark.read.parquet(loose))
    )
    start = time.perf_counter()
    compact_files(spark, loose, tight)
    times["compaction"] = time.perf_counter() - start
    times["compacted_toxic_vs_labelled"] = run(
        lambda: R.toxic_vs_labelled(spark.read.parquet(tight))
    )
    times = {name: round(seconds, 3) for name, seconds in times.items()}
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").rpartition("sf")[2],
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
