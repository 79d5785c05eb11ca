"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from docintake.plans.queries import QUERIES  # noqa: E402
from docintake.session import local_session  # noqa: E402

HEADLINE = (
    "claim_batch",
    "claim_apply",
    "merge_patch",
    "link_state",
    "event_outcomes",
    "archive_on_download",
    "reconcile_downloads",
    "retry_sweeps",
    "score_documents",
    "title_page_top3",
    "title_page_text",
    "parse_tags",
    "tag_resolve",
    "tag_all",
    "label_ingest",
    "stream_link_state",
    "big_claim",
    "big_link_state",
    "big_event_outcomes",
    "big_reconcile",
    "big_retry_sweeps",
    "big_retry_candidates",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("docintake-bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up of the session is not a query.
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
