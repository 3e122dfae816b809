"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` picks the tables, ``BENCH_CPUS`` the local threads. Every query runs once
on whole tables after a warm-up of two of them and is written to Spark's no-op sink, so all rows
and columns are computed.
"""

from __future__ import annotations

import json
import os
import re
import time

from catalog.fixtures import view
from catalog.queries import QUERIES
from rollcall import session

HEADLINE = [
    "match_mapping",
    "match_steps",
    "new_ids",
    "publish_rows",
    "publish_batches",
    "batch_payload",
    "publish_quarantine",
    "collapse_source",
    "range_records",
    "upsert_overwrite",
    "upsert_normal",
    "dup_verdicts",
    "dup_cross_source",
    "intake_accepted",
    "intake_rejects",
    "crosswalk_filled",
    "provider_npi",
    "dict_merge",
    "audit_name_mismatch",
    "verified_lookup",
    "alert_schedule",
    "alert_reset",
    "file_manifest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session.build(
        "rollcall-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("match_mapping", "crosswalk_filled"):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)

    records = view(spark, sf_dir, "fx_source").count()
    sync = times["match_mapping"] + times["publish_rows"]
    sf = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf.group(1)) if sf else None,
                "source_records": records,
                "sync_records_per_sec": round(records / sync, 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
