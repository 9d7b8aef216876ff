"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local threads. Each job runs once
to warm up and then twice; the better time counts. ``compared`` holds the ways
not taken, on the same data.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame

from gaugeworks.operators import quality as Q
from gaugeworks.operators.nearest import nearest_site
from gaugeworks.plans import adapters as A
from gaugeworks.plans import registry
from gaugeworks.session import local_session, materialise

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Registered queries, as the driver runs them.
HEADLINE = (
    "typed_clean",
    "dedup_by_key",
    "site_normalise",
    "nearest_site",
    "nearest_site_grid",
    "constraint_pk",
    "constraint_fk",
    "audit_report",
    "repair_metadata",
    "repair_actions",
    "insert_if_absent",
    "upsert_update",
    "profile_columns",
    "throughput_rate_sliding",
    "latest_n",
    "stream_enrich",
)


def timed(job) -> float:
    best = float("inf")
    for run in range(3):
        start = time.perf_counter()
        result = job()
        if isinstance(result, DataFrame):
            result.write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - start
        if run:
            best = min(best, took)
    return round(best, 3)


def scan_per_rule(events: DataFrame, sensor: DataFrame) -> DataFrame:
    """The audit as a union with one scan per control."""
    report = Q.audit_rule(events, sensor, next(iter(Q.CONTROLS)))
    for key in list(Q.CONTROLS)[1:]:
        report = report.unionByName(Q.audit_rule(events, sensor, key))
    return report


def main() -> None:
    spark = local_session("bench", cpus=CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    times = {
        name: timed(lambda name=name: registry.QUERIES[name](spark, SF_DIR)) for name in HEADLINE
    }
    stored = materialise(A.weather(spark, SF_DIR), "bench-weather")
    sites = materialise(A.canonical(spark, SF_DIR), "bench-sites")
    events = materialise(A.positioned(spark, SF_DIR), "bench-events")
    short = materialise(A.short_sites(spark, SF_DIR), "bench-short")
    times["stored_audit"] = timed(lambda: Q.audit(stored, sites))
    times["stored_repair"] = timed(lambda: Q.repair(stored, sites))
    compared = {
        "stored_audit_scan_per_rule": timed(lambda: scan_per_rule(stored, sites)),
        "short_list_auto": timed(lambda: nearest_site(events, short)),
        "short_list_packed": timed(lambda: nearest_site(events, short, strategy="packed")),
        "long_list_packed_shuffled": timed(
            lambda: nearest_site(
                events, sites, strategy="packed", broadcast_nodes=0, broadcast_rows=0
            )
        ),
    }
    line = {
        "metric": "headline query seconds, total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "compared": compared,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS,
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
