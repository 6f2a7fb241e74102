"""Bench: headline catalog queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected to the driver); the best of ``BENCH_REPEAT``
runs is reported.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dvspark.plans import catalog  # noqa: E402
from dvspark.session import build_session  # noqa: E402

HEADLINE = [
    "hash_diff",
    "raw_quotes_first_wins",
    "sat_quote_history",
    "sat_delta",
    "sat_quote_prices",
    "mart_quotes_daily",
    "mart_quotes_backfill",
    "mart_fx_rates",
    "fx_cross_rates",
    "vault_duplicates",
    "parse_quotes_json",
    "vault_orphans",
    "publish_by_date",
    "sat_late_arrival",
    "stream_raw_quotes",
    "stream_sat_delta",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 2) * 2, app="dvspark-bench")
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()  # JVM / reader warm-up, not timed
    times = {}
    from dvspark.sources import testviews

    t0 = time.perf_counter()
    testviews.land_all(spark, sf_dir)  # the raw layer, written once like landed files
    times["land_raw"] = round(time.perf_counter() - t0, 3)
    for name in names:
        times[name] = round(min(run(spark, name, sf_dir) for _ in range(repeat)), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
