"""Same results whatever the parallelism."""

import pytest

from dvspark.plans import catalog as C

from .conftest import SF_SMALL


@pytest.mark.parametrize("name", ["sat_quote_history", "mart_quotes_backfill", "raw_quotes_first_wins", "mart_fx_rates"])
def test_results_do_not_depend_on_partitioning(spark, name):
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = C.QUERIES[name](spark, SF_SMALL)
            results.append(sorted(tuple(r) for r in df.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1]
