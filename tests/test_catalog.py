"""Every catalog query against its DuckDB oracle (sf0.001), plus plan checks."""

import pytest

from dvspark.plans import catalog as C

from .compare import compare, duck
from .conftest import SF_SMALL

STREAMS = {n for n in C.QUERIES if n.startswith("stream_")}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(C.ORACLE) == set(C.QUERIES)


@pytest.mark.parametrize("name", sorted(C.QUERIES))
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, con, name, C.QUERIES[name], C.ORACLE[name], SF_SMALL)
    assert info["ok"], info


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(C.QUERIES) - STREAMS - {"publish_by_date", "mart_refresh_log", "warehouse_end_to_end"}))
def test_no_python_in_plans(spark, name):
    plan = _plan(C.QUERIES[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
        assert bad not in plan, (name, bad)


def test_satellite_history_single_exchange(spark):
    from dvspark.sources import testviews as tv

    raw = tv.raw_quotes(spark, SF_SMALL)
    versions = C.quote_versions(raw).select(*C.SAT_QUOTE_COLS)
    # the versions input itself is one aggregation exchange; history adds exactly one more
    base = _plan(versions).count("Exchange hashpartitioning")
    hist = _plan(C.V.satellite_history(versions, C.QUOTE_GRAIN)).count("Exchange hashpartitioning")
    assert hist - base == 1


def test_latest_uses_group_limit(spark):
    sat = C.sat_quotes(C.tv.raw_quotes(spark, SF_SMALL))
    text = C.V.latest_version(sat, C.QUOTE_GRAIN)._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in text


def test_first_wins_limits_before_the_shuffle(spark):
    from dvspark import schemas as S
    from dvspark.operators import raw as R

    raw = C.tv.raw_quotes(spark, SF_SMALL)
    plan = _plan(R.first_wins(raw.unionByName(raw), S.RAW_QUOTES_KEY))
    below_exchange = plan.split("Exchange hashpartitioning(symbol")[1]
    assert "WindowGroupLimit" in below_exchange  # partial top-1 runs map-side


def test_dated_scans_push_filters_to_parquet(spark):
    from pyspark.sql import functions as F

    from dvspark.sources import testviews as tv

    day = F.lit("2024-01-05").cast("date")
    # derived from events: the date filter becomes a pushed range on ts
    derived = _plan(tv.derive_raw_quotes(spark, SF_SMALL).where(F.col("trade_date") == day))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in derived
    # landed raw table: the equality reaches the scan
    landed = _plan(tv.raw_quotes(spark, SF_SMALL).where(F.col("trade_date") == day).select("symbol", "close_price"))
    assert "PartitionFilters: [isnotnull(trade_date" in landed and "= 2024-01-05" in landed.split("PartitionFilters:")[1]
    assert "ReadSchema: struct<symbol:string,close_price:decimal(18,6)>" in landed
