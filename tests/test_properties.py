"""Property: loading load by load (T3 delta) equals one bulk pass (T7), for random histories."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dvspark.operators import vault as V
from dvspark.plans import catalog as C

QUOTE_DDL = (
    "symbol string, open_price decimal(18,6), high_price decimal(18,6), low_price decimal(18,6), "
    "close_price decimal(18,6), volume bigint, trade_date date, source string, loaded_at timestamp_ntz"
)

version = st.tuples(
    st.sampled_from(["A", "B"]),  # instrument
    st.integers(min_value=1, max_value=2),  # trade day
    st.integers(min_value=0, max_value=5),  # load hour
    st.sampled_from(["1", "2"]),  # close: few values, so repeats and flips occur
    st.sampled_from(["s1", "s2"]),  # source: two sources in one load occur
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(version, min_size=1, max_size=12))
def test_incremental_equals_bulk(spark, versions):
    p = Decimal("1.000000")
    data = [
        (sym, p, p, p, Decimal(c), 1, dt.date(2025, 6, day), src, dt.datetime(2025, 6, 10, hour))
        for sym, day, hour, c, src in versions
    ]
    prepared = C.quote_versions(spark.createDataFrame(data, QUOTE_DDL)).select(*C.SAT_QUOTE_COLS)
    schema = prepared.schema
    all_versions = prepared.collect()
    bulk = sorted(tuple(r) for r in V.satellite_history(spark.createDataFrame(all_versions, schema), C.QUOTE_GRAIN).collect())
    stored_rows: list = []
    for load in sorted({r.load_date for r in all_versions}):
        batch = spark.createDataFrame([r for r in all_versions if r.load_date == load], schema)
        stored = spark.createDataFrame(stored_rows, schema) if stored_rows else None
        stored_rows += V.satellite_delta(batch, stored, C.QUOTE_GRAIN).collect()
    assert sorted(tuple(r) for r in stored_rows) == bulk


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(version, min_size=1, max_size=12), st.randoms(use_true_random=False))
def test_loads_in_any_order_equal_bulk(spark, versions, order):
    """Loads that arrive late: the history over the stored rows is that of all versions at once."""
    p = Decimal("1.000000")
    data = [
        (sym, p, p, p, Decimal(c), 1, dt.date(2025, 6, day), src, dt.datetime(2025, 6, 10, hour))
        for sym, day, hour, c, src in versions
    ]
    prepared = C.quote_versions(spark.createDataFrame(data, QUOTE_DDL)).select(*C.SAT_QUOTE_COLS)
    schema, all_versions = prepared.schema, prepared.collect()
    frame = lambda rows: spark.createDataFrame(rows, schema)
    loads = sorted({r.load_date for r in all_versions})
    order.shuffle(loads)
    stored: list = []
    arrived: list = []
    for load in loads:
        batch = [r for r in all_versions if r.load_date == load]
        stored += V.satellite_delta(frame(batch), frame(stored), C.QUOTE_GRAIN, arrivals=frame(arrived)).collect()
        arrived += batch
    seen = V.satellite_history(frame(stored), C.QUOTE_GRAIN).collect()
    bulk = V.satellite_history(frame(all_versions), C.QUOTE_GRAIN).collect()
    assert sorted(map(tuple, seen)) == sorted(map(tuple, bulk))
