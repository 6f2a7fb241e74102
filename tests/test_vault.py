"""Raw first-wins, hubs, links, satellites: idempotence and equivalence laws."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dvspark import schemas as S
from dvspark.operators import raw as R
from dvspark.operators import vault as V
from dvspark.plans import catalog as C
from dvspark.sources import testviews as tv

from .conftest import SF_SMALL

QUOTE_DDL = (
    "symbol string, open_price decimal(18,6), high_price decimal(18,6), low_price decimal(18,6), "
    "close_price decimal(18,6), volume bigint, trade_date date, source string, loaded_at timestamp_ntz"
)
D = dt.date(2025, 6, 6)


def q(symbol, close, loaded_hour, source="alpha_vantage", volume=10, day=D):
    p = Decimal("1.000000")
    return (symbol, p, p, p, Decimal(close), volume, day, source, dt.datetime(2025, 6, 6, loaded_hour))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_first_wins_in_batch_and_against_target(spark):
    batch = spark.createDataFrame([q("A", "1", 10), q("A", "2", 9), q("B", "1", 9)], QUOTE_DDL)
    first = R.first_wins(batch, S.RAW_QUOTES_KEY)
    assert {(r.symbol, str(r.close_price)) for r in first.collect()} == {("A", "2.000000"), ("B", "1.000000")}
    later = spark.createDataFrame([q("A", "5", 12), q("C", "1", 12)], QUOTE_DDL)
    appended = R.first_wins(later, S.RAW_QUOTES_KEY, existing=first)
    assert [r.symbol for r in appended.collect()] == ["C"]  # a same-source correction is dropped


def test_raw_load_is_idempotent(spark):
    batch = spark.createDataFrame([q("A", "1", 10), q("A", "2", 9), q("B", "1", 9)], QUOTE_DDL)
    once = R.load_raw(batch, S.RAW_QUOTES_KEY)
    twice = R.load_raw(batch, S.RAW_QUOTES_KEY, existing=once)
    assert rows(once) == rows(twice)


def test_last_wins_policy_upserts(spark):
    old = spark.createDataFrame([q("A", "1", 9)], QUOTE_DDL)
    new = spark.createDataFrame([q("A", "3", 11), q("A", "2", 10)], QUOTE_DDL)
    out = R.load_raw(new, S.RAW_QUOTES_KEY, existing=old, policy="last")
    assert [str(r.close_price) for r in out.collect()] == ["3.000000"]


def test_hub_insert_if_absent_one_row_per_key(spark):
    batch = spark.createDataFrame(
        [q("A", "1", 10, source="src_b"), q("A", "1", 10, source="src_a"), q("B", "1", 12)], QUOTE_DDL
    )
    hub = V.load_hub(batch, "symbol", "hub_instrument_hk", "instrument_bk")
    got = {r.instrument_bk: r.record_source for r in hub.collect()}
    assert got == {"A": "src_a", "B": "alpha_vantage"}  # earliest arrival, tie -> smallest source
    again = V.load_hub(batch, "symbol", "hub_instrument_hk", "instrument_bk", existing=hub)
    assert again.count() == 0


def test_link_rejects_null_parts(spark):
    df = spark.createDataFrame(
        [("RUB", "USD", dt.datetime(2025, 1, 1), "cbr"), ("RUB", None, dt.datetime(2025, 1, 1), "cbr")],
        "b string, t string, loaded_at timestamp_ntz, source string",
    )
    links, rejected = V.load_link(df, [("hk_b", "b"), ("hk_t", "t")], "lnk_hk")
    assert links.count() == 1 and rejected.count() == 1
    rev = spark.createDataFrame([("USD", "RUB", dt.datetime(2025, 1, 1), "cbr")], df.schema)
    rlinks, _ = V.load_link(rev, [("hk_b", "b"), ("hk_t", "t")], "lnk_hk")
    assert rlinks.first().lnk_hk != links.first().lnk_hk  # ordered pair


def prepared(spark, data):
    return C.quote_versions(spark.createDataFrame(data, QUOTE_DDL)).select(*C.SAT_QUOTE_COLS)


def test_satellite_delta_unchanged_changed_new(spark):
    existing = prepared(spark, [q("A", "1", 10), q("B", "1", 10)])
    batch = prepared(spark, [q("A", "1", 20), q("B", "2", 20), q("C", "1", 20)])
    delta = V.satellite_delta(batch, existing, C.QUOTE_GRAIN)
    hk = {r.hub_instrument_hk: r.symbol for r in spark.createDataFrame([q(x, "1", 1) for x in "ABC"], QUOTE_DDL)
          .select("symbol", V.hash_key("symbol").alias("hub_instrument_hk")).collect()}
    assert sorted(hk[r.hub_instrument_hk] for r in delta.collect()) == ["B", "C"]
    assert delta.count() == 2  # A unchanged -> 0, B changed -> 1, C new -> 1


def test_satellite_null_attribute_is_hashed_as_null(spark):
    a = spark.createDataFrame([("A", None, D, "s", dt.datetime(2025, 6, 6, 1))], "symbol string, volume bigint, trade_date date, source string, loaded_at timestamp_ntz")
    v = V.prepare_satellite(a, "hk", "symbol", ["volume"])
    import hashlib

    assert v.first().hash_diff == hashlib.md5(b"NULL").hexdigest().upper()


def test_history_collapses_a_b_a_and_two_sources_in_one_load(spark):
    data = [q("A", "1", 1), q("A", "1", 2), q("A", "2", 3), q("A", "1", 4), q("A", "9", 4, source="zzz")]
    hist = V.satellite_history(prepared(spark, data), C.QUOTE_GRAIN)
    got = [(r.load_date.hour, str(r.close_price)) for r in hist.orderBy("load_date").collect()]
    assert got == [(1, "1.000000"), (3, "2.000000"), (4, "1.000000")]


def test_incremental_equals_bulk_history(spark):
    """Equivalence law: loading batch by batch (T4) = one bulk pass."""
    raw = tv.raw_quotes(spark, SF_SMALL).where(F.col("trade_date") <= "2024-01-04")
    versions = C.quote_versions(raw).select(*C.SAT_QUOTE_COLS)
    bulk = V.satellite_history(versions, C.QUOTE_GRAIN)
    loads = sorted(r.load_date for r in versions.select("load_date").distinct().collect())
    sat = None
    for ld in loads:
        batch = versions.where(F.col("load_date") == F.lit(ld).cast("timestamp_ntz"))
        delta = V.satellite_delta(batch, sat, C.QUOTE_GRAIN)
        sat = delta if sat is None else sat.unionByName(delta)
        sat = sat.checkpoint()  # cut the growing lineage, as a long-running loader would
    assert rows(sat.select(*C.SAT_QUOTE_COLS)) == rows(bulk.select(*C.SAT_QUOTE_COLS))


def test_scd2_end_dates(spark):
    inst = spark.createDataFrame(
        [
            ("A", "Apple", "NASDAQ", "Stock", "ref", dt.datetime(2025, 1, 1)),
            ("A", "Apple Inc", "NASDAQ", "Stock", "ref", dt.datetime(2025, 2, 1)),
            ("A", "Apple Inc", "NASDAQ", "Stock", "ref", dt.datetime(2025, 3, 1)),
        ],
        "symbol string, instrument_name string, exchange string, asset_type string, source string, loaded_at timestamp_ntz",
    )
    out = C.sat_details(inst).orderBy("load_date").collect()
    assert [(r.instrument_name, r.load_end_date) for r in out] == [
        ("Apple", dt.datetime(2025, 2, 1)),
        ("Apple Inc", None),
    ]


@pytest.mark.parametrize("keep_ties,expected", [(True, 2), (False, 1)])
def test_latest_version_ties(spark, keep_ties, expected):
    sat = prepared(spark, [q("A", "1", 5), q("A", "2", 5, source="other"), q("A", "3", 1)])
    assert V.latest_version(sat, C.QUOTE_GRAIN, keep_ties=keep_ties).count() == expected


def test_point_in_time_version(spark):
    sat = prepared(spark, [q("A", "1", 5), q("A", "2", 9)])
    pit = V.latest_version(sat, C.QUOTE_GRAIN, as_of=F.lit("2025-06-06 06:00:00").cast("timestamp_ntz"))
    assert [str(r.close_price) for r in pit.collect()] == ["1.000000"]


def test_late_arrival_is_compared_with_its_true_predecessor(spark):
    stored = V.satellite_history(prepared(spark, [q("A", "1", 1), q("A", "2", 5)]), C.QUOTE_GRAIN)
    late_same_as_t1 = prepared(spark, [q("A", "1", 3)])  # between t1 and t5, equal to t1 -> nothing new
    assert V.satellite_delta(late_same_as_t1, stored, C.QUOTE_GRAIN).count() == 0
    late_new = prepared(spark, [q("A", "7", 3)])  # differs from t1 (its predecessor) -> new version
    assert [str(r.close_price) for r in V.satellite_delta(late_new, stored, C.QUOTE_GRAIN).collect()] == ["7.000000"]
    resent = prepared(spark, [q("A", "9", 5)])  # same load_date as a stored version: stored wins
    assert V.satellite_delta(resent, stored, C.QUOTE_GRAIN).count() == 0
