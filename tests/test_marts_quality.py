import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from dvspark import schemas as S
from dvspark.operators import marts as M
from dvspark.operators import publish as P
from dvspark.operators import quality as Q
from dvspark.plans import catalog as C

QUOTE_DDL = (
    "symbol string, open_price decimal(18,6), high_price decimal(18,6), low_price decimal(18,6), "
    "close_price decimal(18,6), volume bigint, trade_date date, source string, loaded_at timestamp_ntz"
)


def quote(symbol, o, h, low, c, day=dt.date(2025, 6, 6)):
    return (symbol, Decimal(o), Decimal(h), Decimal(low), Decimal(c), 5, day, "alpha_vantage", dt.datetime(2025, 6, 6, 18))


def test_daily_mart_return_zero_open_and_unknown_details(spark):
    raw = spark.createDataFrame([quote("A", "0", "2", "0", "1"), quote("B", "100", "110", "95", "-0.005")], QUOTE_DDL)
    inst = spark.createDataFrame(
        [("B", "Bee Corp", "NYSE", "Stock", "ref", dt.datetime(2025, 1, 1))],
        "symbol string, instrument_name string, exchange string, asset_type string, source string, loaded_at timestamp_ntz",
    )
    mart = {r.instrument_bk: r for r in M.mart_quotes_daily(C.sat_quotes(raw), C.hub_instrument(raw), C.sat_details(inst)).collect()}
    assert mart["A"].daily_return_pct == Decimal("0.0000")  # open 0 -> 0
    assert (mart["A"].instrument_name, mart["A"].exchange, mart["A"].asset_type) == ("Unknown",) * 3
    assert mart["B"].daily_return_pct == Decimal("-100.0050")  # HALF_UP like NUMERIC
    assert mart["B"].price_range == Decimal("15.000000")
    assert mart["B"].instrument_name == "Bee Corp"


def test_round_half_away_from_zero(spark):
    r = spark.range(1).select(M.daily_return_pct(F.lit(Decimal("2.000000")), F.lit(Decimal("1.999999"))).alias("x")).first()
    assert r.x == Decimal("-0.0001")  # -0.00005 rounds away from zero


def test_cross_rates(spark):
    fx = spark.createDataFrame(
        [("RUB", "USD", Decimal("90.5"), dt.date(2025, 6, 6), "cbr"), ("RUB", "EUR", Decimal("98.25"), dt.date(2025, 6, 6), "cbr"),
         ("RUB", "CNY", Decimal("1.25"), dt.date(2025, 6, 7), "cbr")],
        "base_currency string, target_currency string, rate decimal(18,8), rate_date date, source string",
    )
    got = {(r.from_currency, r.to_currency): r.cross_rate for r in M.fx_cross_rates(fx).collect()}
    assert got == {("USD", "EUR"): Decimal("0.92111959"), ("EUR", "USD"): Decimal("1.08563536")}  # same day only


def test_publish_by_date_replaces_and_deletes_empty_day(spark, tmp_dir):
    path = os.path.join(tmp_dir, "mart")
    d1, d2 = dt.date(2025, 6, 5), dt.date(2025, 6, 6)
    df = spark.createDataFrame([("A", d1, 1), ("A", d2, 2), ("B", d2, 3)], "k string, trade_date date, v int")
    P.publish_by_date(df, path, "trade_date")
    P.publish_by_date(df.where("k = 'B'"), path, "trade_date")  # rerun of d2 with one row
    back = P.read_published(spark, path, df.schema)
    assert sorted((r.k, r.v) for r in back.collect()) == [("A", 1), ("B", 3)]
    emptied = P.publish_by_date(df.where("false"), path, "trade_date", dates=[d1])  # d1 now has no rows
    assert emptied == [d1]
    assert sorted((r.k, r.v) for r in P.read_published(spark, path, df.schema).collect()) == [("B", 3)]


def test_upsert_versioned_refresh_log(spark, tmp_dir):
    root = os.path.join(tmp_dir, "log")
    t1, t2 = dt.datetime(2025, 6, 6, 20), dt.datetime(2025, 6, 7, 20)
    first = spark.createDataFrame([("dm_quotes_daily", dt.date(2025, 6, 6), t1), ("dm_fx_rates", dt.date(2025, 6, 6), t1)], S.MART_REFRESH_LOG)
    P.upsert_versioned(spark, root, first, ["mart_name", "execution_date"], "refreshed_at", S.MART_REFRESH_LOG)
    second = spark.createDataFrame([("dm_quotes_daily", dt.date(2025, 6, 6), t2)], S.MART_REFRESH_LOG)
    P.upsert_versioned(spark, root, second, ["mart_name", "execution_date"], "refreshed_at", S.MART_REFRESH_LOG)
    P.upsert_versioned(spark, root, second, ["mart_name", "execution_date"], "refreshed_at", S.MART_REFRESH_LOG)  # idempotent
    got = {r.mart_name: r.refreshed_at for r in P.read_versioned(spark, root, S.MART_REFRESH_LOG).collect()}
    assert got == {"dm_quotes_daily": t2, "dm_fx_rates": t1}


def test_validate_splits_rows_with_reasons(spark):
    raw = spark.createDataFrame(
        [quote("A", "1", "2", "1", "1"), quote("B", "1", "0.5", "1", "1"), quote(None, "1", "2", "1", "1")], QUOTE_DDL
    )
    good, bad = Q.validate(raw, Q.quote_rules())
    assert [r.symbol for r in good.collect()] == ["A"]
    reasons = {r.symbol: r.reason for r in bad.collect()}
    assert reasons == {"B": "high_is_max", None: "symbol_required"}


def test_checks_orphans_duplicates_counts(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    parent = spark.createDataFrame([("a",)], "k string")
    o = Q.orphan_check("c->p", child, "k", parent, "k").first()
    assert (o.child_rows, o.orphan_rows) == (3, 2)
    d = Q.duplicate_check("child", child, ["k"]).first()
    assert (d.rows, d.distinct_keys, d.duplicate_keys) == (3, 2, 1)
    hub = spark.createDataFrame([(dt.datetime(2025, 6, 1, 12),)], "load_date timestamp_ntz")
    sat = spark.createDataFrame([(dt.date(2025, 6, 3),)], "trade_date date")
    got = {r.check_date.day: (r.hub_rows, r.sat_rows, r.status) for r in Q.vault_counts(hub, sat).collect()}
    assert got == {1: (1, 0, "ok"), 2: (0, 0, "skip"), 3: (0, 1, "ok")}


def test_contract_check(spark):
    import pytest

    from dvspark.sources import jdbc

    ok = spark.createDataFrame([("USD", "RUB", Decimal("7.75"), dt.date(2023, 3, 14), "cbr", dt.datetime(2023, 3, 14, 20))], S.DM_FX_RATES)
    assert S.check_contract(ok, S.DM_FX_RATES).columns == [f.name for f in S.DM_FX_RATES.fields]
    with pytest.raises(S.ContractError):
        S.check_contract(ok.withColumn("rate", F.col("rate").cast("double")), S.DM_FX_RATES)
    with pytest.raises(S.ContractError):
        S.check_contract(ok.drop("loaded_at"), S.DM_FX_RATES)
    opts = jdbc.jdbc_options("jdbc:postgresql://db/dwh", "u", "p")
    assert opts["batchsize"] == "1000" and opts["isolationLevel"] == "READ_COMMITTED"
