"""Series cut into blocks give what one window over the whole series gives."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from dvspark.operators import analytics as A
from dvspark.schemas import PRICE


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _days(rng, n, gap):
    day, out = dt.date(2019, 12, 28), []
    for _ in range(n):
        out.append(day)
        day += dt.timedelta(days=rng.randrange(1, gap))
    return out


def test_rates_as_of_over_blocks(spark):
    rng = random.Random(1)
    rows = [("RUB", t, Decimal(rng.randrange(1, 9)), d) for t, n, gap in (("AAA", 300, 3), ("BBB", 12, 200), ("CCC", 1, 2)) for d in _days(rng, n, gap)]
    fx = spark.createDataFrame(rows, "base_currency string, target_currency string, rate decimal(18,8), rate_date date")
    newest, known = max(r[3] for r in rows), {(t, d): (r, d) for _, t, r, d in rows}
    truth = []
    for target in {r[1] for r in rows}:
        day, last = min(r[3] for r in rows if r[1] == target), None
        while day <= newest:
            last = known.get((target, day), last)
            truth.append(("RUB", target, day, *last))
            day += dt.timedelta(days=1)
    for block in (1, 7, 256, 10**6):
        assert _rows(A.rate_as_of(fx, block_days=block)) == sorted(truth, key=repr)


def test_returns_over_blocks(spark):
    rng = random.Random(2)
    rows = [(i, d, Decimal(rng.randrange(0, 40))) for i, n, gap in (("A", 400, 3), ("B", 15, 300), ("C", 1, 2)) for d in _days(rng, n, gap)]
    mart = spark.createDataFrame(rows, "instrument_bk string, trade_date date, close_price decimal(18,6)")
    for window in (1, 2, 5):
        w = Window.partitionBy("instrument_bk").orderBy("trade_date")
        whole = mart.select("instrument_bk", "trade_date", F.lag("close_price").over(w).alias("p"), F.avg("close_price").over(w.rowsBetween(1 - window, 0)).cast(PRICE).alias("m"))
        for block in (1, 7, 256, 10**6):
            got = A.quote_returns(mart, window, block)
            assert _rows(got.select("instrument_bk", "trade_date", "prev_close", f"close_ma{window}")) == _rows(whole)


def test_one_series_is_many_tasks(spark):
    rows = [("A", d, Decimal(1)) for d in _days(random.Random(3), 2000, 2)]
    mart = spark.createDataFrame(rows, "instrument_bk string, trade_date date, close_price decimal(18,6)")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = A.quote_returns(mart, block_days=64).groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(found) >= 3 and sum(r["count"] for r in found) == 2000
