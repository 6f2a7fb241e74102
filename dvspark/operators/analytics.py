"""Extension analytics over the marts.

Series (a currency pair's or an instrument's days) are cut into blocks of
``BLOCK_DAYS`` calendar days.  Windows run inside (series, block), so one long
series is many tasks; what a block needs of the days before it, a few rows, is
carried in from the blocks' summaries, one or a few rows a block.  Top-k per day
is planned with a partial ``WindowGroupLimit`` before the shuffle, so a crowded
day is cut to k rows per map task first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dvspark.operators import vault as V
from dvspark.schemas import PRICE, RETURN_PCT

#: Calendar days of a block of a series.
BLOCK_DAYS = 256


def _block(day, days: int) -> Column:
    return F.floor(F.unix_date(day) / days).cast("int")


def rate_as_of(fx: DataFrame, pair: Sequence[str] = ("base_currency", "target_currency"), until: Column | None = None, block_days: int = BLOCK_DAYS) -> DataFrame:
    """For every day from a pair's first rate to ``until`` (default: newest
    rate day overall), the last known rate on or before that day.

    A block's days are listed in the block's own task, beside its rates; the
    last rate of the blocks before it is carried in.
    """
    pair = list(pair)
    newest = fx.select(F.max("rate_date")).scalar() if until is None else until
    known = fx.select(*pair, F.col("rate_date").alias("as_of_date"), F.struct(F.col("rate_date"), F.col("rate")).alias("_known"), _block(F.col("rate_date"), block_days).alias("_block"))
    bounds = fx.groupBy(*pair).agg(F.min("rate_date").alias("_lo")).withColumn("_hi", newest)
    blocks = bounds.withColumn("_block", F.explode(F.sequence(_block(F.col("_lo"), block_days), _block(F.col("_hi"), block_days))))
    last = known.groupBy(*pair, "_block").agg(F.max("_known").alias("_last"))
    before = Window.partitionBy(*pair).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.join(last, [*pair, "_block"], "left").withColumn("_carried", F.last("_last", ignorenulls=True).over(before))
    first, end = F.date_from_unix_date(F.col("_block") * block_days), F.date_from_unix_date((F.col("_block") + 1) * block_days - 1)
    days = blocks.repartition(*pair, "_block").select(*pair, "_block", "_carried", F.explode(F.sequence(F.greatest("_lo", first), F.least("_hi", end))).alias("as_of_date"))
    nothing = lambda name: F.lit(None).cast(known.schema["_known"].dataType).alias(name)
    rows = days.select(*pair, "_block", "as_of_date", "_carried", nothing("_known"), F.lit(True).alias("_day"))
    rows = rows.unionByName(known.select(*pair, "_block", "as_of_date", nothing("_carried"), "_known", F.lit(False).alias("_day")))
    w = Window.partitionBy(*pair, "_block").orderBy("as_of_date", "_day").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_at", F.coalesce(F.last("_known", ignorenulls=True).over(w), "_carried")).where("_day")
    return found.select(*pair, "as_of_date", F.col("_at.rate").alias("rate"), F.col("_at.rate_date").alias("rate_date"))


def quote_returns(mart: DataFrame, window: int = 5, block_days: int = BLOCK_DAYS) -> DataFrame:
    """Day-over-day close return (%) and a ``window``-row moving average of close.

    The last ``window - 1`` rows of a block (one at least) are what blocks
    behind it may need; a block takes the last ones of all blocks before.
    """
    reach = max(1, window - 1)
    rows = mart.select("instrument_bk", "trade_date", "close_price", _block(F.col("trade_date"), block_days).alias("_block"))
    tail = Window.partitionBy("instrument_bk", "_block").orderBy(F.col("trade_date").desc())
    tails = rows.withColumn("_rn", F.row_number().over(tail)).where(F.col("_rn") <= reach).drop("_rn")
    series = Window.partitionBy("instrument_bk").orderBy("trade_date")
    earlier = F.collect_list(F.struct("trade_date", "close_price")).over(series.rowsBetween(-reach, -1))
    first = F.lag("_block").over(series)
    carried = tails.withColumns({"_earlier": earlier, "_first": first}).where(F.col("_first") != F.col("_block"))
    carried = carried.select("instrument_bk", "_block", F.explode("_earlier").alias("_row"))
    every = rows.withColumn("_own", F.lit(True)).unionByName(carried.select("instrument_bk", F.col("_row.trade_date").alias("trade_date"), F.col("_row.close_price").alias("close_price"), "_block", F.lit(False).alias("_own")))
    w = Window.partitionBy("instrument_bk", "_block").orderBy("trade_date")
    prev = F.lag("close_price").over(w)
    ma = F.avg("close_price").over(w.rowsBetween(-(window - 1), 0))
    placed = every.select("instrument_bk", "trade_date", "close_price", prev.alias("prev_close"), ma.cast(PRICE).alias(f"close_ma{window}"), "_own").where("_own")
    change = (F.col("close_price") - F.col("prev_close")) / F.col("prev_close") * 100
    return placed.select(
        "instrument_bk",
        "trade_date",
        "close_price",
        "prev_close",
        F.when(F.col("prev_close") != 0, F.round(change, 4)).cast(RETURN_PCT).alias("dod_return_pct"),
        f"close_ma{window}",
    )


def exchange_rollup(mart: DataFrame) -> DataFrame:
    """Volume and return totals by exchange and asset type with subtotals."""
    return mart.rollup("exchange", "asset_type").agg(
        F.grouping_id().cast("bigint").alias("grouping_level"),
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("volume").cast("bigint").alias("total_volume"),
        F.sum("daily_return_pct").alias("sum_return_pct"),
    )


def top_movers(mart: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` largest absolute daily returns per day (tie: instrument key)."""
    w = Window.partitionBy("trade_date").orderBy(F.abs("daily_return_pct").desc(), F.col("instrument_bk").asc())
    return (
        mart.select("trade_date", "instrument_bk", "daily_return_pct", F.row_number().over(w).alias("rank"))
        .where(F.col("rank") <= k)
        .withColumn("rank", F.col("rank").cast("int"))
    )


def satellite_as_of(sat: DataFrame, grain: Sequence[str], as_of: Column) -> DataFrame:
    """E5: the version of each grain valid at ``as_of`` (newest load_date <= as_of)."""
    return V.latest_version(sat, grain, as_of=as_of)
