"""Quality gates: row rules with quarantine, referential and key checks, load
counts, freshness and volume anomalies (P9, T8, T9, G1-G5).

Every check is a single aggregation (partial + final), never a driver loop;
summaries are a handful of rows per check.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Rule = tuple[str, Column]  # (name, predicate that is TRUE for a valid row)


def _valid(pred: Column) -> Column:
    return F.coalesce(pred, F.lit(False))


def all_not_null(*cols: str) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull()
    return out


# Fixed rule tables (required fields, stored lengths, basic market-data sanity).
# Built on call: Column objects need an active session.
def quote_rules() -> list[Rule]:
    return [
    ("symbol_required", F.col("symbol").isNotNull() & (F.trim("symbol") != "")),
    ("symbol_max_20", F.length("symbol") <= 20),
    ("prices_required", all_not_null("open_price", "high_price", "low_price", "close_price")),
    ("volume_required", F.col("volume").isNotNull()),
    ("trade_date_required", F.col("trade_date").isNotNull()),
    ("source_required", F.col("source").isNotNull() & (F.length("source") <= 100)),
    ("prices_non_negative", (F.least("open_price", "high_price", "low_price", "close_price") >= 0)),
    ("high_is_max", F.col("high_price") >= F.greatest("open_price", "close_price", "low_price")),
    ("low_is_min", F.col("low_price") <= F.least("open_price", "close_price", "high_price")),
    ("volume_non_negative", F.col("volume") >= 0),
    ]


def rate_rules() -> list[Rule]:
    return [
    ("currencies_required", F.col("base_currency").isNotNull() & F.col("target_currency").isNotNull()),
    ("currency_max_10", (F.length("base_currency") <= 10) & (F.length("target_currency") <= 10)),
    ("distinct_currencies", F.col("base_currency") != F.col("target_currency")),
    ("rate_positive", F.col("rate") > 0),
    ("rate_date_required", F.col("rate_date").isNotNull()),
    ("source_required", F.col("source").isNotNull() & (F.length("source") <= 100)),
    ]


def instrument_rules() -> list[Rule]:
    """The message boundary: all five texts are required and have their stored lengths."""
    return [
    ("symbol_required", F.col("symbol").isNotNull() & (F.trim("symbol") != "")),
    ("symbol_max_20", F.length("symbol") <= 20),
    ("name_required", F.col("instrument_name").isNotNull() & (F.length("instrument_name") <= 255)),
    ("exchange_required", F.col("exchange").isNotNull() & (F.length("exchange") <= 50)),
    ("asset_type_required", F.col("asset_type").isNotNull() & (F.length("asset_type") <= 50)),
    ("source_required", F.col("source").isNotNull() & (F.length("source") <= 100)),
    ]


def violations(rules: Sequence[Rule]) -> Column:
    """Array of the names of the rules a row breaks (empty when valid)."""
    marks = F.array(*[F.when(~_valid(pred), F.lit(name)) for name, pred in rules])
    return F.filter(marks, lambda x: x.isNotNull())


def validate(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Split into ``(good, bad)``; ``bad`` carries ``violations`` and ``reason``.

    Callers that feed both outputs should cache/checkpoint ``df`` first so the
    input is read once.
    """
    valid = reduce(and_, [_valid(pred) for _, pred in rules], F.lit(True))  # plain conditions; names are made for the bad rows only
    good = df.where(valid)
    bad = df.where(~valid).withColumn("violations", violations(rules)).withColumn("reason", F.element_at("violations", 1))
    return good, bad


def rule_summary(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with rows checked and violations, from one aggregate."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [
        F.count(F.when(~_valid(pred), F.lit(1))).alias(f"_v{i}") for i, (_, pred) in enumerate(rules)
    ]
    one = df.agg(*aggs)
    stacked = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("rule"), F.col(f"_v{i}").alias("violations"))
                for i, (name, _) in enumerate(rules)
            ]
        )
    ).alias("r")
    return one.select(F.col("_n").alias("rows_checked"), stacked).select(
        F.lit(table).alias("table_name"), "r.rule", "rows_checked", "r.violations"
    )


def orphan_check(name: str, child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent row -> (check_name, child_rows, orphan_rows).

    Children are counted per key before the join (partial aggregates cut a hot
    key down map-side), parents reduced to distinct keys, so both sides are
    unique and no key's rows meet in one task.
    """
    p = parent.select(F.col(parent_key).alias("_pk")).distinct().withColumn("_hit", F.lit(True))
    j = child.groupBy(F.col(child_key).alias("_pk")).agg(F.count(F.lit(1)).alias("_n")).join(p, "_pk", "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return j.agg(
        F.lit(name).alias("check_name"),
        total(F.col("_n")).alias("child_rows"),
        total(F.when(F.col("_hit").isNull(), F.col("_n"))).alias("orphan_rows"),
    )


def duplicate_check(name: str, df: DataFrame, key: Sequence[str]) -> DataFrame:
    """(table_name, rows, distinct_keys, duplicate_keys) for a primary key."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count(F.when(F.col("_n") > 1, F.lit(1))).alias("duplicate_keys"),
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def date_spine(bounds: DataFrame, start: str, end: str, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """One row per day between ``start`` and ``end`` of each bounds row."""
    return bounds.select(*keys, F.explode(F.sequence(F.col(start), F.col(end))).alias(name))


def within(df: DataFrame, date_col: str, first=None, last=None) -> DataFrame:
    if first is not None:
        df = df.where(F.col(date_col) >= F.lit(first).cast("date"))
    return df if last is None else df.where(F.col(date_col) <= F.lit(last).cast("date"))


def vault_counts(hub: DataFrame, sat: DataFrame, first=None, last=None) -> DataFrame:
    """G1: per day, hub rows loaded that day and satellite rows of that trade date.

    Both zero -> ``skip`` (no data is not a failure), else ``ok``.  Days come
    from a calendar spine between the first and last day seen, or within
    ``first`` and ``last``, so that one rogue date doesn't span millennia.
    """
    h = hub.groupBy(F.to_date("load_date").alias("check_date")).agg(F.count(F.lit(1)).alias("hub_rows"))
    s = sat.groupBy(F.col("trade_date").alias("check_date")).agg(F.count(F.lit(1)).alias("sat_rows"))
    h, s = within(h, "check_date", first, last), within(s, "check_date", first, last)
    seen = h.select("check_date").unionByName(s.select("check_date"))
    bounds = seen.agg(F.min("check_date").alias("lo"), F.max("check_date").alias("hi"))
    spine = date_spine(bounds, "lo", "hi", "check_date")
    out = spine.join(h, "check_date", "left").join(s, "check_date", "left")
    hub_rows = F.coalesce("hub_rows", F.lit(0)).cast("bigint")
    sat_rows = F.coalesce("sat_rows", F.lit(0)).cast("bigint")
    return out.select(
        "check_date",
        hub_rows.alias("hub_rows"),
        sat_rows.alias("sat_rows"),
        F.when((hub_rows == 0) & (sat_rows == 0), F.lit("skip")).otherwise(F.lit("ok")).alias("status"),
    )


def input_freshness(landed: DataFrame, date_col: str = "trade_date", source_col: str = "source", first=None, last=None) -> DataFrame:
    """Rows landed per (source, day), with the day spelled out explicitly.

    Every source is checked for every day from its first landing up to the
    newest day of any source (within ``first`` and ``last``, where given); a
    day without rows is reported with ``n_rows = 0`` and ``fresh = false``.
    """
    landed = within(landed, date_col, first, last)
    counts = landed.groupBy(F.col(source_col).alias("source"), F.col(date_col).alias("check_date")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return freshness_of(counts)


def freshness_of(counts: DataFrame) -> DataFrame:
    """G2 over (source, check_date, n_rows)."""
    newest = counts.select(F.max("check_date")).scalar()
    bounds = counts.groupBy("source").agg(F.min("check_date").alias("lo")).withColumn("hi", newest)
    spine = date_spine(bounds, "lo", "hi", "check_date", keys=["source"])
    out = spine.join(counts, ["source", "check_date"], "left")
    n = F.coalesce("n_rows", F.lit(0)).cast("bigint")
    return out.select("source", "check_date", n.alias("n_rows"), (n > 0).alias("fresh"))


def volume_anomaly(
    landed: DataFrame, date_col: str = "trade_date", source_col: str = "source", window: int = 7, threshold: float = 0.5
) -> DataFrame:
    """Daily row count vs the mean of the previous ``window`` days (per source).

    Counted first (one row per source-day), so the window runs over tiny
    input however large the landed table is.
    """
    daily = landed.groupBy(F.col(source_col).alias("source"), F.col(date_col).alias("check_date")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return anomaly_of(daily, window, threshold)


def anomaly_of(daily: DataFrame, window: int, threshold: float) -> DataFrame:
    """G4 over (source, check_date, n_rows)."""
    w = Window.partitionBy("source").orderBy("check_date").rowsBetween(-window, -1)
    avg = F.avg("n_rows").over(w)
    out = daily.withColumn("_avg", avg)
    return out.select(
        "source",
        "check_date",
        "n_rows",
        F.col("_avg").cast("decimal(18,4)").alias("trailing_avg"),
        F.coalesce(F.abs(F.col("n_rows") - F.col("_avg")) > F.col("_avg") * threshold, F.lit(False)).alias("is_anomaly"),
    )


def quarantine_summary(quarantine: DataFrame, reason_col: str = "reason", source_col: str = "source") -> DataFrame:
    """Quarantined rows by reason and source."""
    return quarantine.groupBy(F.col(reason_col).alias("reason"), F.col(source_col).alias("source")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
