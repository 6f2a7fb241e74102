"""Named catalog queries: ``(spark, sf_dir) -> DataFrame`` with a DuckDB twin.

Each query derives the warehouse inputs from the driver tables through
:mod:`dvspark.sources.testviews` and runs the real operators over the
whole tables.  ``register`` keeps the Spark builder and its oracle SQL side
by side; ``None`` as oracle marks a query that has no SQL statement.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dvspark import schemas as S
from dvspark.functions.hashing import hash_diff, hash_key, hash_key_composite, schema_types
from dvspark.operators import analytics as A
from dvspark.operators import colocate
from dvspark.operators import marts as M
from dvspark.operators import profiles
from dvspark.operators import publish as P
from dvspark.operators import quality as Q
from dvspark.operators import raw as R
from dvspark.operators import vault as V
from dvspark.operators.warehouse import (
    QUOTE_GRAIN,
    RATE_GRAIN,
    SAT_QUOTE_COLS,
    SAT_RATE_COLS,
    hub_currency,
    hub_instrument,
    hub_market,
    lnk_quote_instrument,
    lnk_rate_currency,
    normalize_rate_direction,
    quote_versions,
    rate_versions,
    sat_details,
    sat_quotes,
    sat_rates,
)
from dvspark.plans import daily_load as D
from dvspark.plans import oracle as O
from dvspark.session import session_tz, work_path
from dvspark.sources import dirtyviews as dv
from dvspark.sources import messages as MSG
from dvspark.sources import quotes_json as QJ
from dvspark.sources import rates_xml as RX
from dvspark.sources import testviews as tv
from dvspark.streaming import streams as X

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


def _run_time() -> Column:
    """When the catalog's marts are built: a fixed parameter, so a rebuild gives the same rows."""
    return F.lit(O.MART_LOADED_AT).cast("timestamp_ntz")


def quotes_mart_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tv.raw_quotes(spark, sf_dir)
    details = sat_details(tv.raw_instruments(spark, sf_dir))
    return M.mart_quotes_daily(sat_quotes(raw), hub_instrument(raw), details, loaded_at=_run_time())


def fx_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = tv.raw_rates(spark, sf_dir)
    return M.mart_fx_rates(sat_rates(rates), lnk_rate_currency(rates), hub_currency(rates), loaded_at=_run_time())


# ------------------------------------------------------------------- hashing
@register("hash_diff", O.sql(f"SELECT symbol, trade_date, source, {O._hd(*O.QUOTE_ATTRS)} AS hash_diff FROM raw_quotes", "raw_quotes"))
def q_hash_diff(spark, sf_dir):
    raw = tv.raw_quotes(spark, sf_dir)
    return raw.select("symbol", "trade_date", "source", hash_diff(*S.QUOTE_HASH_COLUMNS, types=schema_types(raw)).alias("hash_diff"))


# --------------------------------------------------------------------- vault
@register("hub_instrument", O.sql("SELECT * FROM hub_instrument", "hub_instrument"))
def q_hub_instrument(spark, sf_dir):
    return hub_instrument(tv.raw_quotes(spark, sf_dir))


@register("sat_quote_history", O.sql("SELECT * FROM sat_quote_prices", "sat_quote_prices"))
def q_sat_quote_history(spark, sf_dir):
    return sat_quotes(tv.raw_quotes(spark, sf_dir))


O.cte(
    "renamed_versions",
    ("raw_instruments",),
    f"""
    WITH twice AS (
      SELECT * FROM raw_instruments
      UNION ALL
      SELECT * REPLACE (loaded_at + INTERVAL 1 DAY AS loaded_at, asset_type || ' (moved)' AS asset_type) FROM raw_instruments WHERE exchange IS NOT NULL
      UNION ALL
      SELECT * REPLACE (loaded_at + INTERVAL 1 DAY AS loaded_at) FROM raw_instruments WHERE exchange IS NULL
    )
    SELECT upper(md5(symbol)) AS hub_instrument_hk, loaded_at AS load_date, source AS record_source,
           {O._hd('instrument_name', 'exchange', 'asset_type')} AS hash_diff, instrument_name, exchange, asset_type
    FROM twice""",
)


@register(
    "sat_instrument_details",
    O.sql(
        f"""SELECT *, min(load_date) OVER (PARTITION BY hub_instrument_hk ORDER BY load_date
                                           ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS load_end_date
            FROM ({O._t7('renamed_versions', 'hub_instrument_hk')})""",
        "renamed_versions",
    ),
)
def q_sat_instrument_details(spark, sf_dir):
    """Delivered twice, a day apart; where there is an exchange the asset type has changed, so the first version ends."""
    raw = tv.raw_instruments(spark, sf_dir)
    moved = F.when(F.col("exchange").isNotNull(), F.concat("asset_type", F.lit(" (moved)"))).otherwise(F.col("asset_type"))
    return sat_details(replayed(raw, "1 DAY", asset_type=moved))


@register("hub_currency", O.sql("SELECT * FROM hub_currency", "hub_currency"))
def q_hub_currency(spark, sf_dir):
    return hub_currency(tv.raw_rates(spark, sf_dir))


@register("lnk_rate_currency", O.sql("SELECT * FROM lnk_rate_currency", "lnk_rate_currency"))
def q_lnk_rate_currency(spark, sf_dir):
    return lnk_rate_currency(tv.raw_rates(spark, sf_dir))


@register("sat_rate_values", O.sql("SELECT * FROM sat_rate_values", "sat_rate_values"))
def q_sat_rate_values(spark, sf_dir):
    return sat_rates(tv.raw_rates(spark, sf_dir))


# ---------------------------------------------------------------------- marts
@register("mart_quotes_backfill", O.sql("SELECT * FROM mart_quotes_all", "mart_quotes_all"))
def q_mart_quotes_backfill(spark, sf_dir):
    return quotes_mart_all(spark, sf_dir)


VAULT_BUCKETS = 16


def colocated_vault(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Satellite, hub and details bucketed by the hash key."""
    raw, base = tv.raw_quotes(spark, sf_dir), work_path(spark, "colocated")
    tables = {"sat": sat_quotes(raw), "hub": hub_instrument(raw), "details": sat_details(tv.raw_instruments(spark, sf_dir))}
    return tuple(colocate.write_bucketed(df, f"{base}/{name}", "hub_instrument_hk", VAULT_BUCKETS) for name, df in tables.items())


@register("mart_quotes_colocated", O.sql("SELECT * FROM mart_quotes_all", "mart_quotes_all"))
def q_mart_quotes_colocated(spark, sf_dir):
    """M1/M8 over tables bucketed by the hash key: latest versions, hub and details meet without an exchange."""
    return M.mart_quotes_daily(*colocated_vault(spark, sf_dir), loaded_at=_run_time())


@register(
    "mart_quotes_daily",
    O.sql(
        "SELECT * FROM mart_quotes_all WHERE trade_date = (SELECT max(trade_date) FROM raw_quotes)",
        "mart_quotes_all",
    ),
)
def q_mart_quotes_daily(spark, sf_dir):
    """M1 for the execution date = the newest trade date landed in raw; the day's quotes alone are read."""
    raw = tv.raw_quotes(spark, sf_dir)
    exec_date = raw.select(F.max("trade_date")).scalar()
    day = raw.where(F.col("trade_date") == exec_date)
    details = sat_details(tv.raw_instruments(spark, sf_dir))
    return M.mart_quotes_daily(sat_quotes(day), hub_instrument(day), details, loaded_at=_run_time())


@register("mart_fx_rates", O.sql("SELECT * FROM mart_fx_rates", "mart_fx_rates"))
def q_mart_fx_rates(spark, sf_dir):
    return fx_mart(spark, sf_dir)


@register(
    "fx_cross_rates",
    O.sql(
        """
        SELECT a.rate_date, a.base_currency, a.target_currency AS from_currency, b.target_currency AS to_currency,
               CAST(a.rate / b.rate AS DECIMAL(18,8)) AS cross_rate
        FROM mart_fx_rates a JOIN mart_fx_rates b
          ON a.rate_date = b.rate_date AND a.base_currency = b.base_currency
        WHERE b.rate <> 0 AND a.target_currency <> b.target_currency""",
        "mart_fx_rates",
    ),
)
def q_fx_cross_rates(spark, sf_dir):
    return M.fx_cross_rates(fx_mart(spark, sf_dir))


# ------------------------------------------------------------------ raw layer

RAW_QUOTE_COLS = [f.name for f in S.RAW_QUOTES.fields]
RAW_RATE_COLS = [f.name for f in S.RAW_RATES.fields]
RAW_INSTRUMENT_COLS = [f.name for f in S.RAW_INSTRUMENTS.fields]


def replayed(df: DataFrame, delay: str, **changes) -> DataFrame:
    """``df`` plus a later copy of every row with altered values (a replay)."""
    later = df.withColumn("loaded_at", F.col("loaded_at") + F.expr(f"INTERVAL {delay}"))
    for name, col in changes.items():
        later = later.withColumn(name, col)
    return df.unionByName(later)


@register("raw_quotes_first_wins", O.sql("SELECT * FROM raw_quotes", "raw_quotes"))
def q_raw_quotes_first_wins(spark, sf_dir):
    """Intraday load already stored; all loads replayed with restated closes.

    The replay (one hour later, close + 1) and the already stored rows must
    vanish: the table equals the first arrivals.
    """
    raw = tv.raw_quotes(spark, sf_dir)
    existing = raw.where(F.col("source") == tv.INTRADAY_SOURCE)
    batch = replayed(raw, "1 HOUR", close_price=(F.col("close_price") + 1).cast(S.PRICE))
    return R.load_raw(batch, S.RAW_QUOTES_KEY, existing).select(*RAW_QUOTE_COLS)


@register("raw_rates_first_wins", O.sql("SELECT * FROM raw_rates", "raw_rates"))
def q_raw_rates_first_wins(spark, sf_dir):
    """R2: cbr rows stored; every rate replayed an hour later, doubled."""
    raw = tv.raw_rates(spark, sf_dir)
    existing = raw.where(F.col("source") == tv.CBR_SOURCE)
    batch = replayed(raw, "1 HOUR", rate=(F.col("rate") * 2).cast(S.RATE))
    return R.load_raw(batch, S.RAW_RATES_KEY, existing).select(*RAW_RATE_COLS)


@register("raw_instruments", O.sql("SELECT * FROM raw_instruments", "raw_instruments"))
def q_raw_instruments(spark, sf_dir):
    """Reference data loaded first-wins on (symbol, source); a renamed replay is ignored."""
    raw = tv.raw_instruments(spark, sf_dir)
    batch = replayed(raw, "1 DAY", instrument_name=F.concat(F.col("instrument_name"), F.lit(" (renamed)")))
    return R.load_raw(batch, S.RAW_INSTRUMENTS_KEY).select(*RAW_INSTRUMENT_COLS)


@register(
    "raw_rates_union",
    O.sql(
        """SELECT base_currency, target_currency, rate, rate_date, source, loaded_at FROM raw_rates WHERE source = 'cbr'
           UNION ALL
           SELECT target_currency, base_currency, rate, rate_date, source, loaded_at FROM raw_rates WHERE source <> 'cbr'""",
        "raw_rates",
    ),
)
def q_raw_rates_union(spark, sf_dir):
    """Two feeds in one table; the second quotes the other way round and is swapped once, on ingestion."""
    raw = tv.raw_rates(spark, sf_dir)
    cbr = raw.where(F.col("source") == tv.CBR_SOURCE)
    as_delivered = raw.where(F.col("source") == tv.API_SOURCE)
    both = cbr.unionByName(normalize_rate_direction(as_delivered, False).select(*RAW_RATE_COLS))
    return R.load_raw(both, S.RAW_RATES_KEY).select(*RAW_RATE_COLS)


@register(
    "raw_quotes_by_date",
    O.sql(
        """SELECT symbol, open_price, high_price, low_price, close_price, volume, trade_date, source
           FROM raw_quotes WHERE trade_date = (SELECT max(trade_date) FROM raw_quotes)""",
        "raw_quotes",
    ),
)
def q_raw_quotes_by_date(spark, sf_dir):
    """Raw quotes of the execution date (the newest landed day), projected."""
    raw = tv.raw_quotes(spark, sf_dir)
    exec_date = raw.select(F.max("trade_date")).scalar()
    return raw.where(F.col("trade_date") == exec_date).select(
        "symbol", "open_price", "high_price", "low_price", "close_price", "volume", "trade_date", "source"
    )


# --------------------------------------------------------------- more hashing
@register("hash_key", O.sql("SELECT symbol, trade_date, source, upper(md5(symbol)) AS hub_instrument_hk FROM raw_quotes", "raw_quotes"))
def q_hash_key(spark, sf_dir):
    raw = tv.raw_quotes(spark, sf_dir)
    return raw.select("symbol", "trade_date", "source", hash_key("symbol").alias("hub_instrument_hk"))


@register(
    "hash_key_composite",
    O.sql(
        """SELECT base_currency, target_currency, rate_date, source,
                  upper(md5(concat_ws('||', base_currency, target_currency, CAST(rate_date AS VARCHAR), source))) AS rate_key_hk
           FROM raw_rates""",
        "raw_rates",
    ),
)
def q_hash_key_composite(spark, sf_dir):
    raw = tv.raw_rates(spark, sf_dir)
    return raw.select(
        "base_currency",
        "target_currency",
        "rate_date",
        "source",
        hash_key_composite("base_currency", "target_currency", "rate_date", "source").alias("rate_key_hk"),
    )


# ------------------------------------------------------------- more vault ops
O.cte(
    "hub_market",
    ("raw_instruments",),
    O._first_per(
        "exchange",
        "upper(md5(exchange)) AS hub_market_hk, exchange AS market_code, loaded_at AS load_date, source AS record_source",
        "(SELECT * FROM raw_instruments WHERE exchange IS NOT NULL)",
    ),
)
O.cte(
    "lnk_quote_instrument",
    ("raw_instruments",),
    O._first_per(
        "symbol, exchange",
        "upper(md5(concat_ws('||', upper(md5(symbol)), upper(md5(exchange))))) AS lnk_quote_instrument_hk, "
        "upper(md5(symbol)) AS hub_instrument_hk, upper(md5(exchange)) AS hub_market_hk, "
        "loaded_at AS load_date, source AS record_source",
        "(SELECT * FROM raw_instruments WHERE symbol IS NOT NULL AND exchange IS NOT NULL)",
    ),
)
@register("hub_market", O.sql("SELECT * FROM hub_market", "hub_market"))
def q_hub_market(spark, sf_dir):
    return hub_market(tv.raw_instruments(spark, sf_dir))


@register("lnk_quote_instrument", O.sql("SELECT * FROM lnk_quote_instrument", "lnk_quote_instrument"))
def q_lnk_quote_instrument(spark, sf_dir):
    return lnk_quote_instrument(tv.raw_instruments(spark, sf_dir))


@register(
    "quotes_with_hub",
    O.sql(
        """SELECT q.*, upper(md5(q.symbol)) AS hub_instrument_hk FROM raw_quotes q
           WHERE q.symbol IN (SELECT symbol FROM raw_quotes WHERE source = 'intraday' AND trade_date = (SELECT min(trade_date) FROM raw_quotes))""",
        "raw_quotes",
    ),
)
def q_quotes_with_hub(spark, sf_dir):
    """All quotes against a hub that the first day's morning load alone has fed."""
    raw = tv.raw_quotes(spark, sf_dir)
    first_day = raw.select(F.min("trade_date")).scalar()
    hub = hub_instrument(raw.where((F.col("source") == tv.INTRADAY_SOURCE) & (F.col("trade_date") == first_day)))
    return V.enrich_with_hub(raw.withColumn("hub_instrument_hk", hash_key("symbol")), hub, "hub_instrument_hk")


@register(
    "sat_latest",
    O.sql(
        """SELECT * FROM sat_quote_prices
           QUALIFY row_number() OVER (PARTITION BY hub_instrument_hk, trade_date ORDER BY load_date DESC) = 1""",
        "sat_quote_prices",
    ),
)
def q_sat_latest(spark, sf_dir):
    """Newest satellite version per (instrument, trade date)."""
    return V.latest_version(sat_quotes(tv.raw_quotes(spark, sf_dir)), QUOTE_GRAIN)


@register(
    "latest_by_max",
    O.sql(
        """WITH restated AS (SELECT * REPLACE ('vendor' AS record_source, close_price + 1 AS close_price) FROM sat_quote_versions),
                everything AS (SELECT * FROM sat_quote_versions UNION ALL SELECT * FROM restated),
                newest AS (SELECT hub_instrument_hk, trade_date, max(load_date) AS load_date FROM everything GROUP BY ALL)
           SELECT e.* REPLACE (CAST(close_price AS DECIMAL(18,6)) AS close_price)
           FROM everything e JOIN newest USING (hub_instrument_hk, trade_date, load_date)""",
        "sat_quote_versions",
    ),
)
def q_latest_by_max(spark, sf_dir):
    """M2: every version at MAX(load_date) per grain; a second vendor restates each bar at the same time, so all are ties."""
    versions = quote_versions(tv.raw_quotes(spark, sf_dir)).select(*SAT_QUOTE_COLS)
    restated = versions.withColumns({"record_source": F.lit("vendor"), "close_price": (F.col("close_price") + 1).cast(S.PRICE)})
    return V.latest_version(versions.unionByName(restated), QUOTE_GRAIN, keep_ties=True)


O.cte(
    "sat_after_intraday",
    ("sat_quote_versions",),
    O._t7("(SELECT * FROM sat_quote_versions WHERE record_source = 'intraday')", "hub_instrument_hk, trade_date"),
)
O.cte(
    "sat_eod_delta",
    ("sat_after_intraday",),
    """
    SELECT n.* FROM (SELECT * FROM sat_quote_versions WHERE record_source = 'eod') n
    LEFT JOIN (SELECT * FROM sat_after_intraday
               QUALIFY row_number() OVER (PARTITION BY hub_instrument_hk, trade_date ORDER BY load_date DESC) = 1) e
      ON n.hub_instrument_hk = e.hub_instrument_hk AND n.trade_date = e.trade_date
    WHERE e.hash_diff IS NULL OR n.hash_diff <> e.hash_diff""",
)


def _intraday_then_eod(spark, sf_dir):
    raw = tv.raw_quotes(spark, sf_dir)
    versions = quote_versions(raw).select(*SAT_QUOTE_COLS)
    existing = V.satellite_history(versions.where(F.col("record_source") == tv.INTRADAY_SOURCE), QUOTE_GRAIN)
    batch = versions.where(F.col("record_source") == tv.EOD_SOURCE)
    return raw, existing, batch


@register("sat_delta", O.sql("SELECT * FROM sat_eod_delta", "sat_eod_delta"))
def q_sat_delta(spark, sf_dir):
    """End-of-day versions that are new or changed against the stored intraday ones."""
    _, existing, batch = _intraday_then_eod(spark, sf_dir)
    return V.satellite_delta(batch, existing, QUOTE_GRAIN)


@register("sat_quote_prices", O.sql("SELECT * FROM sat_quote_prices", "sat_quote_prices"))
def q_sat_quote_prices(spark, sf_dir):
    """Incremental load (intraday, then end of day) = bulk history."""
    raw, existing, batch = _intraday_then_eod(spark, sf_dir)
    appended = V.load_satellite(batch, existing, QUOTE_GRAIN, SAT_QUOTE_COLS, hub=hub_instrument(raw))
    return existing.select(*SAT_QUOTE_COLS).unionByName(appended)


O.cte(
    "late_versions",
    ("sat_quote_versions",),
    f"""
    SELECT * REPLACE (load_date - INTERVAL 6 HOUR AS load_date, 'late' AS record_source, CAST(close_price + 7 AS DECIMAL(18,6)) AS close_price,
                      {O._hd('open_price', 'high_price', 'low_price', 'CAST(close_price + 7 AS DECIMAL(18,6))', 'volume')} AS hash_diff)
    FROM sat_quote_versions WHERE record_source = 'eod'""",
)


@register(
    "sat_late_arrival",
    O.sql(
        f"SELECT * FROM ({O._t7('(SELECT * FROM sat_quote_versions UNION ALL SELECT * FROM late_versions)', 'hub_instrument_hk, trade_date')})",
        "sat_quote_versions",
        "late_versions",
    ),
)
def q_sat_late_arrival(spark, sf_dir):
    """T3 after a late load: restatements dated between morning and evening come last of all.

    The evening's versions had been dropped where they changed nothing; the
    late load makes them changes again.  Stored rows plus delta = bulk history.
    """
    raw, existing, batch = _intraday_then_eod(spark, sf_dir)
    in_order = V.satellite_delta(batch, existing, QUOTE_GRAIN, date_col="trade_date")
    satellite = existing.select(*SAT_QUOTE_COLS).unionByName(in_order.select(*SAT_QUOTE_COLS))
    late_raw = raw.where(F.col("source") == tv.EOD_SOURCE).withColumns(
        {"loaded_at": F.col("loaded_at") - F.expr("INTERVAL 6 HOUR"), "source": F.lit("late"), "close_price": (F.col("close_price") + 7).cast(S.PRICE)}
    )
    late = quote_versions(late_raw).select(*SAT_QUOTE_COLS)
    arrived = quote_versions(raw).select(*SAT_QUOTE_COLS)
    delta = V.satellite_delta(late, satellite, QUOTE_GRAIN, arrivals=arrived, date_col="trade_date")
    return V.satellite_history(satellite.unionByName(delta.select(*SAT_QUOTE_COLS)), QUOTE_GRAIN)


# ------------------------------------------------------------------- quality
def _stored(df: DataFrame, name: str) -> DataFrame:
    """A derived table written once below the shared folder."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _quote_vault(spark, sf_dir):
    raw = tv.raw_quotes(spark, sf_dir)
    inst = tv.raw_instruments(spark, sf_dir)
    return raw, inst, hub_instrument(raw), sat_quotes(raw), sat_details(inst)


@register(
    "vault_orphans",
    O.sql(
        """
        SELECT 'sat_quote_prices->hub_instrument' AS check_name, count(*) AS child_rows,
               count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM hub_instrument h WHERE h.hub_instrument_hk = c.hub_instrument_hk)) AS orphan_rows
        FROM sat_quote_prices c
        UNION ALL
        SELECT 'sat_instrument_details->hub_instrument', count(*),
               count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM hub_instrument h WHERE h.hub_instrument_hk = c.hub_instrument_hk))
        FROM sat_instrument_details c
        UNION ALL
        SELECT 'lnk_quote_instrument->hub_instrument', count(*),
               count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM hub_instrument h WHERE h.hub_instrument_hk = c.hub_instrument_hk))
        FROM lnk_quote_instrument c
        UNION ALL
        SELECT 'lnk_quote_instrument->hub_market', count(*),
               count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM hub_market h WHERE h.hub_market_hk = c.hub_market_hk))
        FROM lnk_quote_instrument c
        UNION ALL
        SELECT 'lnk_rate_currency->hub_currency(base)', count(*),
               count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM hub_currency h WHERE h.hub_currency_hk = c.hub_currency_hk_base))
        FROM lnk_rate_currency c
        UNION ALL
        SELECT 'lnk_rate_currency->hub_currency(target)', count(*),
               count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM hub_currency h WHERE h.hub_currency_hk = c.hub_currency_hk_target))
        FROM lnk_rate_currency c
        UNION ALL
        SELECT 'sat_rate_values->lnk_rate_currency', count(*),
               count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM lnk_rate_currency h WHERE h.lnk_rate_currency_hk = c.lnk_rate_currency_hk))
        FROM sat_rate_values c""",
        "sat_quote_prices",
        "hub_instrument",
        "sat_instrument_details",
        "lnk_quote_instrument",
        "hub_market",
        "lnk_rate_currency",
        "hub_currency",
        "sat_rate_values",
    ),
)
def q_vault_orphans(spark, sf_dir):
    """Referential checks; details of instruments never quoted show up as orphans."""
    raw, inst, hub, sat, details = _quote_vault(spark, sf_dir)
    rates = tv.raw_rates(spark, sf_dir)
    hc, lnk = hub_currency(rates), lnk_rate_currency(rates)
    return Q.union_all(
        [
            Q.orphan_check("sat_quote_prices->hub_instrument", sat, "hub_instrument_hk", hub, "hub_instrument_hk"),
            Q.orphan_check("sat_instrument_details->hub_instrument", details, "hub_instrument_hk", hub, "hub_instrument_hk"),
            Q.orphan_check("lnk_quote_instrument->hub_instrument", lnk_quote_instrument(inst), "hub_instrument_hk", hub, "hub_instrument_hk"),
            Q.orphan_check("lnk_quote_instrument->hub_market", lnk_quote_instrument(inst), "hub_market_hk", hub_market(inst), "hub_market_hk"),
            Q.orphan_check("lnk_rate_currency->hub_currency(base)", lnk, "hub_currency_hk_base", hc, "hub_currency_hk"),
            Q.orphan_check("lnk_rate_currency->hub_currency(target)", lnk, "hub_currency_hk_target", hc, "hub_currency_hk"),
            Q.orphan_check("sat_rate_values->lnk_rate_currency", sat_rates(rates), "lnk_rate_currency_hk", lnk, "lnk_rate_currency_hk"),
        ]
    )


def _dup_sql(name: str, table: str, key: str) -> str:
    return f"""SELECT '{name}' AS table_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows, count(*) AS distinct_keys,
                      count(*) FILTER (WHERE n > 1) AS duplicate_keys
               FROM (SELECT count(*) AS n FROM {table} GROUP BY {key})"""


_DUP_CHECKS = [
    ("raw_quotes_delivered_twice", "(SELECT * FROM raw_quotes UNION ALL SELECT * FROM raw_quotes WHERE source = 'eod')", "symbol, trade_date, source"),
    ("raw_quotes", "raw_quotes", "symbol, trade_date, source"),
    ("raw_instruments", "raw_instruments", "symbol, source"),
    ("hub_market", "hub_market", "hub_market_hk"),
    ("lnk_quote_instrument", "lnk_quote_instrument", "lnk_quote_instrument_hk"),
    ("mart_refresh_log", "(SELECT DISTINCT 'dm_quotes_daily' AS mart_name, trade_date AS execution_date FROM raw_quotes)", "mart_name, execution_date"),
    ("raw_rates", "raw_rates", "base_currency, target_currency, rate_date, source"),
    ("hub_instrument", "hub_instrument", "hub_instrument_hk"),
    ("hub_currency", "hub_currency", "hub_currency_hk"),
    ("lnk_rate_currency", "lnk_rate_currency", "lnk_rate_currency_hk"),
    ("sat_quote_prices", "sat_quote_prices", "hub_instrument_hk, trade_date, load_date"),
    ("sat_rate_values", "sat_rate_values", "lnk_rate_currency_hk, rate_date, load_date"),
    ("sat_instrument_details", "sat_instrument_details", "hub_instrument_hk, load_date"),
    ("dm_quotes_daily", "mart_quotes_all", "instrument_bk, trade_date"),
    ("dm_fx_rates", "mart_fx_rates", "base_currency, target_currency, rate_date, source"),
]


@register(
    "vault_duplicates",
    O.sql(
        "\nUNION ALL\n".join(_dup_sql(*c) for c in _DUP_CHECKS),
        *sorted({c[1] for c in _DUP_CHECKS if not c[1].startswith("(")}),
    ),
)
def q_vault_duplicates(spark, sf_dir):
    """Primary-key uniqueness of raw, vault and mart tables, and of a raw table whose evening load came twice.

    The tables that several checks build on are written once, as the stored warehouse has them.
    """
    raw, inst, hub, sat, details = _quote_vault(spark, sf_dir)
    rates = tv.raw_rates(spark, sf_dir)
    sat, rate_sat = _stored(sat, "sat_quote_prices"), _stored(sat_rates(rates), "sat_rate_values")
    frames = {
        "raw_quotes_delivered_twice": raw.unionByName(raw.where(F.col("source") == tv.EOD_SOURCE)),
        "raw_instruments": inst,
        "hub_market": hub_market(inst),
        "lnk_quote_instrument": lnk_quote_instrument(inst),
        "mart_refresh_log": raw.select(F.lit("dm_quotes_daily").alias("mart_name"), F.col("trade_date").alias("execution_date")).distinct(),
        "raw_quotes": raw,
        "raw_rates": rates,
        "hub_instrument": hub,
        "hub_currency": hub_currency(rates),
        "lnk_rate_currency": lnk_rate_currency(rates),
        "sat_quote_prices": sat,
        "sat_rate_values": rate_sat,
        "sat_instrument_details": details,
        "dm_quotes_daily": M.mart_quotes_daily(sat, hub, details),
        "dm_fx_rates": M.mart_fx_rates(rate_sat, lnk_rate_currency(rates), hub_currency(rates)),
    }
    return Q.union_all(
        [Q.duplicate_check(name, frames[name], [k.strip() for k in key.split(",")]) for name, _, key in _DUP_CHECKS]
    )


def _rule_sql(table: str, rules: list[tuple[str, str]]) -> str:
    parts = [
        f"""SELECT '{table}' AS table_name, '{name}' AS rule, count(*) AS rows_checked,
                   count(*) FILTER (WHERE NOT coalesce({pred}, false)) AS violations FROM {table}"""
        for name, pred in rules
    ]
    return "\nUNION ALL\n".join(parts)


# SQL statements of the rule tables in dvspark.operators.quality (same order).
QUOTE_RULES_SQL = [
    ("symbol_required", "symbol IS NOT NULL AND trim(symbol) <> ''"),
    ("symbol_max_20", "length(symbol) <= 20"),
    ("prices_required", "open_price IS NOT NULL AND high_price IS NOT NULL AND low_price IS NOT NULL AND close_price IS NOT NULL"),
    ("volume_required", "volume IS NOT NULL"),
    ("trade_date_required", "trade_date IS NOT NULL"),
    ("source_required", "source IS NOT NULL AND length(source) <= 100"),
    ("prices_non_negative", "least(open_price, high_price, low_price, close_price) >= 0"),
    ("high_is_max", "high_price >= greatest(open_price, close_price, low_price)"),
    ("low_is_min", "low_price <= least(open_price, close_price, high_price)"),
    ("volume_non_negative", "volume >= 0"),
]
RATE_RULES_SQL = [
    ("currencies_required", "base_currency IS NOT NULL AND target_currency IS NOT NULL"),
    ("currency_max_10", "length(base_currency) <= 10 AND length(target_currency) <= 10"),
    ("distinct_currencies", "base_currency <> target_currency"),
    ("rate_positive", "rate > 0"),
    ("rate_date_required", "rate_date IS NOT NULL"),
    ("source_required", "source IS NOT NULL AND length(source) <= 100"),
]


O.cte(
    "quote_defects",
    ("raw_quotes",),
    """
    SELECT defect,
           CASE defect WHEN 'long_symbol' THEN repeat(symbol, 25) WHEN 'no_symbol' THEN ' ' ELSE symbol END AS symbol,
           CASE WHEN defect = 'above_high' THEN high_price + 1 ELSE open_price END AS open_price, high_price,
           CASE WHEN defect = 'negative' THEN -1 ELSE low_price END AS low_price,
           CASE WHEN defect <> 'no_close' THEN close_price END AS close_price,
           CASE defect WHEN 'no_volume' THEN NULL WHEN 'lost_volume' THEN -5 ELSE volume END AS volume,
           CASE WHEN defect <> 'no_date' THEN trade_date END AS trade_date,
           CASE WHEN defect <> 'no_source' THEN source END AS source, loaded_at
    FROM raw_quotes CROSS JOIN (VALUES ('clean'), ('negative'), ('above_high'), ('no_volume'), ('lost_volume'), ('no_date'), ('no_close'),
                                       ('no_source'), ('long_symbol'), ('no_symbol')) v(defect)""",
)
O.cte(
    "rate_defects",
    ("raw_rates",),
    """
    SELECT defect, base_currency,
           CASE defect WHEN 'same' THEN base_currency WHEN 'no_code' THEN NULL WHEN 'long_code' THEN repeat(base_currency, 5) ELSE target_currency END AS target_currency,
           CASE WHEN defect = 'zero' THEN 0 ELSE rate END AS rate, CASE WHEN defect <> 'no_date' THEN rate_date END AS rate_date,
           CASE WHEN defect <> 'no_source' THEN source END AS source, loaded_at
    FROM raw_rates CROSS JOIN (VALUES ('clean'), ('zero'), ('same'), ('no_code'), ('long_code'), ('no_date'), ('no_source')) v(defect)""",
)


@register(
    "dq_summary",
    O.sql(_rule_sql("quote_defects", QUOTE_RULES_SQL) + "\nUNION ALL\n" + _rule_sql("rate_defects", RATE_RULES_SQL), "quote_defects", "rate_defects"),
)
def q_dq_summary(spark, sf_dir):
    """Per-rule violation counts of quotes and rates and of their defective copies."""
    return Q.rule_summary(dv.defective_quotes(tv.raw_quotes(spark, sf_dir)), "quote_defects", Q.quote_rules()).unionByName(
        Q.rule_summary(dv.defective_rates(tv.raw_rates(spark, sf_dir)), "rate_defects", Q.rate_rules())
    )


def _violations_sql(rules):
    marks = ", ".join(f"CASE WHEN NOT coalesce({pred}, false) THEN '{name}' END" for name, pred in rules)
    return f"array_to_string(list_filter([{marks}], lambda x: x IS NOT NULL), ',')"


@register(
    "dq_row_rules",
    O.sql(f"SELECT defect, symbol, trade_date, source, {_violations_sql(QUOTE_RULES_SQL)} AS violations FROM quote_defects", "quote_defects"),
)
def q_dq_row_rules(spark, sf_dir):
    """Every raw quote and its defective copies with the list of rules each breaks (empty = clean)."""
    rows = dv.defective_quotes(tv.raw_quotes(spark, sf_dir))
    return rows.select("defect", "symbol", "trade_date", "source", F.array_join(Q.violations(Q.quote_rules()), ",").alias("violations"))


O.cte(
    "raw_stretched",
    ("raw_quotes",),
    """
    SELECT * REPLACE (trade_date + CAST(trade_date - DATE '2024-01-01' AS INTEGER) AS trade_date, loaded_at + to_days(CAST(trade_date - DATE '2024-01-01' AS INTEGER)) AS loaded_at)
    FROM raw_quotes""",
)


@register(
    "vault_counts",
    O.sql(
        """
        WITH f AS (SELECT min(loaded_at) AS t FROM raw_stretched GROUP BY symbol),
             h AS (SELECT CAST(t AS DATE) AS d, count(*) AS n FROM f GROUP BY 1),
             s AS (SELECT trade_date + CAST(trade_date - DATE '2024-01-01' AS INTEGER) AS d, count(*) AS n FROM sat_quote_prices GROUP BY 1),
             b AS (SELECT min(d) AS lo, max(d) AS hi FROM (SELECT d FROM h UNION ALL SELECT d FROM s)),
             spine AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b)
        SELECT spine.d AS check_date, coalesce(h.n, 0) AS hub_rows, coalesce(s.n, 0) AS sat_rows,
               CASE WHEN coalesce(h.n, 0) = 0 AND coalesce(s.n, 0) = 0 THEN 'skip' ELSE 'ok' END AS status
        FROM spine LEFT JOIN h ON spine.d = h.d LEFT JOIN s ON spine.d = s.d""",
        "raw_stretched",
        "sat_quote_prices",
    ),
)
def q_vault_counts(spark, sf_dir):
    """G1: post-load counts per day, ``skip`` when a day loaded nothing (every second day has no delivery)."""
    raw = dv.stretched(tv.raw_quotes(spark, sf_dir))
    return Q.vault_counts(hub_instrument(raw), sat_quotes(raw))


@register(
    "input_freshness",
    O.sql(
        """
        WITH c AS (SELECT source, trade_date AS d, count(*) AS n FROM raw_stretched GROUP BY 1, 2),
             spine AS (SELECT source, CAST(unnest(generate_series(min(d), (SELECT max(d) FROM c), INTERVAL 1 DAY)) AS DATE) AS d
                       FROM c GROUP BY source)
        SELECT spine.source, spine.d AS check_date, coalesce(c.n, 0) AS n_rows, coalesce(c.n, 0) > 0 AS fresh
        FROM spine LEFT JOIN c ON spine.source = c.source AND spine.d = c.d""",
        "raw_stretched",
    ),
)
def q_input_freshness(spark, sf_dir):
    """Rows landed per source and day up to the newest day, every second day without a delivery."""
    return Q.input_freshness(dv.stretched(tv.raw_quotes(spark, sf_dir)))


@register(
    "volume_anomaly",
    O.sql(
        """
        WITH d AS (SELECT source, trade_date AS check_date, count(*) * CASE WHEN day(trade_date) = 15 THEN 3 ELSE 1 END AS n_rows FROM raw_quotes GROUP BY 1, 2),
             w AS (SELECT *, avg(n_rows) OVER (PARTITION BY source ORDER BY check_date
                                               ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS a FROM d)
        SELECT source, check_date, n_rows, CAST(a AS DECIMAL(18,4)) AS trailing_avg,
               coalesce(abs(n_rows - a) > a * 0.5, false) AS is_anomaly
        FROM w""",
        "raw_quotes",
    ),
)
def q_volume_anomaly(spark, sf_dir):
    """Daily landed rows against the trailing 7-day mean; one day came three times."""
    return Q.volume_anomaly(dv.thrice_on_a_day(tv.raw_quotes(spark, sf_dir)))


PROFILE_DAYS = 7


def _profiles(spark, sf_dir) -> DataFrame:
    """A stored profile of each load of the quotes."""
    raw, path = tv.raw_quotes(spark, sf_dir), work_path(spark, "profiles")
    for name in (tv.INTRADAY_SOURCE, tv.EOD_SOURCE):
        P.append_load(profiles.profile(raw.where(F.col("source") == name)), path, name)
    return P.read_loads(spark, path, profiles.profile(raw).schema)


@register(
    "load_profiles",
    O.sql(
        f"""
        WITH d AS (SELECT DISTINCT source, trade_date AS check_date FROM raw_quotes)
        SELECT d.source, d.check_date, count(*) AS n_rows, true AS distinct_within_bound, true AS median_within_bound
        FROM d JOIN raw_quotes r ON r.source = d.source AND r.trade_date BETWEEN d.check_date - {PROFILE_DAYS - 1} AND d.check_date GROUP BY ALL""",
        "raw_quotes",
    ),
)
def q_load_profiles(spark, sf_dir):
    """Stored load profiles merged over a trailing week; counts are exact, sketches are held against the rows."""
    raw = tv.raw_quotes(spark, sf_dir)
    found = profiles.estimates(profiles.trailing(_profiles(spark, sf_dir), PROFILE_DAYS))
    days = raw.select("source", F.col("trade_date").alias("check_date")).distinct()
    near = raw.withColumn("check_date", F.explode(F.transform(F.sequence(F.lit(0), F.lit(PROFILE_DAYS - 1)), lambda k: F.date_add("trade_date", k))))
    low, high = (F.percentile("volume", F.lit(p)) for p in (0.45, 0.55))
    exact = near.join(days, ["source", "check_date"], "left_semi").groupBy("source", "check_date").agg(F.count_distinct("symbol").alias("n"), low.alias("low"), high.alias("high"))
    off = F.abs(F.col("distinct_keys") - F.col("n")) <= F.greatest(F.lit(1.0), 4 * profiles.KEY_ERROR * F.col("n"))
    return found.join(exact, ["source", "check_date"]).select("source", "check_date", "n_rows", off.alias("distinct_within_bound"), F.col("median_measure").between(F.floor("low"), F.ceil("high")).alias("median_within_bound"))


@register("volume_anomaly_by_profiles", ORACLE["volume_anomaly"].replace("CASE WHEN day(trade_date) = 15 THEN 3 ELSE 1 END", "1"))
def q_volume_anomaly_by_profiles(spark, sf_dir):
    """G4 from the stored profiles alone."""
    return profiles.volume_anomaly(_profiles(spark, sf_dir))


# ------------------------------------------------------------ parsing sources


def _quote_docs(spark, sf_dir):
    return QJ.documents_from_text(QJ.responses_from_quotes(tv.raw_quotes(spark, sf_dir)))


@register(
    "parse_quotes_json",
    O.sql("SELECT symbol, open_price, high_price, low_price, close_price, volume, trade_date, source FROM raw_quotes", "raw_quotes"),
)
def q_parse_quotes_json(spark, sf_dir):
    """Every quote rendered as API JSON (by symbol, source, month) and parsed back."""
    quotes, _ = QJ.parse_quote_responses(_quote_docs(spark, sf_dir), mode="all", source="source")
    return quotes.drop("loaded_at")


@register(
    "latest_quote_per_symbol",
    O.sql(
        """SELECT symbol, open_price, high_price, low_price, close_price, volume, trade_date, source FROM raw_quotes
           QUALIFY row_number() OVER (PARTITION BY symbol, source, strftime(trade_date, '%Y-%m') ORDER BY trade_date DESC) = 1""",
        "raw_quotes",
    ),
)
def q_latest_quote_per_symbol(spark, sf_dir):
    """The newest day of each response document (reference default mode)."""
    quotes, _ = QJ.parse_quote_responses(_quote_docs(spark, sf_dir), mode="latest", source="source")
    return quotes.drop("loaded_at")


def _bad_quote_docs(spark, sf_dir):
    """Error bodies, empty, truncated and defective responses beside the clean ones."""
    raw = tv.raw_quotes(spark, sf_dir)
    whole = dv.defective_documents(QJ.responses_from_quotes(raw))
    return QJ.documents_from_text(whole), QJ.documents_from_text(dv.defective_days(raw))


@register(
    "quotes_json_status",
    O.sql(
        """SELECT symbol, source, strftime(trade_date, '%Y-%m') AS period, defect, any_value(status) AS status,
                  CASE WHEN defect = 'clean' THEN count(*) ELSE 0 END AS n_days
           FROM raw_quotes CROSS JOIN (VALUES ('clean', 'ok'), ('cut', 'corrupt_document'), ('error', 'api_error'), ('note', 'rate_limit'),
                                              ('info', 'rate_limit'), ('empty', 'empty_series')) v(defect, status)
           GROUP BY 1, 2, 3, 4""",
        "raw_quotes",
    ),
)
def q_quotes_json_status(spark, sf_dir):
    """Triage status of every response document and of its defective forms."""
    docs, _ = _bad_quote_docs(spark, sf_dir)
    return docs.select(
        "symbol",
        "source",
        "period",
        "defect",
        QJ.response_status(F.col("body")).alias("status"),
        F.coalesce(F.size(F.col("body")[QJ.SERIES]), F.lit(0)).cast("bigint").alias("n_days"),
    )


O.cte(
    "quote_doc_keys",
    ("raw_quotes",),
    "SELECT DISTINCT symbol, source, strftime(trade_date, '%Y-%m') AS period FROM raw_quotes",
)
O.cte(
    "bad_quote_documents",
    ("quote_doc_keys",),
    """
    SELECT symbol, CAST(NULL AS VARCHAR) AS trade_date_text, reason, source, payload
    FROM quote_doc_keys CROSS JOIN (VALUES ('corrupt_document', '{"Meta Data":{"2. Sy'), ('api_error', '{"Error Message":"unknown symbol"}'),
      ('rate_limit', '{"Note":"slow down"}'), ('rate_limit', '{"Information":"slow down"}'),
      ('empty_series', '{"Meta Data":{},"Time Series (Daily)":{}}')) v(reason, payload)""",
)
O.cte(
    "bad_quote_days",
    ("raw_quotes",),
    """
    SELECT symbol, CASE WHEN defect = 'bad_date' THEN 'day ' ELSE '' END || CAST(trade_date AS VARCHAR) AS trade_date_text, reason, source,
           '{"1. open":"' || CASE WHEN defect = 'word_price' THEN 'n/a' ELSE CAST(open_price AS VARCHAR) END || '","2. high":"' || high_price || '","3. low":"' || low_price || '"'
             || CASE WHEN defect = 'no_close' THEN '' ELSE ',"4. close":"' || close_price || '"' END
             || ',"5. volume":"' || volume || CASE WHEN defect = 'part_volume' THEN '.5' ELSE '' END || '"}' AS payload
    FROM raw_quotes CROSS JOIN (VALUES ('no_close', 'missing_field'), ('part_volume', 'bad_number'), ('bad_date', 'bad_date'), ('word_price', 'bad_number')) v(defect, reason)""",
)


@register("quarantine_quotes", O.sql("SELECT * FROM bad_quote_documents UNION ALL SELECT * FROM bad_quote_days", "bad_quote_documents", "bad_quote_days"))
def q_quarantine_quotes(spark, sf_dir):
    """Quarantined documents and day rows, with their text; the clean ones beside them pass."""
    bad = [QJ.parse_quote_responses(docs, mode="all", source="source")[1] for docs in _bad_quote_docs(spark, sf_dir)]
    return Q.union_all(bad)


def _rate_docs(spark, sf_dir):
    return RX.documents_from_xml_text(RX.valcurs_from_quotes(tv.rate_quotes(spark, sf_dir)))


@register(
    "parse_rates_xml",
    O.sql("SELECT base_currency, target_currency, rate, rate_date, source FROM raw_rates", "raw_rates"),
)
def q_parse_rates_xml(spark, sf_dir):
    """Every day's rates rendered as bank XML and parsed back."""
    rates, _ = RX.parse_valcurs(_rate_docs(spark, sf_dir), requested_date="rate_date", source="source")
    return rates.select("base_currency", "target_currency", "rate", "rate_date", "source")


@register(
    "nominal_normalize",
    O.sql(
        """SELECT target_currency, rate_date, source, nominal, CAST(value AS DECIMAL(28,10)) AS value,
                  CAST(value / nominal AS DECIMAL(18,8)) AS rate FROM rate_quotes""",
        "rate_quotes",
    ),
)
def q_nominal_normalize(spark, sf_dir):
    """Value per nominal units -> rate per one unit."""
    rates, _ = RX.parse_valcurs(_rate_docs(spark, sf_dir), requested_date="rate_date", source="source")
    return rates.select("target_currency", "rate_date", "source", "nominal", "value", "rate")


QUOTE_MESSAGE_SQL = """
    SELECT symbol || ':' || CAST(trade_date AS VARCHAR) AS message_key,
           CAST(json_object('symbol', symbol, 'open', CAST(open_price AS VARCHAR), 'high', CAST(high_price AS VARCHAR),
                            'low', CAST(low_price AS VARCHAR), 'close', CAST(close_price AS VARCHAR), 'volume', volume,
                            'trade_date', CAST(trade_date AS VARCHAR), 'source', source,
                            'loaded_at', strftime(loaded_at, '%Y-%m-%dT%H:%M:%S') || '+00:00') AS VARCHAR) AS message_value
    FROM raw_quotes"""


TOPIC_PARTITIONS = 3


@register(
    "message_topic_order",
    O.sql(
        """
        SELECT symbol || ':' || CAST(trade_date AS VARCHAR) AS message_key, count(*) AS n_messages, CAST(1 AS BIGINT) AS n_partitions,
               string_agg(source, ',' ORDER BY loaded_at, source) AS sources
        FROM raw_quotes GROUP BY ALL""",
        "raw_quotes",
    ),
)
def q_message_topic_order(spark, sf_dir):
    """The topic as written, by partition of the key and in arrival order: a key's messages are in one partition, in their order."""
    base = work_path(spark, "topic")
    MSG.write_topic(MSG.quote_messages(tv.raw_quotes(spark, sf_dir), TOPIC_PARTITIONS, keep=["loaded_at", "source"]), f"{base}/quotes", ["loaded_at", "source"])
    topic = MSG.read_topic(spark, f"{base}/quotes")
    sent = F.from_json("message_value", "source string")["source"]
    return topic.groupBy("message_key").agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.count_distinct("message_partition").alias("n_partitions"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("message_offset", sent.alias("source")))), lambda m: m["source"]), ",").alias("sources"),
    )


@register("quote_messages", O.sql(QUOTE_MESSAGE_SQL, "raw_quotes"))
def q_quote_messages(spark, sf_dir):
    """Keyed JSON messages, decimals as strings; the key decides the topic partition."""
    return MSG.quote_messages(tv.raw_quotes(spark, sf_dir))


RATE_MESSAGE_SQL = """
    SELECT target_currency || ':' || CAST(rate_date AS VARCHAR) AS message_key,
           CAST(json_object('base_currency', base_currency, 'target_currency', target_currency, 'rate', CAST(rate AS VARCHAR),
                            'rate_date', CAST(rate_date AS VARCHAR), 'source', source,
                            'loaded_at', strftime(loaded_at, '%Y-%m-%dT%H:%M:%S') || '+00:00') AS VARCHAR) AS message_value
    FROM raw_rates"""


@register("rate_messages", O.sql(RATE_MESSAGE_SQL, "raw_rates"))
def q_rate_messages(spark, sf_dir):
    """S8/P10 for rates: keyed by currency and day."""
    return MSG.rate_messages(tv.raw_rates(spark, sf_dir))


@register("instrument_messages", O.sql("SELECT * FROM raw_instruments WHERE exchange IS NOT NULL", "raw_instruments"))
def q_instrument_messages(spark, sf_dir):
    """P9-P11 for instruments: encoded, decoded and checked at the boundary, which requires every field."""
    good, _ = MSG.decode_instrument_messages(MSG.instrument_messages(tv.raw_instruments(spark, sf_dir)), tz=session_tz(spark))
    return Q.validate(good, Q.instrument_rules())[0].select(*RAW_INSTRUMENT_COLS)


@register("decode_quote_messages", O.sql("SELECT * FROM raw_quotes", "raw_quotes"))
def q_decode_quote_messages(spark, sf_dir):
    """Messages decoded back into raw rows (round trip equals input)."""
    good, _ = MSG.decode_quote_messages(MSG.quote_messages(tv.raw_quotes(spark, sf_dir)), tz=spark.conf.get("spark.sql.session.timeZone"))
    return good


# ------------------------------------------------------- publish and streams

# Fixed run timestamps of the two refresh-log runs (parameters, not now()).
REFRESH_RUN_1 = "2024-02-01 20:00:00"
REFRESH_RUN_2 = "2024-02-02 20:00:00"


@register("publish_by_date", O.sql("SELECT * FROM mart_quotes_all", "mart_quotes_all"))
def q_publish_by_date(spark, sf_dir):
    """M4: publish every day, then re-publish the newest day from its raw rows alone (a retry); read the table back."""
    mart = S.check_contract(quotes_mart_all(spark, sf_dir), S.DM_QUOTES_DAILY)  # M7 before any write
    path = work_path(spark, "dm_quotes_daily")
    P.publish_by_date(mart, path, "trade_date")
    P.publish_by_date(S.check_contract(QUERIES["mart_quotes_daily"](spark, sf_dir), S.DM_QUOTES_DAILY), path, "trade_date")
    return P.read_published(spark, path, S.DM_QUOTES_DAILY)


@register(
    "mart_refresh_log",
    O.sql(
        f"""
        WITH e AS (SELECT DISTINCT 'dm_quotes_daily' AS mart_name, trade_date AS execution_date FROM mart_quotes_all
                   UNION ALL
                   SELECT DISTINCT 'dm_fx_rates', rate_date FROM mart_fx_rates)
        SELECT mart_name, execution_date,
               CASE WHEN execution_date = max(execution_date) OVER (PARTITION BY mart_name)
                    THEN TIMESTAMP '{REFRESH_RUN_2}' ELSE TIMESTAMP '{REFRESH_RUN_1}' END AS refreshed_at
        FROM e""",
        "mart_quotes_all",
        "mart_fx_rates",
    ),
)
def q_mart_refresh_log(spark, sf_dir):
    """M5: log every (mart, day) refresh, then upsert a second run of each mart's newest day."""
    entries = (
        quotes_mart_all(spark, sf_dir)
        .select(F.lit("dm_quotes_daily").alias("mart_name"), F.col("trade_date").alias("execution_date"))
        .distinct()
        .unionByName(
            fx_mart(spark, sf_dir).select(F.lit("dm_fx_rates").alias("mart_name"), F.col("rate_date").alias("execution_date")).distinct()
        )
    )
    entries = _stored(entries, "refreshed")  # both runs take their days from it
    root = work_path(spark, "mart_refresh_log")
    run1 = entries.withColumn("refreshed_at", F.lit(REFRESH_RUN_1).cast("timestamp_ntz"))
    P.upsert_versioned(spark, root, run1, ["mart_name", "execution_date"], "refreshed_at", S.MART_REFRESH_LOG)
    newest = F.max("execution_date").over(Window.partitionBy("mart_name"))
    run2 = (
        entries.withColumn("_newest", newest)
        .where(F.col("execution_date") == F.col("_newest"))
        .drop("_newest")
        .withColumn("refreshed_at", F.lit(REFRESH_RUN_2).cast("timestamp_ntz"))
    )
    P.upsert_versioned(spark, root, run2, ["mart_name", "execution_date"], "refreshed_at", S.MART_REFRESH_LOG)
    return P.read_versioned(spark, root, S.MART_REFRESH_LOG)


@register("stream_raw_quotes", O.sql("SELECT * FROM raw_quotes", "raw_quotes"))
def q_stream_raw_quotes(spark, sf_dir):
    """Quote messages delivered twice (at-least-once) drained into raw, first wins."""
    base = work_path(spark, "stream_raw_quotes")
    msgs = MSG.quote_messages(tv.raw_quotes(spark, sf_dir)).select("message_value")
    msgs.write.text(f"{base}/landing")
    msgs.write.mode("append").text(f"{base}/landing")  # the replayed delivery
    X.drain_messages_to_raw(
        spark, f"{base}/landing", f"{base}/raw", f"{base}/quarantine", f"{base}/_checkpoint", S.RAW_QUOTES_KEY, S.RAW_QUOTES, "trade_date"
    )
    return X.read_loaded(spark, f"{base}/raw", S.RAW_QUOTES)


@register("stream_raw_rates", O.sql("SELECT * FROM raw_rates", "raw_rates"))
def q_stream_raw_rates(spark, sf_dir):
    """X1/S5 for the rates topic: rate messages delivered twice, drained first-wins into raw."""
    base = work_path(spark, "stream_raw_rates")
    msgs = MSG.rate_messages(tv.raw_rates(spark, sf_dir)).select("message_value")
    msgs.write.text(f"{base}/landing")
    msgs.write.mode("append").text(f"{base}/landing")  # the replayed delivery
    X.drain_messages_to_raw(
        spark, f"{base}/landing", f"{base}/raw", f"{base}/quarantine", f"{base}/_checkpoint",
        S.RAW_RATES_KEY, S.RAW_RATES, decode=MSG.decode_rate_messages,
    )
    return X.read_loaded(spark, f"{base}/raw", S.RAW_RATES)


def _event_stream(spark, sf_dir):
    schema = tv.events_ticks(spark, sf_dir).schema
    return schema, spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@register("stream_dedup", "SELECT * FROM events")
def q_stream_dedup(spark, sf_dir):
    """The event stream read twice and unioned, then all of it delivered again: one row per event."""
    schema, s1 = _event_stream(spark, sf_dir)
    _, s2 = _event_stream(spark, sf_dir)
    base = work_path(spark, "stream_dedup")
    for k, stream in enumerate((s1.unionByName(s2), _event_stream(spark, sf_dir)[1])):
        X.first_wins_stream(spark, stream, f"{base}/out", f"{base}/_checkpoint-{k}", ["event_id"], "ts", ["ts"])
    return P.read_loads(spark, f"{base}/out", schema)


UNTIMED = 10**12  # added to the ids of the copies without a time

_EVENTS_AND_UNTIMED = f"SELECT * FROM events UNION ALL SELECT * REPLACE (event_id + {UNTIMED} AS event_id, CAST(NULL AS TIMESTAMP) AS ts) FROM events"


def _land_halves(spark, sf_dir, landing: str) -> list[str]:
    """The newer half of the events, the older half and copies of all without a time, each in a folder of its own."""
    events = tv.events_ticks(spark, sf_dir)
    middle = events.select(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), 0.5)).scalar()
    newer = F.unix_micros(F.col("ts").cast("timestamp")) > middle
    untimed = events.withColumns({"event_id": F.col("event_id") + UNTIMED, "ts": F.lit(None).cast("timestamp_ntz")})
    parts = {"newer": events.where(newer), "older": events.where(~newer), "untimed": untimed}
    for name, rows in parts.items():
        rows.hint("rebalance").write.parquet(f"{landing}/{name}")
    return [f"{landing}/{name}" for name in parts]


@register("stream_two_feeds", _EVENTS_AND_UNTIMED)
def q_stream_two_feeds(spark, sf_dir):
    """Two feeds with checkpoints of their own, the second with rows without a time, and a new checkpoint of the first, into one table."""
    schema, base = tv.events_ticks(spark, sf_dir).schema, work_path(spark, "stream_two_feeds")
    newer, older, untimed = _land_halves(spark, sf_dir, f"{base}/landing")
    for k, paths in enumerate(([newer], [older, untimed], [newer])):
        for path in paths:
            X.first_wins_stream(spark, spark.readStream.schema(schema).parquet(path), f"{base}/out", f"{base}/_checkpoint-{k}-{path.rpartition('/')[2]}", ["event_id"], "ts", ["ts"])
    return X.read_loaded(spark, f"{base}/out", schema)


@register("stream_dedup_state", _EVENTS_AND_UNTIMED)
def q_stream_dedup_state(spark, sf_dir):
    """X2 by the state store: the newer half first, then what lies behind the watermark, rows without a time, and all once more."""
    schema, base = tv.events_ticks(spark, sf_dir).schema, work_path(spark, "stream_dedup_state")
    landed = [spark.read.schema(schema).parquet(p) for p in _land_halves(spark, sf_dir, f"{base}/landed")]
    for rows in [*landed, *landed]:
        rows.write.mode("append").parquet(f"{base}/landing")
        X.dedup_stream(spark, spark.readStream.schema(schema).parquet(f"{base}/landing"), f"{base}/out", f"{base}/_checkpoint", ["event_id"], "ts", ["ts"], "1 day")
    return X.read_loaded(spark, f"{base}/out", schema)


@register("stream_sat_delta", O.sql("SELECT * FROM sat_quote_prices", "sat_quote_prices"))
def q_stream_sat_delta(spark, sf_dir):
    """Raw loads landed in arrival order, satellite delta per micro-batch = bulk history."""
    base = work_path(spark, "stream_sat_delta")
    raw = tv.raw_quotes(spark, sf_dir)
    # Each load is drained before the next one lands: two micro-batches, however many files the loads have.
    for name in (tv.INTRADAY_SOURCE, tv.EOD_SOURCE):
        raw.where(F.col("source") == name).hint("rebalance").write.mode("append").parquet(f"{base}/landing")
        source = spark.readStream.schema(S.RAW_QUOTES).parquet(f"{base}/landing")
        X.satellite_stream(
            spark, source, f"{base}/sat", f"{base}/_checkpoint", QUOTE_GRAIN, SAT_QUOTE_COLS, S.SAT_QUOTE_PRICES, quote_versions, "trade_date"
        )
    return X.read_satellite(spark, f"{base}/sat", S.SAT_QUOTE_PRICES)


@register(
    "stream_ohlc",
    """
    SELECT CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS trade_date,
           arg_min(CAST(value AS DECIMAL(18,6)), (ts, event_id)) AS open_price,
           max(CAST(value AS DECIMAL(18,6))) AS high_price,
           min(CAST(value AS DECIMAL(18,6))) AS low_price,
           arg_max(CAST(value AS DECIMAL(18,6)), (ts, event_id)) AS close_price,
           count(*) AS volume
    FROM events GROUP BY user_id, CAST(ts AS DATE)""",
)
def q_stream_ohlc(spark, sf_dir):
    """Daily OHLC bars from the tick stream, the still-open last day included."""
    _, ticks = _event_stream(spark, sf_dir)
    base = work_path(spark, "stream_ohlc")
    X.ohlc_stream(spark, ticks, f"{base}/parts", f"{base}/bars", f"{base}/_checkpoint")
    return X.read_bars(spark, f"{base}/bars")


@register(
    "quarantine_summary",
    O.sql(
        """
        WITH rules AS (
          SELECT 'quote_rules' AS stage, v.* FROM (VALUES ('negative', 'prices_non_negative'), ('above_high', 'high_is_max'), ('no_volume', 'volume_required'),
            ('lost_volume', 'volume_non_negative'), ('no_date', 'trade_date_required'), ('no_close', 'prices_required'), ('no_source', 'source_required'),
            ('long_symbol', 'symbol_max_20'), ('no_symbol', 'symbol_required')) v(defect, reason)
          UNION ALL
          SELECT 'rate_rules', v.* FROM (VALUES ('zero', 'rate_positive'), ('same', 'distinct_currencies'), ('no_code', 'currencies_required'),
            ('long_code', 'currency_max_10'), ('no_date', 'rate_date_required'), ('no_source', 'source_required')) v(defect, reason)
        ), broken AS (
          SELECT 'quote_rules' AS stage, defect, source FROM quote_defects UNION ALL SELECT 'rate_rules', defect, source FROM rate_defects
        ), days AS (SELECT DISTINCT rate_date, source FROM rate_quotes)
        SELECT 'quotes_json' AS stage, reason, source, count(*) AS n_rows FROM (SELECT reason, source FROM bad_quote_documents UNION ALL SELECT reason, source FROM bad_quote_days) GROUP BY ALL
        UNION ALL
        SELECT 'rates_xml', reason, source, count(*) FROM rate_quotes CROSS JOIN (VALUES ('zero_nominal'), ('bad_nominal'), ('bad_value')) v(reason) GROUP BY ALL
        UNION ALL
        SELECT 'rates_xml', reason, source, count(*) FROM days CROSS JOIN (VALUES ('no_rates'), ('corrupt_document')) v(reason) GROUP BY ALL
        UNION ALL
        SELECT 'quote_messages', reason, CASE WHEN reason = 'corrupt_json' THEN 'unknown' ELSE source END AS source, count(*)
        FROM raw_quotes CROSS JOIN (VALUES ('corrupt_json'), ('missing_field'), ('bad_type')) v(reason) GROUP BY ALL
        UNION ALL
        SELECT 'rate_messages', reason, CASE WHEN reason = 'corrupt_json' THEN 'unknown' ELSE source END AS source, count(*)
        FROM raw_rates CROSS JOIN (VALUES ('corrupt_json'), ('missing_field'), ('bad_type')) v(reason) GROUP BY ALL
        UNION ALL
        SELECT stage, reason, source, count(*) FROM broken JOIN rules USING (stage, defect) GROUP BY ALL""",
        "bad_quote_documents",
        "bad_quote_days",
        "rate_quotes",
        "raw_rates",
        "quote_defects",
        "rate_defects",
    ),
)
def q_quarantine_summary(spark, sf_dir):
    """Quarantined rows by stage, reason and source over every parser and rule set, each fed every kind of defect."""
    raw, rates, tz = tv.raw_quotes(spark, sf_dir), tv.raw_rates(spark, sf_dir), session_tz(spark)
    valutes = dv.defective_valutes(tv.rate_quotes(spark, sf_dir))
    texts = RX.valcurs_from_quotes(valutes.withColumn("source", F.concat_ws(" ", "source", "defect")))
    days = tv.rate_quotes(spark, sf_dir).select("rate_date", "source").distinct()
    header = F.date_format("rate_date", "dd.MM.yyyy")
    broken = days.select("rate_date", "source", F.explode(F.array(F.concat(F.lit('<ValCurs Date="'), header, F.lit('"></ValCurs>')), F.concat(F.lit('<ValCurs Date="'), header, F.lit('"><Valute><Char')))).alias("xml_text"))
    docs = RX.documents_from_xml_text(texts.withColumn("source", F.split("source", " ")[0]).select("rate_date", "source", "xml_text").unionByName(broken))
    _, bad_xml = RX.parse_valcurs(docs, requested_date="rate_date", source="source")
    _, bad_qmsg = MSG.decode_quote_messages(dv.defective_messages(MSG.quote_messages(raw), "volume"), tz=tz)
    _, bad_rmsg = MSG.decode_rate_messages(dv.defective_messages(MSG.rate_messages(rates), "rate"), tz=tz)
    _, bad_qrules = Q.validate(dv.defective_quotes(raw), Q.quote_rules())
    _, bad_rrules = Q.validate(dv.defective_rates(rates), Q.rate_rules())
    stages = [
        ("quotes_json", Q.union_all([QJ.parse_quote_responses(d, mode="all", source="source")[1] for d in _bad_quote_docs(spark, sf_dir)])),
        ("rates_xml", bad_xml),
        ("quote_messages", bad_qmsg),
        ("rate_messages", bad_rmsg),
        ("quote_rules", bad_qrules),
        ("rate_rules", bad_rrules),
    ]
    return Q.union_all(
        [Q.quarantine_summary(df).select(F.lit(name).alias("stage"), "reason", "source", "n_rows") for name, df in stages]
    )


# ------------------------------------------------------------ one whole run
RUN_TIMES = ("2024-02-01 12:00:00", O.MART_LOADED_AT)  # of the morning's and the evening's run


# The rates come with the first run, so their mart is not built again by the second.  The bank's
# documents bear the run's time, which is later than the times in the second feed's messages.
_MARTS = f"""
    SELECT 'dm_quotes_daily' AS mart, trade_date AS day, instrument_bk AS first_key, exchange AS second_key,
           CAST(close_price AS DECIMAL(18,8)) AS first_value, daily_return_pct AS second_value, loaded_at FROM mart_quotes_all
    UNION ALL
    SELECT 'dm_fx_rates', rate_date, base_currency, target_currency, CAST(rate AS DECIMAL(18,8)), NULL, TIMESTAMP '{RUN_TIMES[0]}'
    FROM (SELECT * FROM raw_rates QUALIFY row_number() OVER (PARTITION BY base_currency, target_currency, rate_date ORDER BY source = 'cbr' DESC) = 1)"""


@register("warehouse_end_to_end", O.sql(_MARTS, "mart_quotes_all", "raw_rates"))
def q_warehouse_end_to_end(spark, sf_dir):
    """Landed JSON responses, rate XML, rate and instrument messages -> raw -> vault -> gates -> marts, in two runs.

    The files hold all quotes, instruments and rates of both feeds, each
    response in its own file, and are read by the readers a user has; the
    second run finds those of the first and reads its own.
    """
    base = work_path(spark, "warehouse")
    responses = QJ.responses_from_quotes(tv.raw_quotes(spark, sf_dir))
    rates = tv.rate_quotes(spark, sf_dir)
    listed = tv.raw_instruments(spark, sf_dir)
    MSG.instrument_messages(listed.withColumn("exchange", F.coalesce("exchange", F.lit(M.UNKNOWN)))).select("message_value").write.text(f"{base}/landing/instruments")
    RX.valcurs_from_quotes(rates.where(F.col("source") == tv.CBR_SOURCE)).select("xml_text").write.text(f"{base}/landing/rates")
    # The second feed delivers as it quotes: the other way round.
    second = tv.raw_rates(spark, sf_dir).where(F.col("source") == tv.API_SOURCE)
    MSG.rate_messages(normalize_rate_direction(second, False).select(*RAW_RATE_COLS)).select("message_value").write.text(f"{base}/landing/rate_messages")
    source = F.regexp_extract("doc_id", "source=([^/]+)/", 1)
    folders = {name: f"{base}/landing/{name}" for name in ("quotes", "rates", "rate_messages", "instruments")}
    for k, name in enumerate((tv.INTRADAY_SOURCE, tv.EOD_SOURCE)):
        QJ.land_responses(responses.where(F.col("source") == name), folders["quotes"], 4 * spark.sparkContext.defaultParallelism)
        status = D.run_load(spark, f"{base}/wh", name, datetime.fromisoformat(RUN_TIMES[k]), quote_source=source, rate_source=F.lit(tv.CBR_SOURCE), **folders)
        if status != "ok":
            raise ValueError(f"run {name}: {status}")
    quotes = P.read_published(spark, D.table_path(f"{base}/wh", "dm", "dm_quotes_daily"), S.DM_QUOTES_DAILY)
    fx = P.read_published(spark, D.table_path(f"{base}/wh", "dm", "dm_fx_rates"), S.DM_FX_RATES)
    wide = lambda c: F.col(c).cast("decimal(18,8)")
    one = quotes.select(F.lit("dm_quotes_daily").alias("mart"), F.col("trade_date").alias("day"), F.col("instrument_bk").alias("first_key"), F.col("exchange").alias("second_key"), wide("close_price").alias("first_value"), F.col("daily_return_pct").alias("second_value"), "loaded_at")
    two = fx.select(F.lit("dm_fx_rates").alias("mart"), F.col("rate_date").alias("day"), F.col("base_currency").alias("first_key"), F.col("target_currency").alias("second_key"), F.col("rate").alias("first_value"), F.lit(None).cast(S.RETURN_PCT).alias("second_value"), "loaded_at")
    return one.unionByName(two)


# --------------------------------------------------- extension analytics (EXT)

AS_OF = "2024-01-15 12:00:00"  # point in time of the E5 query (a parameter)


@register(
    "fx_rate_asof",
    O.sql(
        """
        WITH b AS (SELECT base_currency, target_currency, min(rate_date) AS lo FROM mart_fx_rates GROUP BY 1, 2),
             spine AS (SELECT base_currency, target_currency,
                              CAST(unnest(generate_series(lo, (SELECT max(rate_date) FROM mart_fx_rates), INTERVAL 1 DAY)) AS DATE) AS as_of_date
                       FROM b),
             j AS (SELECT s.*, f.rate, f.rate_date AS rd FROM spine s LEFT JOIN mart_fx_rates f
                     ON s.base_currency = f.base_currency AND s.target_currency = f.target_currency AND s.as_of_date = f.rate_date)
        SELECT base_currency, target_currency, as_of_date,
               last_value(rate IGNORE NULLS) OVER w AS rate, last_value(rd IGNORE NULLS) OVER w AS rate_date
        FROM j WINDOW w AS (PARTITION BY base_currency, target_currency ORDER BY as_of_date
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        "mart_fx_rates",
    ),
)
def q_fx_rate_asof(spark, sf_dir):
    """E1 (EXT): last known rate of every pair on every calendar day."""
    return A.rate_as_of(fx_mart(spark, sf_dir))


@register(
    "quote_returns",
    O.sql(
        """
        SELECT instrument_bk, trade_date, close_price, prev_close,
               CAST(CASE WHEN prev_close <> 0 THEN round((close_price - prev_close) / prev_close * 100, 4) END AS DECIMAL(18,4)) AS dod_return_pct,
               CAST(ma AS DECIMAL(18,6)) AS close_ma5
        FROM (SELECT instrument_bk, trade_date, close_price,
                     lag(close_price) OVER (PARTITION BY instrument_bk ORDER BY trade_date) AS prev_close,
                     avg(close_price) OVER (PARTITION BY instrument_bk ORDER BY trade_date
                                            ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS ma
              FROM mart_quotes_all)""",
        "mart_quotes_all",
    ),
)
def q_quote_returns(spark, sf_dir):
    """E2 (EXT): day-over-day return and 5-row moving average per instrument."""
    return A.quote_returns(quotes_mart_all(spark, sf_dir))


@register(
    "exchange_rollup",
    O.sql(
        """
        SELECT exchange, asset_type, CAST(grouping_id(exchange, asset_type) AS BIGINT) AS grouping_level,
               count(*) AS n_rows, CAST(sum(volume) AS BIGINT) AS total_volume, sum(daily_return_pct) AS sum_return_pct
        FROM mart_quotes_all GROUP BY ROLLUP (exchange, asset_type)""",
        "mart_quotes_all",
    ),
)
def q_exchange_rollup(spark, sf_dir):
    """E3 (EXT): rollup of volume and returns by exchange and asset type."""
    return A.exchange_rollup(quotes_mart_all(spark, sf_dir))


@register(
    "top_movers",
    O.sql(
        """
        SELECT trade_date, instrument_bk, daily_return_pct, CAST(rank AS INTEGER) AS rank FROM (
          SELECT trade_date, instrument_bk, daily_return_pct,
                 row_number() OVER (PARTITION BY trade_date ORDER BY abs(daily_return_pct) DESC, instrument_bk) AS rank
          FROM mart_quotes_all) WHERE rank <= 10""",
        "mart_quotes_all",
    ),
)
def q_top_movers(spark, sf_dir):
    """E4 (EXT): top 10 absolute movers per day (the limit is the feature)."""
    return A.top_movers(quotes_mart_all(spark, sf_dir))


@register(
    "sat_as_of",
    O.sql(
        f"""
        SELECT * FROM (SELECT * FROM sat_quote_prices WHERE load_date <= TIMESTAMP '{AS_OF}')
        QUALIFY rank() OVER (PARTITION BY hub_instrument_hk, trade_date ORDER BY load_date DESC) = 1""",
        "sat_quote_prices",
    ),
)
def q_sat_as_of(spark, sf_dir):
    """E5 (EXT): every satellite grain as it stood at a point in time."""
    sat = sat_quotes(tv.raw_quotes(spark, sf_dir))
    return A.satellite_as_of(sat, QUOTE_GRAIN, F.lit(AS_OF).cast("timestamp_ntz"))
