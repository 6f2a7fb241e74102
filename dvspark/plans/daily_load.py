"""Stored-table jobs: landed files -> raw -> vault -> gates -> marts of one run.

What the reference schedules as separate tasks, as functions over Parquet
tables below one warehouse root (zones ``raw/``, ``vault/``, ``dm/``):

* ``land_raw`` reads landed quote JSON, rate XML and instrument messages,
  checks every row, quarantines the bad ones and appends first arrivals;
* ``load_vault`` appends the hubs, links and satellites of one load;
* ``check_load`` counts what the load brought and checks its keys and
  references; ``run_load`` skips the marts of a load without rows and stops
  on a violation;
* ``build_marts`` publishes the daily quotes and FX marts for the given dates
  (replace-by-date) and upserts the refresh log.

Every table but the marts and the instrument details gets a ``load_id=<id>``
folder that a retried load replaces as a whole, and comparisons ignore the
load's own.  Quote tables are also partitioned by trade date and read between a
load's dates only; hubs and links by a hash bucket of their key, so the gates
read the buckets that a load touches; rates are some dozens of rows a day.  The
details are stored with their end dates, by bucket, and a load replaces the
buckets it touches.

A landed file is read once: ``raw/landed_files`` holds its path, time and size
with the load that landed it, and a load reads the files that no other load has.
The driver sees the names of a load's new files (as in Spark's own file
streams), touched buckets and days, and the gates' counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from dvspark import schemas as S
from dvspark.functions.cols import FilesWithBytes, binary_files, load_files
from dvspark.operators import marts as M
from dvspark.operators import profiles
from dvspark.operators import publish as P
from dvspark.operators import quality as Q
from dvspark.operators import raw as R
from dvspark.operators import vault as V
from dvspark.operators import warehouse as W
from dvspark.session import session_tz
from dvspark.sources import messages as MSG
from dvspark.sources import quotes_json as QJ
from dvspark.sources import rates_xml as RX

# Business-date partition column of each table (besides load_id).
DATE_PARTITION = {"raw_quotes": "trade_date", "sat_quote_prices": "trade_date"}

RAW_TABLES = {
    "raw_quotes": (S.RAW_QUOTES, S.RAW_QUOTES_KEY),
    "raw_rates": (S.RAW_RATES, S.RAW_RATES_KEY),
    "raw_instruments": (S.RAW_INSTRUMENTS, S.RAW_INSTRUMENTS_KEY),
}
VAULT_TABLES = {
    "hub_instrument": S.HUB_INSTRUMENT,
    "hub_market": S.HUB_MARKET,
    "hub_currency": S.HUB_CURRENCY,
    "lnk_quote_instrument": S.LNK_QUOTE_INSTRUMENT,
    "lnk_rate_currency": S.LNK_RATE_CURRENCY,
    "sat_quote_prices": S.SAT_QUOTE_PRICES,
    "sat_rate_values": S.SAT_RATE_VALUES,
    "sat_instrument_details": S.SAT_INSTRUMENT_DETAILS,
}
#: Primary key of each vault table.
KEYS = {
    "hub_instrument": ["hub_instrument_hk"],
    "hub_market": ["hub_market_hk"],
    "hub_currency": ["hub_currency_hk"],
    "lnk_quote_instrument": ["lnk_quote_instrument_hk"],
    "lnk_rate_currency": ["lnk_rate_currency_hk"],
    "sat_quote_prices": ["hub_instrument_hk", "trade_date", "load_date"],
    "sat_rate_values": ["lnk_rate_currency_hk", "rate_date", "load_date"],
    "sat_instrument_details": ["hub_instrument_hk", "load_date"],
}
#: (child, key, parent, key).  Reference data may come before an instrument's first quote, so its
#: satellite and its link are not held against the hub here (``vault_orphans`` counts them).
REFERENCES = [
    ("sat_quote_prices", "hub_instrument_hk", "hub_instrument", "hub_instrument_hk"),
    ("sat_rate_values", "lnk_rate_currency_hk", "lnk_rate_currency", "lnk_rate_currency_hk"),
    ("lnk_quote_instrument", "hub_market_hk", "hub_market", "hub_market_hk"),
    ("lnk_rate_currency", "hub_currency_hk_base", "hub_currency", "hub_currency_hk"),
    ("lnk_rate_currency", "hub_currency_hk_target", "hub_currency", "hub_currency_hk"),
]


#: Raw tables with a profile of each load: their business date, key and measure.
PROFILED = {"raw_quotes": ("trade_date", "symbol", "volume"), "raw_rates": ("rate_date", "target_currency", "rate")}
#: Buckets of hubs, links and details by the hash of their key.
BUCKETS = 16
BUCKETED = ["hub_instrument", "hub_market", "hub_currency", "lnk_quote_instrument", "lnk_rate_currency"]
DETAILS = "sat_instrument_details"

LANDED_FILES = StructType([StructField("feed", StringType()), StructField("path", StringType()), StructField("modified", TimestampType()), StructField("size", LongType())])
REJECTED = StructType([StructField(c, StringType()) for c in ("stage", "reason", "source", "payload")])


class GateError(RuntimeError):
    """A load broke a key or a reference; its marts are not built."""


def table_path(root: str, zone: str, name: str) -> str:
    return f"{root.rstrip('/')}/{zone}/{name}"


def bucket_of(key: str) -> Column:
    return F.lpad(F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("string"), 2, "0")


def read_raw(spark: SparkSession, root: str, name: str, exclude_load: str | None = None, only_load: str | None = None) -> DataFrame | None:
    return P.read_loads(spark, table_path(root, "raw", name), RAW_TABLES[name][0], exclude_load=exclude_load, only_load=only_load)


def _details(spark: SparkSession, root: str) -> DataFrame | None:
    """The details with the bucket and the load that brought each version."""
    path = table_path(root, "vault", DETAILS)
    schema = StructType([*VAULT_TABLES[DETAILS].fields, StructField("load_id", StringType()), StructField("bucket", StringType())])
    return P.read_published(spark, path, schema, "bucket") if P.exists(spark, path) else None


def read_vault(spark: SparkSession, root: str, name: str, exclude_load: str | None = None, only_load: str | None = None, buckets: Sequence[str] | None = None) -> DataFrame | None:
    """A vault table, optionally without the rows of one load, or its rows only, or some buckets (``None`` if never written)."""
    schema = VAULT_TABLES[name]
    if name == DETAILS:
        df = _details(spark, root)
        if df is None:
            return None
        df = df if exclude_load is None else df.where(F.col("load_id") != exclude_load)
        df = df if only_load is None else df.where(F.col("load_id") == only_load)
        df = df if buckets is None else df.where(F.col("bucket").isin(list(buckets)))
        return df.select(*schema.names)
    only = ("bucket", buckets) if buckets is not None and name in BUCKETED else None
    return P.read_loads(spark, table_path(root, "vault", name), schema, exclude_load=exclude_load, only_load=only_load, only=only)


def _append(root: str, zone: str, name: str, rows: DataFrame, load_id: str) -> None:
    schema = VAULT_TABLES[name] if zone == "vault" else RAW_TABLES[name][0]
    rows, parts = rows.select(*schema.names), [DATE_PARTITION[name]] if name in DATE_PARTITION else []
    if name in BUCKETED:
        rows, parts = rows.withColumn("bucket", bucket_of(KEYS[name][0])), ["bucket"]
    P.append_load(rows, table_path(root, zone, name), load_id, parts)


def new_files(spark: SparkSession, root: str, feed: str, folder: str, load_id: str) -> DataFrame:
    """The files below ``folder`` that no other load has landed, as rows of ``raw/landed_files``; their contents aren't read.

    A file that was written again (another time or size) is new.  One without
    bytes is taken as still being written and waits for a later load.
    """
    files = binary_files(spark, folder)
    found = files.select(F.lit(feed).alias("feed"), "path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))
    landed = P.read_loads(spark, table_path(root, "raw", "landed_files"), LANDED_FILES, exclude_load=load_id)
    return found if landed is None else found.join(landed, LANDED_FILES.names, "left_anti")


def land_raw(
    spark: SparkSession,
    root: str,
    load_id: str,
    loaded_at: Column,
    quotes: str | None = None,
    rates: str | None = None,
    instruments: str | None = None,
    quote_source: Column | None = None,
    rate_source: Column | None = None,
    rate_messages: str | None = None,
    swapped: bool = True,
) -> None:
    """New files of landed folders -> raw zone, bad documents and rows -> ``raw/quarantine``.

    ``rate_messages``: the second FX feed, as messages; ``swapped`` if it quotes
    the other way round, which is put right here, once (S11).
    ``loaded_at``: the run's time (a parameter, so a retry lands the same
    rows).  Sources default to the feeds' own names and may be columns over
    the document's path ``doc_id``.
    """
    bad: list[DataFrame] = []
    landed: list[DataFrame] = []
    parsed_once: list[DataFrame] = []
    tz = session_tz(spark)

    def files(feed: str, folder: str | None) -> list[str]:
        if folder is None:
            return []
        new = new_files(spark, root, feed, folder, load_id).hint("rebalance").persist()
        paths = FilesWithBytes(r.path for r in new.select("path").collect())  # of this load
        landed.append(new)
        return paths

    def once(df: DataFrame) -> DataFrame:
        """Documents or their rows, kept from the landing for the quarantine, so a file is opened and parsed once."""
        parsed_once.append(df.persist())
        return df

    def land(name: str, feeds: list[tuple[DataFrame, DataFrame, str]], rules: list) -> None:
        schema, key = RAW_TABLES[name]
        parsed = once(Q.union_all([rows.select(*schema.names, F.lit(stage).alias("_stage")) for rows, _, stage in feeds]))
        good, broken = Q.validate(parsed, rules)
        bad.extend(rejected.select(F.lit(stage).alias("stage"), "reason", "source", "payload") for _, rejected, stage in feeds)
        bad.append(broken.select(F.concat("_stage", F.lit("_rules")).alias("stage"), "reason", "source", F.to_json(F.struct(*schema.names)).alias("payload")))
        good = good.select(*schema.names)
        existing = read_raw(spark, root, name, exclude_load=load_id)
        if existing is not None and name in DATE_PARTITION:
            existing = V.within_dates(existing, good, DATE_PARTITION[name])
        _append(root, "raw", name, R.first_wins(good, key, existing), load_id)

    if paths := files("quotes", quotes):
        docs = once(QJ.read_quote_responses(spark, paths))
        land("raw_quotes", [(*QJ.parse_quote_responses(docs, mode="all", source=quote_source, loaded_at=loaded_at), "quotes_json")], Q.quote_rules())
    fx = []
    if paths := files("rates", rates):
        fx.append((*RX.parse_valcurs(once(RX.read_rates_xml(spark, paths)), source=rate_source, loaded_at=loaded_at), "rates_xml"))
    if paths := files("rate_messages", rate_messages):
        good, rejected = MSG.decode_rate_messages(load_files(spark.read.format("text"), spark, paths).withColumnRenamed("value", "message_value"), tz=tz, default_loaded_at=loaded_at)
        fx.append((W.normalize_rate_direction(good, not swapped), rejected, "rate_messages"))
    if fx:
        land("raw_rates", fx, Q.rate_rules())
    if paths := files("instruments", instruments):
        messages = load_files(spark.read.format("text"), spark, paths).withColumnRenamed("value", "message_value")
        land("raw_instruments", [(*MSG.decode_instrument_messages(messages, tz=tz, default_loaded_at=loaded_at), "instrument_messages")], Q.instrument_rules())
    if bad:
        P.append_load(Q.union_all(bad), table_path(root, "raw", "quarantine"), load_id)
    for df in parsed_once:
        df.unpersist()
    for name, (date_col, key, measure) in PROFILED.items():
        rows = read_raw(spark, root, name, only_load=load_id)
        if rows is not None:
            P.append_load(profiles.profile(rows, date_col, key=key, measure=measure), table_path(root, "raw", f"{name}_profiles"), load_id)
    if landed:  # last: a load that died before is landed again
        P.append_load(Q.union_all(landed), table_path(root, "raw", "landed_files"), load_id)
        for df in landed:
            df.unpersist()


def load_vault(
    spark: SparkSession,
    root: str,
    load_id: str,
    quotes: DataFrame | None = None,
    rates: DataFrame | None = None,
    instruments: DataFrame | None = None,
) -> None:
    """One raw -> vault load (H5-H7, L1, L2, T4, T5, T6) of newly landed raw rows.

    Versions of earlier loads come from the stored raw zone where there is
    one, so a load that arrives late is put in its place.
    """

    def write(name: str, rows: DataFrame) -> None:
        _append(root, "vault", name, rows, load_id)

    def stored(name: str) -> DataFrame | None:
        return read_vault(spark, root, name, exclude_load=load_id)

    def arrived(name: str, versions, columns: Sequence[str]) -> DataFrame | None:
        raw = read_raw(spark, root, name, exclude_load=load_id)
        return versions(raw).select(*columns) if raw is not None else None

    if quotes is not None:
        write("hub_instrument", W.hub_instrument(quotes, stored("hub_instrument")))
        versions = W.quote_versions(quotes).select(*W.SAT_QUOTE_COLS)
        write("sat_quote_prices", V.satellite_delta(versions, stored("sat_quote_prices"), W.QUOTE_GRAIN, arrived("raw_quotes", W.quote_versions, W.SAT_QUOTE_COLS), "trade_date"))
    if rates is not None:
        write("hub_currency", W.hub_currency(rates, stored("hub_currency")))
        write("lnk_rate_currency", W.lnk_rate_currency(rates, stored("lnk_rate_currency")))
        versions = W.rate_versions(rates).select(*W.SAT_RATE_COLS)
        write("sat_rate_values", V.satellite_delta(versions, stored("sat_rate_values"), W.RATE_GRAIN, arrived("raw_rates", W.rate_versions, W.SAT_RATE_COLS)))
    if instruments is not None:
        write("hub_market", W.hub_market(instruments, stored("hub_market")))
        write("lnk_quote_instrument", W.lnk_quote_instrument(instruments, stored("lnk_quote_instrument")))
        load_details(spark, root, load_id, W.details_versions(instruments))
    # Rows that no link can be made of, with the key part they lack.
    rejects = [(W.rejected_links(df), name) for df, name in ((instruments, "lnk_quote_instrument"), (rates, "lnk_rate_currency")) if df is not None]
    if rejects:
        rows = [df.select(F.lit(name).alias("stage"), "reason", "source", F.to_json(F.struct(*[c for c in df.columns if c != "reason"])).alias("payload")) for df, name in rejects]
        P.append_load(Q.union_all(rows), table_path(root, "vault", "quarantine"), load_id)


def load_details(spark: SparkSession, root: str, load_id: str, versions: DataFrame) -> None:
    """The details of a load's instruments, each version with its end date, in place of their buckets.

    The history of the touched instruments is made anew from all that arrived
    of them (the raw zone; where there is none, from the stored versions), so
    a late version is put in its place and ends its predecessor.  Instruments
    that an earlier attempt of the load brought are touched as well.  If another
    load replaced one of the buckets meanwhile, all is done again.
    """
    key, names = ["hub_instrument_hk"], VAULT_TABLES[DETAILS].names
    path = table_path(root, "vault", DETAILS)
    raw = P.read_loads(spark, table_path(root, "raw", "raw_instruments"), RAW_TABLES["raw_instruments"][0], exclude_load=load_id, keep_id=True)
    own = versions.withColumn("load_id", F.lit(load_id))
    while True:
        since, stored = P.newest_version(spark, path)[1], _details(spark, root)
        touched = versions.select(*key)
        if stored is not None:
            touched = touched.union(stored.where(F.col("load_id") == load_id).select(*key))
        touched = touched.distinct().withColumn("bucket", bucket_of(*key)).persist()
        buckets = sorted(r.bucket for r in touched.select("bucket").distinct().collect())  # at most BUCKETS
        try:
            every = own
            if raw is not None:
                every = every.unionByName(W.details_versions(raw, "load_id").join(touched, key, "left_semi"))
            elif stored is not None:
                of_keys = stored.where(F.col("bucket").isin(buckets) & (F.col("load_id") != load_id)).join(touched, key, "left_semi")
                every = every.unionByName(of_keys.select(*own.columns))
            rows = V.scd2(V.satellite_history(every, key), key).select(*names, "load_id").withColumn("bucket", bucket_of(*key))
            if stored is not None:
                rows = rows.unionByName(stored.where(F.col("bucket").isin(buckets)).join(touched.select(*key), key, "left_anti").select(*rows.columns))
            P.replace_partitions(rows, path, "bucket", buckets, spark, since)
            P.expire_versions(spark, path, keep=8)
            return
        except P.Conflict:
            continue
        finally:
            touched.unpersist()


def check_load(spark: SparkSession, root: str, load_id: str) -> DataFrame:
    """G1, T8, T9 for one load: (gate, subject, n) with its rows, and the duplicate keys and orphans among all it touched.

    Exact, and reads no more than the load and what it touches: of satellites
    its business dates, of hubs and links the buckets of the keys that it
    brought or refers to, of the details their buckets.
    """
    own = {name: df for name in VAULT_TABLES if (df := read_vault(spark, root, name, only_load=load_id)) is not None}
    parts, keys = [], {name: [df.select(*KEYS[name])] for name, df in own.items()}
    for child, key, parent, parent_key in REFERENCES:
        if child in own and parent in own:
            keys[parent].append(own[child].select(F.col(key).alias(parent_key)))
    for name, df in own.items():
        parts.append(df.agg(F.lit("rows").alias("gate"), F.lit(name).alias("subject"), F.count(F.lit(1)).alias("n")))
        touched = Q.union_all(keys[name]).distinct()
        if name in DATE_PARTITION:
            near = V.within_dates(read_vault(spark, root, name), df, DATE_PARTITION[name])
        elif name in (*BUCKETED, DETAILS):
            near = read_vault(spark, root, name, buckets=_buckets(touched, KEYS[name][0]))
        else:
            near = read_vault(spark, root, name)
        dup = Q.duplicate_check(name, near.join(touched, KEYS[name], "left_semi"), KEYS[name])
        parts.append(dup.select(F.lit("duplicates").alias("gate"), F.col("table_name").alias("subject"), F.col("duplicate_keys").alias("n")))
    for child, key, parent, parent_key in REFERENCES:
        if child in own:
            refers = own[child].select(F.col(key).alias(parent_key)).distinct()
            above = read_vault(spark, root, parent, buckets=_buckets(refers, parent_key)) if parent in own else spark.createDataFrame([], VAULT_TABLES[parent])
            parts.append(Q.orphan_check(f"{child}.{key}", own[child], key, above, parent_key).select(F.lit("orphans").alias("gate"), F.col("check_name").alias("subject"), F.col("orphan_rows").alias("n")))
    return Q.union_all(parts) if parts else spark.createDataFrame([], "gate string, subject string, n long")


def read_profiles(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The load profiles of a raw table, for the freshness and volume gates of :mod:`dvspark.operators.profiles`."""
    date_col, key, measure = PROFILED[name]
    shape = profiles.profile(spark.createDataFrame([], RAW_TABLES[name][0]), date_col, key=key, measure=measure).schema
    return P.read_loads(spark, table_path(root, "raw", f"{name}_profiles"), shape)


def _buckets(keys: DataFrame, key: str) -> list[str]:
    return [r.b for r in keys.select(bucket_of(key).alias("b")).distinct().collect()]  # at most BUCKETS


def run_load(spark: SparkSession, root: str, load_id: str, refreshed_at, **landed) -> str:
    """One scheduled run: land, load, check, and build the marts of the dates the load touched.

    Returns ``ok``, or ``skip`` where the load brought nothing new (no mart is
    built); raises :class:`GateError` on duplicate keys or orphans.
    """
    run_time = F.lit(refreshed_at).cast("timestamp_ntz")
    land_raw(spark, root, load_id, run_time, **landed)
    raw = {name: read_raw(spark, root, name, only_load=load_id) for name in RAW_TABLES}
    load_vault(spark, root, load_id, quotes=raw["raw_quotes"], rates=raw["raw_rates"], instruments=raw["raw_instruments"])
    gates = check_load(spark, root, load_id).where("n > 0").collect()  # a row for each table and reference
    broken = [f"{g.subject}: {g.n} {g.gate}" for g in gates if g.gate != "rows"]
    if broken:
        raise GateError("; ".join(broken))
    if not gates:
        return "skip"
    days = raw["raw_quotes"].select("trade_date").distinct().collect() if raw["raw_quotes"] is not None else []  # calendar days
    fx_days = raw["raw_rates"].select("rate_date").distinct().collect() if raw["raw_rates"] is not None else []
    build_marts(spark, root, sorted(r[0] for r in days), refreshed_at, fx_dates=sorted(r[0] for r in fx_days))
    return "ok"


def _publish(spark: SparkSession, root: str, name: str, mart: DataFrame, date_col: str, dates: Sequence) -> None:
    path = table_path(root, "dm", name)
    P.publish_by_date(mart, path, date_col, dates=list(dates), spark=spark)
    P.expire_versions(spark, path, keep=8)


def build_marts(spark: SparkSession, root: str, dates: Sequence, refreshed_at, fx: bool = True, fx_dates: Sequence | None = None) -> None:
    """M1/M3 for ``dates`` (rates: ``fx_dates``, the same by default) from the stored vault, replace-by-date publish, M5 log upsert."""
    run_time = F.lit(refreshed_at).cast("timestamp_ntz")
    fx_dates = list(dates) if fx_dates is None else list(fx_dates)
    sat, hub = read_vault(spark, root, "sat_quote_prices"), read_vault(spark, root, "hub_instrument")
    entries = []
    if dates and sat is not None and hub is not None:
        of_days = V.satellite_history(sat.where(F.col("trade_date").isin(list(dates))), W.QUOTE_GRAIN)
        mart = S.check_contract(M.mart_quotes_daily(of_days, hub, read_vault(spark, root, DETAILS), loaded_at=run_time), S.DM_QUOTES_DAILY)
        _publish(spark, root, "dm_quotes_daily", mart, "trade_date", dates)
        entries += [("dm_quotes_daily", d) for d in dates]
    sat_r = read_vault(spark, root, "sat_rate_values")
    if fx and fx_dates and sat_r is not None:
        link, hubc = read_vault(spark, root, "lnk_rate_currency"), read_vault(spark, root, "hub_currency")
        of_days = V.satellite_history(sat_r.where(F.col("rate_date").isin(fx_dates)), W.RATE_GRAIN)
        fx_mart = S.check_contract(M.mart_fx_rates(of_days, link, hubc, loaded_at=run_time), S.DM_FX_RATES)
        _publish(spark, root, "dm_fx_rates", fx_mart, "rate_date", fx_dates)
        # M6, from the days just written.
        written = P.read_published(spark, table_path(root, "dm", "dm_fx_rates"), S.DM_FX_RATES).where(F.col("rate_date").isin(fx_dates))
        _publish(spark, root, "dm_fx_cross_rates", S.check_contract(M.fx_cross_rates(written), S.DM_FX_CROSS_RATES), "rate_date", fx_dates)
        entries += [(name, d) for name in ("dm_fx_rates", "dm_fx_cross_rates") for d in fx_dates]
    if entries:
        log = spark.createDataFrame(entries, "mart_name string, execution_date date").withColumn("refreshed_at", run_time)
        P.upsert_versioned(
            spark, table_path(root, "dm", "mart_refresh_log"), log, ["mart_name", "execution_date"], "refreshed_at", S.MART_REFRESH_LOG
        )
