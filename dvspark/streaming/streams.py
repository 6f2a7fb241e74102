"""Structured Streaming ingestion.

All streams are bounded drains with ``trigger(availableNow=True)``: they
process everything landed so far in micro-batches, commit offsets to the
checkpoint, and stop - the set-based version of the reference's
"poll until 10 empty polls" consumer.  Restarting with the same checkpoint
continues where the last run stopped.

What a batch writes goes under a load id made of the checkpoint's own identity
and the batch's number, so feeds, and new checkpoints of a feed, into one table
never touch each other's rows.  The load's folder is the record that the batch
is done: a batch that is run again after a crash (written, but not committed to
the checkpoint) changes nothing, and one that had not got so far is written in
full.  What a new checkpoint delivers again falls to the first-wins rule or the
hash-diff delta of the stored tables.

Checkpoints and sinks live under the shared folder named by
``spark.checkpoint.dir`` (see :mod:`dvspark.session`).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, StructField, StructType

from dvspark.functions.cols import event_time, utc_now
from dvspark.operators import publish as P
from dvspark.operators import raw as R
from dvspark.operators import vault as V
from dvspark.schemas import PRICE
from dvspark.session import session_tz
from dvspark.sources import messages as MSG


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id that Structured Streaming gives a checkpoint when it is made, and keeps in it."""
    return json.loads(P.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def batch_load_id(stream: str, batch_id: int) -> str:
    return f"{stream}-{batch_id:09d}"


def read_loaded(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table written by the stream sinks, without its ``load_id`` column."""
    return P.read_loads(spark, path, schema)


def _run_time(spark: SparkSession, checkpoint: str, load_id: str) -> Column:
    """When a batch first ran: recorded beside the checkpoint, so a replay of the batch reads the same time."""
    path = f"{checkpoint.rstrip('/')}-run-times/{load_id}"
    if not P.exists(spark, path):
        spark.range(1).select(utc_now().alias("run_at")).coalesce(1).write.parquet(path + "-writing", mode="overwrite")
        P.rename(spark, path + "-writing", path)
    return F.lit(spark.read.schema("run_at timestamp_ntz").parquet(path).first().run_at).cast("timestamp_ntz")


def _drain(spark: SparkSession, stream: DataFrame, checkpoint: str, is_done: Callable[[str], bool], load: Callable[[DataFrame, str], None], stateful: bool = False):
    """Runs ``load(batch, load_id)`` for every batch that isn't done yet; the last thing that ``load`` does makes it so.

    ``stateful``: the batch of a finished load is computed even so, as that is what writes the state store.
    """
    identity = cache(lambda: stream_identity(spark, checkpoint))

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        load_id = batch_load_id(identity(), batch_id)
        if is_done(load_id):
            if stateful:
                batch.write.format("noop").mode("overwrite").save()
            return
        held = batch.persist()
        try:
            load(held, load_id)
        finally:
            held.unpersist()

    q = stream.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def _held(spark: SparkSession, target: str) -> Callable[[str], bool]:
    return lambda load_id: P.has_load(spark, target, load_id)


def _first_wins_load(spark: SparkSession, rows: DataFrame, target: str, load_id: str, key: Sequence[str], schema: StructType, date_col: str | None, order_by=("loaded_at",)) -> None:
    """Appends the first arrivals that other loads of the table lack; by ``date_col``, its stored rows are read between the batch's dates only."""
    existing = P.read_loads(spark, target, schema, exclude_load=load_id)
    if existing is not None and date_col is not None:
        existing = V.within_dates(existing, rows, date_col)
    new_rows = R.first_wins(rows, key, existing, order_by).select(*[f.name for f in schema.fields])
    P.append_load(new_rows, target, load_id, [date_col] if date_col else [])


def drain_messages_to_raw(
    spark: SparkSession,
    landing: str,
    target: str,
    quarantine: str,
    checkpoint: str,
    key: Sequence[str],
    schema: StructType,
    date_col: str | None = None,
    max_files_per_trigger: int = 64,
    decode=None,
):
    """Landed JSON messages (one per line) -> raw table, first arrival wins.

    ``date_col``: business date to store by; none for the few dozen rates a day.

    ``decode(batch, tz, value_col, default_loaded_at) -> (good, bad)``: quote
    messages by default, :func:`dvspark.sources.messages.decode_rate_messages`
    for rates.

    Each micro-batch is read once, decoded (bad messages to ``quarantine``),
    reduced to first arrivals and anti-joined with the stored days it touches,
    then written under its own ``load_id``.  The anti join ignores the batch's
    own load and the default ``loaded_at`` is the batch's recorded run time, so
    a batch that crashed half-way and is run again writes the same rows.
    """
    tz = session_tz(spark)
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger).load(landing)

    def load(batch: DataFrame, load_id: str) -> None:
        good, bad = (decode or MSG.decode_quote_messages)(batch, tz=tz, value_col="value", default_loaded_at=_run_time(spark, checkpoint, load_id))
        P.append_load(bad, quarantine, load_id)
        _first_wins_load(spark, good, target, load_id, key, schema, date_col)

    return _drain(spark, stream, checkpoint, _held(spark, target), load)


def first_wins_stream(spark: SparkSession, events: DataFrame, target: str, checkpoint: str, key: Sequence[str], ts_col: str, order_by: Sequence[str]):
    """An event stream into a table by event day, one row per key, however late a row or its copy comes.

    The stored table is the memory, so no watermark decides what is lost;
    rows of a key carry the same event time, so a batch looks at its days only
    (events without a time: at those without one).
    """
    day = "event_date"
    schema = StructType([*events.schema.fields, StructField(day, DateType(), True)])

    def load(batch: DataFrame, load_id: str) -> None:
        _first_wins_load(spark, batch.withColumn(day, F.to_date(ts_col)), target, load_id, key, schema, day, order_by)

    return _drain(spark, events, checkpoint, _held(spark, target), load)


def dedup_stream(spark: SparkSession, events: DataFrame, target: str, checkpoint: str, key: Sequence[str], ts_col: str, order_by: Sequence[str], delay: str):
    """X2 with the copies removed inside the stream: those within ``delay`` by the state store, the rest by the stored table.

    The state holds the keys of the last ``delay`` only.  Rows that it can't
    judge take the way of :func:`first_wins_stream`, so none is lost: those
    behind the watermark, which the stateful operator throws away, and those
    without a time.  The batch knows them by the newest event time of the
    batches before, which is where the watermark comes from.  Rows of the
    state's way are compared only with what other streams wrote into the table.
    """
    day, tz = "event_date", session_tz(spark)
    schema = StructType([*events.schema.fields, StructField(day, DateType(), True)])
    fields = [f.name for f in schema.fields]
    timed = events.where(F.col(ts_col).isNotNull()).withColumn("_et", event_time(ts_col, tz)).withWatermark("_et", delay)
    once = timed.dropDuplicatesWithinWatermark(list(key)).drop("_et").withColumn("_once", F.lit(True))
    both = once.unionByName(events.withColumn("_once", F.lit(False)))
    seen = f"{checkpoint.rstrip('/')}-newest"

    def load(batch: DataFrame, load_id: str) -> None:
        stream = load_id.rpartition("-")[0]
        before = P.read_loads(spark, seen, StructType([StructField("newest", schema[ts_col].dataType, True)]), exclude_load=load_id, keep_id=True)
        newest = before.where(F.col("load_id").startswith(stream)).agg(F.max("newest")).first()[0] if before is not None else None
        behind = F.col(ts_col).isNull()
        if newest is not None:
            behind = behind | (F.col(ts_col) <= F.lit(newest) - F.expr(f"INTERVAL {delay}"))
        rows = batch.withColumn(day, F.to_date(ts_col))
        fresh, late = rows.where("_once").select(*fields), rows.where(~F.col("_once") & behind).select(*fields)
        stored = P.read_loads(spark, target, schema, exclude_load=load_id, keep_id=True)
        if stored is not None:
            others = stored.where(~F.col("load_id").startswith(stream)).select(*fields)
            fresh = R.first_wins(fresh, key, V.within_dates(others, fresh, day), order_by)
            late = R.first_wins(late, key, V.within_dates(stored.select(*fields), late, day), order_by)
        # What the state let through is not late; the watermark may lag behind the newest time of the batches before.
        new = R.first_wins(fresh.unionByName(late), key, None, order_by).select(*fields)
        P.append_load(batch.agg(F.max(ts_col).alias("newest")), seen, load_id)
        P.append_load(new, target, load_id, [day])

    return _drain(spark, both, checkpoint, _held(spark, target), load, stateful=True)


def satellite_stream(
    spark: SparkSession,
    source: DataFrame,
    target: str,
    checkpoint: str,
    grain: Sequence[str],
    columns: Sequence[str],
    schema: StructType,
    prepare,
    date_col: str,
):
    """Per micro-batch, the satellite delta (T3/T7) against the stored satellite.

    One table and one write a batch: all versions as they arrived, and which of
    them the satellite has (``_kept``, see :func:`read_satellite`), read between
    the batch's dates only.  So a late version is put in its place, and one that
    was dropped as unchanged and is a change now is written again as kept.
    """
    stored_schema = StructType([*schema.fields, StructField("_kept", BooleanType(), True)])
    version = [*grain, "load_date", "hash_diff"]

    def load(batch: DataFrame, load_id: str) -> None:
        versions = prepare(batch).select(*columns)
        stored = P.read_loads(spark, target, stored_schema, exclude_load=load_id)
        if stored is None:
            delta = V.satellite_delta(versions, None, grain)
        else:
            near = V.within_dates(stored, versions, date_col)
            delta = V.satellite_delta(versions, near.where("_kept").select(*columns), grain, arrivals=near.select(*columns))
        marked = delta.withColumn("_kept", F.lit(True)).unionByName(versions.withColumn("_kept", F.lit(False)))
        every = [c for c in columns if c not in version]
        rows = marked.groupBy(*version, *every).agg(F.max("_kept").alias("_kept"))
        P.append_load(rows.select(*columns, "_kept"), target, load_id, [date_col])

    return _drain(spark, source, checkpoint, _held(spark, target), load)


def read_satellite(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The versions that :func:`satellite_stream` kept."""
    return P.read_loads(spark, path, StructType([*schema.fields, StructField("_kept", BooleanType(), True)])).where("_kept").drop("_kept")


def _bar_parts(ticks: DataFrame) -> DataFrame:
    """Bars of some ticks, with the ticks that opened and closed them, so that bars of one day can be put together."""
    px, at = F.col("value").cast(PRICE), F.struct("ts", "event_id")
    return ticks.groupBy(F.col("user_id").cast("string").alias("symbol"), F.to_date("ts").alias("trade_date")).agg(
        F.min(F.struct(at.alias("at"), px.alias("price"))).alias("first_tick"),
        F.max(px).alias("high_price"),
        F.min(px).alias("low_price"),
        F.max(F.struct(at.alias("at"), px.alias("price"))).alias("last_tick"),
        F.count(F.lit(1)).alias("volume"),
    )


def _put_together(parts: DataFrame) -> DataFrame:
    return parts.groupBy("symbol", "trade_date").agg(
        F.min("first_tick").alias("first_tick"), F.max("high_price").alias("high_price"), F.min("low_price").alias("low_price"), F.max("last_tick").alias("last_tick"), F.sum("volume").alias("volume")
    ).select("symbol", "trade_date", F.col("first_tick.price").alias("open_price"), "high_price", "low_price", F.col("last_tick.price").alias("close_price"), "volume")


def ohlc_of_ticks(ticks: DataFrame) -> DataFrame:
    """Daily bars of ticks; open and close by (ts, event_id).  Ticks without a time are a bar without a day."""
    return _put_together(_bar_parts(ticks))


def ohlc_stream(spark: SparkSession, ticks: DataFrame, parts: str, target: str, checkpoint: str):
    """Ticks -> daily bars, the open day, late ticks and ticks without a time included.

    Each batch's ticks become parts of bars, one a symbol and day, stored by
    load and day; the bars of the days that the batch touched are put together
    again from their parts and replace those days.  No tick is read twice, a
    late one corrects its closed day, and the open day has a bar that grows.
    A feed that delivers ticks more than once goes through
    :func:`dedup_stream` first, as a bar doesn't know its ticks' ids.

    Several streams may feed one table: each stores its parts before it reads
    the others', and bars that were replaced meanwhile are put together anew.
    """
    schema = _bar_parts(spark.createDataFrame([], ticks.schema)).schema
    done = lambda load_id: f"{target.rstrip('/')}/_done/{load_id}"

    def load(batch: DataFrame, load_id: str) -> None:
        P.append_load(_bar_parts(batch), parts, load_id, ["trade_date"])
        own = P.read_loads(spark, parts, schema, only_load=load_id).select(F.col("trade_date").alias("_day"))
        while True:
            since = P.newest_version(spark, target)[1]
            every = V.within_dates(P.read_loads(spark, parts, schema), own.withColumnRenamed("_day", "trade_date"), "trade_date")
            touched = every.join(own.distinct(), F.col("trade_date").eqNullSafe(F.col("_day")), "left_semi")
            try:
                P.replace_partitions(_put_together(touched), target, "trade_date", spark=spark, since=since)
                break
            except P.Conflict:
                continue
        P.create_new(spark, done(load_id), "")

    return _drain(spark, ticks, checkpoint, lambda load_id: P.exists(spark, done(load_id)), load)


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """The newest bars of :func:`ohlc_stream`."""
    schema = ohlc_of_ticks(spark.createDataFrame([], "event_id long, ts timestamp_ntz, user_id long, value double")).schema
    return P.read_published(spark, path, schema)
