"""Stream sinks: replay after a crash between write and commit changes nothing."""

import os

from pyspark.sql import functions as F

from dvspark import schemas as S
from dvspark.plans import catalog as C
from dvspark.sources import messages as MSG
from dvspark.sources import testviews as tv
from dvspark.streaming import streams as X

from .conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _drop_last_commit(checkpoint: str) -> int:
    commits = os.path.join(checkpoint, "commits")
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    os.remove(os.path.join(commits, str(last)))
    crc = os.path.join(commits, f".{last}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    return last


def test_satellite_stream_replay_is_a_no_op(spark, tmp_dir):
    raw = tv.raw_quotes(spark, SF_SMALL)
    landing, target, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "sat", "_ckpt"))
    raw.where(F.col("source") == "intraday").write.parquet(landing)
    raw.where(F.col("source") == "eod").write.mode("append").parquet(landing)

    def run():
        src = spark.readStream.schema(S.RAW_QUOTES).option("maxFilesPerTrigger", 1).parquet(landing)
        X.satellite_stream(spark, src, target, ckpt, C.QUOTE_GRAIN, C.SAT_QUOTE_COLS, S.SAT_QUOTE_PRICES, C.quote_versions, "trade_date")
        return _rows(X.read_satellite(spark, target, S.SAT_QUOTE_PRICES))

    first = run()
    assert first == _rows(C.sat_quotes(raw))  # incremental stream = bulk history
    _drop_last_commit(ckpt)  # crash after the write, before the offset commit
    assert run() == first


def test_raw_drain_replay_and_duplicates(spark, tmp_dir):
    raw = tv.raw_quotes(spark, SF_SMALL)
    landing, target, bad, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "raw", "bad", "_ckpt"))
    msgs = MSG.quote_messages(raw).select("message_value")
    msgs.write.text(landing)
    msgs.write.mode("append").text(landing)  # delivered twice

    def run():
        X.drain_messages_to_raw(spark, landing, target, bad, ckpt, S.RAW_QUOTES_KEY, S.RAW_QUOTES, "trade_date")
        return _rows(X.read_loaded(spark, target, S.RAW_QUOTES))

    first = run()
    assert first == _rows(raw)
    _drop_last_commit(ckpt)
    assert run() == first


def test_ohlc_stream_in_other_session_time_zone(spark, tmp_dir):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        out = C.QUERIES["stream_ohlc"](spark, SF_SMALL)
        days = {r.trade_date for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    ev = tv.events_ticks(spark, SF_SMALL)
    all_days = {r.d for r in ev.select(F.to_date("ts").alias("d")).distinct().collect()}
    assert days == all_days  # calendar days of the wall clock, the open last day too


def _halves(spark, tmp_dir):
    """The older and the newer half of the events, and a folder to land them in."""
    ev = tv.events_ticks(spark, SF_SMALL)
    middle = ev.select(F.expr("percentile_approx(unix_micros(ts::timestamp), 0.5)")).first()[0]
    at = F.expr("unix_micros(ts::timestamp)")
    return ev, ev.where(at <= middle), ev.where(at > middle), os.path.join(tmp_dir, "landing")


def test_events_that_land_late_are_not_lost(spark, tmp_dir):
    ev, older, newer, landing = _halves(spark, tmp_dir)
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "_ckpt")
    for part in (newer, older, newer):  # newest first, then all again
        part.write.mode("append").parquet(landing)
        X.first_wins_stream(spark, spark.readStream.schema(ev.schema).parquet(landing), out, ckpt, ["event_id"], "ts", ["ts"])
    assert _rows(X.read_loaded(spark, out, ev.schema)) == _rows(ev)


def test_bars_of_late_ticks_are_corrected(spark, tmp_dir):
    ev, older, newer, landing = _halves(spark, tmp_dir)
    paths = [os.path.join(tmp_dir, n) for n in ("ticks", "bars", "_ckpt")]
    for part in (newer, older):
        part.write.mode("append").parquet(landing)
        X.ohlc_stream(spark, spark.readStream.schema(ev.schema).parquet(landing), *paths)
    expected = X.ohlc_of_ticks(ev)
    assert _rows(X.read_bars(spark, paths[1])) == _rows(expected)


def test_replayed_batch_keeps_its_default_time(spark, tmp_dir):
    landing, target, bad, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "raw", "bad", "_ckpt"))
    os.makedirs(landing)
    with open(os.path.join(landing, "a.json"), "w") as out:
        out.write('{"symbol": "Q7", "open": "4", "high": "5", "low": "3", "close": "4", "volume": 9, "trade_date": "2023-03-03", "source": "s"}\n')

    def run():
        X.drain_messages_to_raw(spark, landing, target, bad, ckpt, S.RAW_QUOTES_KEY, S.RAW_QUOTES, "trade_date")
        return _rows(X.read_loaded(spark, target, S.RAW_QUOTES))

    first = run()
    _drop_last_commit(ckpt)
    assert len(first) == 1 and run() == first


def test_landed_halves_are_written_by_as_many_tasks_as_their_size_asks_for(spark, tmp_dir):
    sizes = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    before = {k: spark.conf.get(k) for k in sizes}
    os.makedirs(os.path.join(tmp_dir, "sf"))
    rows = spark.range(20000).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts", "id % 7 AS user_id", "'tick' AS event_type", "CAST(id AS DOUBLE) AS value", "uuid() AS props")
    rows.coalesce(1).write.parquet(os.path.join(tmp_dir, "sf", "events.parquet"))
    try:
        for k in sizes:
            spark.conf.set(k, "65536")
        newer, older, untimed = C._land_halves(spark, os.path.join(tmp_dir, "sf"), os.path.join(tmp_dir, "landing"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for path in (newer, older, untimed):  # one file a folder would be one task for all that reads it
        assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) > 1
    landed = spark.read.parquet(newer).unionByName(spark.read.parquet(older))
    assert _rows(landed.select("event_id")) == [(k,) for k in range(20000)]
    assert _rows(spark.read.parquet(untimed).where("ts IS NULL").select("event_id")) == [(C.UNTIMED + k,) for k in range(20000)]


def test_state_query_lands_each_load_in_as_many_files_as_its_size_asks_for(spark, tmp_dir, monkeypatch):
    os.makedirs(os.path.join(tmp_dir, "sf"))
    rows = spark.range(20000).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts", "id % 7 AS user_id", "'tick' AS event_type", "CAST(id AS DOUBLE) AS value", "uuid() AS props")
    rows.coalesce(1).write.parquet(os.path.join(tmp_dir, "sf", "events.parquet"))
    sizes = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    before = {k: spark.conf.get(k) for k in sizes}
    files = [0]

    def drained(spark, events, target, *_):
        landing = os.path.join(os.path.dirname(target).removeprefix("file:"), "landing")
        files.append(len([f for f in os.listdir(landing) if f.endswith(".parquet")]))

    monkeypatch.setattr(C.X, "dedup_stream", drained)
    monkeypatch.setattr(C.X, "read_loaded", lambda *_: None)
    try:
        for k in sizes:
            spark.conf.set(k, "65536")
        C.QUERIES["stream_dedup_state"](spark, os.path.join(tmp_dir, "sf"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    loads = [b - a for a, b in zip(files, files[1:], strict=False)]
    assert len(loads) == 6 and min(loads) > 1  # one file a load would be read, and its rows sorted, by one task
