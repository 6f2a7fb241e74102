"""Sinks lose nothing: feeds into one table, crashes at any step, null dates, two writers at once."""

import datetime as dt
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from dvspark import schemas as S
from dvspark.operators import publish as P
from dvspark.sources import messages as MSG
from dvspark.sources import testviews as tv
from dvspark.streaming import streams as X

from .conftest import SF_SMALL

EVENTS = "event_id long, ts timestamp_ntz, user_id long, value double"
KEY = ["mart_name", "execution_date"]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _events(spark, *rows):
    return spark.createDataFrame([(i, None if h is None else dt.datetime(2023, 5, 1) + dt.timedelta(hours=h), i % 3, float(v)) for i, h, v in rows], EVENTS)


def _land(rows, path):
    rows.coalesce(1).write.mode("append").parquet(path)


def _stream(spark, path):
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(path)


# --------------------------------------------------------------- the load sink
def test_null_dates_and_any_load_id_are_kept(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    rows = spark.createDataFrame([("a", dt.date(2023, 5, 1)), ("b", None), ("c", dt.date(2023, 5, 2))], "k string, day date")
    ids = ["2025-06-06T18:00", "a/b=c%d e", "plain"]
    for i in ids:
        P.append_load(rows, path, i, ["day"])
        P.append_load(rows.where("k <> 'c'"), path, i, ["day"])  # run again with other rows
    P.append_load(rows.where("k = 'b'"), path, "nulls only", ["day"])
    P.append_load(rows.limit(0), path, "nothing", ["day"])
    got = P.read_loads(spark, path, rows.schema, keep_id=True)
    assert _rows(got.select("load_id", "k")) == sorted([(i, k) for i in ids for k in "ab"] + [("nulls only", "b")], key=repr)
    assert got.where("day IS NULL").count() == 4
    assert all(P.has_load(spark, path, i) for i in [*ids, "nulls only", "nothing"]) and not P.has_load(spark, path, "other")
    assert _rows(P.read_loads(spark, path, rows.schema, only_load=ids[0])) == _rows(rows.where("k <> 'c'"))


def test_a_load_is_seen_whole_or_not_at_all(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "t")
    one, two = _events(spark, (1, 0, 1)), _events(spark, (2, 0, 1), (3, 30, 1))
    P.append_load(one, path, "l")
    real = P.rename
    for fail_at in (1, 2):  # while the old rows are put aside, and while the new ones take their place
        calls = []
        monkeypatch.setattr(P, "rename", lambda *a, n=fail_at: (calls.append(1), real(*a))[1] if len(calls) + 1 < n else (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            P.append_load(two, path, "l")
        monkeypatch.setattr(P, "rename", real)
        assert _rows(P.read_loads(spark, path, one.schema)) in (_rows(one), [])
    P.append_load(two, path, "l")
    assert _rows(P.read_loads(spark, path, one.schema)) == _rows(two)


# ------------------------------------------------------------------ feeds
def test_feeds_and_new_checkpoints_into_one_table_lose_nothing(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    a, b = _events(spark, (1, 0, 1), (2, None, 1)), _events(spark, (3, 30, 1), (4, None, 1), (1, 0, 1))
    for name, rows in (("a", a), ("b", b)):
        _land(rows, os.path.join(tmp_dir, name))
    for name, ckpt in (("a", "1"), ("b", "2"), ("a", "3"), ("a", "1")):
        X.first_wins_stream(spark, _stream(spark, os.path.join(tmp_dir, name)), out, os.path.join(tmp_dir, f"_ckpt-{ckpt}"), ["event_id"], "ts", ["ts"])
    assert _rows(X.read_loaded(spark, out, a.schema)) == _rows(a.union(b).distinct())
    assert len([n for n in os.listdir(out) if n.startswith("load_id=")]) == 3


def test_crashes_at_any_step_change_nothing(spark, tmp_dir, monkeypatch):
    """Two feeds; every action on the file system may be the last one of a run, before or after it took place."""
    rng = random.Random(7)
    raw = tv.raw_quotes(spark, SF_SMALL).where(F.col("trade_date") <= "2024-01-02").limit(60)
    messages = MSG.quote_messages(raw).select("message_value").collect()
    bad = [("{broken",), ("{}",)]
    feeds = {"a": messages[:40] + bad, "b": messages[20:] + bad}
    for name, lines in feeds.items():
        for part in (lines[::2], lines[1::2]):
            spark.createDataFrame([(x[0],) for x in part], "value string").coalesce(1).write.mode("append").text(os.path.join(tmp_dir, name))
    out, quarantine = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "bad")

    def drain(name):
        X.drain_messages_to_raw(spark, os.path.join(tmp_dir, name), out, quarantine, os.path.join(tmp_dir, f"_ckpt-{name}"), S.RAW_QUOTES_KEY, S.RAW_QUOTES, "trade_date", max_files_per_trigger=1)

    real_rename, crashes = P.rename, 0

    def fragile(*args):
        nonlocal crashes
        draw = rng.random()
        if draw < 0.15:
            crashes += 1
            raise OSError("before")
        real_rename(*args)
        if draw > 0.85:
            crashes += 1
            raise OSError("after")

    monkeypatch.setattr(P, "rename", fragile)
    todo = ["a", "b"]
    while todo:
        name = rng.choice(todo)
        try:
            drain(name)
            todo.remove(name)
        except Exception as e:
            assert "before" in str(e) or "after" in str(e), e
    monkeypatch.setattr(P, "rename", real_rename)
    assert crashes >= 2
    once = X.read_loaded(spark, out, S.RAW_QUOTES)
    assert _rows(once) == _rows(raw)
    assert P.read_loads(spark, quarantine, MSG.decode_quote_messages(spark.createDataFrame([], "value string"), tz="UTC", value_col="value")[1].schema).count() == 4
    for name in feeds:  # nothing new
        drain(name)
    assert _rows(X.read_loaded(spark, out, S.RAW_QUOTES)) == _rows(raw)


# ------------------------------------------------------- removal in the stream
def test_copies_go_in_the_stream_and_late_rows_stay(spark, tmp_dir):
    landing, out, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "out", "_ckpt"))
    batches = [
        [(k, 200 + k, 1) for k in range(40)] + [(3, 203, 1)],  # a copy in the batch
        [(k, 200 + k, 1) for k in range(30, 60)] + [(100, 1, 1), (100, 1, 1), (101, None, 1)],  # copies, late rows, one without a time
        [(100, 1, 1), (101, None, 1), (102, None, 1), (5, 205, 1), (103, 250, 1)],  # late copies
        [(k, 900 + k, 1) for k in range(200, 205)] + [(104, 240, 1)],
        [(205, 2000, 1), (104, 240, 1), (200, 1100, 1)],
    ]
    sizes = []
    for rows in batches:
        _land(_events(spark, *rows), landing)
        q = X.dedup_stream(spark, _stream(spark, landing), out, ckpt, ["event_id"], "ts", ["ts"], "24 hours")
        sizes += [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"] and p["numInputRows"]]
    schema = spark.createDataFrame([], EVENTS).schema
    expected = sorted({r for rows in batches for r in rows}, key=repr)
    assert sorted(((r.event_id, None if r.ts is None else round((r.ts - dt.datetime(2023, 5, 1)).total_seconds() / 3600), int(r.value)) for r in X.read_loaded(spark, out, schema).collect()), key=repr) == expected
    assert sizes[-1] <= 6 and max(sizes) < len(expected)  # keys older than the delay have left the state
    # A new checkpoint delivers all again: nothing new.
    X.dedup_stream(spark, _stream(spark, landing), out, ckpt + "-2", ["event_id"], "ts", ["ts"], "24 hours")
    assert X.read_loaded(spark, out, schema).count() == len(expected)


def test_a_batch_with_state_may_run_again(spark, tmp_dir):
    landing, out, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "out", "_ckpt"))
    rows = [_events(spark, (1, 0, 1), (2, 1, 1)), _events(spark, (2, 1, 1), (3, 2, 1)), _events(spark, (3, 2, 1), (4, 3, 1))]
    for k, part in enumerate(rows):
        _land(part, landing)
        X.dedup_stream(spark, _stream(spark, landing), out, ckpt, ["event_id"], "ts", ["ts"], "24 hours")
        last = max(int(n) for n in os.listdir(os.path.join(ckpt, "commits")) if n.isdigit())
        if k < 2:  # crash after the write, before the commit
            for n in (f"{last}", f".{last}.crc"):
                if os.path.exists(os.path.join(ckpt, "commits", n)):
                    os.remove(os.path.join(ckpt, "commits", n))
    assert [r.event_id for r in X.read_loaded(spark, out, rows[0].schema).orderBy("event_id").collect()] == [1, 2, 3, 4]


# ---------------------------------------------------------------------- bars
def test_bars_with_late_ticks_the_open_day_and_ticks_without_a_time(spark, tmp_dir):
    landing, parts, bars, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "parts", "bars", "_ckpt"))
    batches = [[(k, 100 + k, k % 7) for k in range(60)] + [(500, None, 3)], [(100 + k, 90 + k, k % 5) for k in range(30)], [(501, None, 9), (502, 1, 4), (503, 161, 8)]]
    for k, rows in enumerate(batches):
        _land(_events(spark, *rows), landing)
        X.ohlc_stream(spark, _stream(spark, landing), parts, bars, ckpt)
        seen = _events(spark, *(r for b in batches[: k + 1] for r in b))
        assert _rows(X.read_bars(spark, bars)) == _rows(X.ohlc_of_ticks(seen))
    # A second feed into the same bars.
    _land(_events(spark, (900, 101, 99), (901, 2000, 1)), landing + "-2")
    X.ohlc_stream(spark, _stream(spark, landing + "-2"), parts, bars, ckpt + "-2")
    assert _rows(X.read_bars(spark, bars)) == _rows(X.ohlc_of_ticks(_events(spark, *(r for b in batches for r in b), (900, 101, 99), (901, 2000, 1))))


# ------------------------------------------------------------ versions (M4, M5)
def test_of_two_writers_at_once_one_makes_the_version(spark, tmp_dir):
    path = os.path.join(tmp_dir, "v", "000000000001")
    made = []
    threads = [threading.Thread(target=lambda k=k: made.append(P.create_new(spark, path, f"text {k}"))) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(made) == [False] * 7 + [True] and P.read_text(spark, path).startswith("text ")
    assert [n for n in os.listdir(os.path.dirname(path)) if not n.startswith(".")] == ["000000000001"]


def test_writers_of_a_mart_and_of_the_log_at_once_lose_nothing(spark, tmp_dir):
    mart, log = os.path.join(tmp_dir, "mart"), os.path.join(tmp_dir, "log")
    schema = "k string, trade_date date"
    day = lambda d: dt.date(2023, 5, d)
    errors = []

    def write(k):
        try:
            rows = spark.createDataFrame([(f"w{k}", day(k)), (f"w{k}", day(20)), (f"w{k}", None if k == 1 else day(21))], schema)
            P.publish_by_date(rows, mart, "trade_date", dates=[day(k), day(20)], spark=spark)
            entry = spark.createDataFrame([("m", day(k), dt.datetime(2023, 5, k)), ("m", day(20), dt.datetime(2023, 5, k))], S.MART_REFRESH_LOG)
            P.upsert_versioned(spark, log, entry, KEY, "refreshed_at", S.MART_REFRESH_LOG)
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(1, 6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    got = P.read_published(spark, mart, spark.createDataFrame([], schema).schema).collect()
    assert {(r.k, r.trade_date) for r in got if r.trade_date is None or r.trade_date.day < 20} == {(f"w{k}", day(k)) for k in range(1, 6)} | {("w1", None)}
    assert sorted(r.trade_date.day for r in got if r.trade_date and r.trade_date.day >= 20) == [20, 21]  # of one writer each
    held = {r.execution_date: r.refreshed_at for r in P.read_versioned(spark, log, S.MART_REFRESH_LOG).collect()}
    assert held == {day(k): dt.datetime(2023, 5, k) for k in range(1, 6)} | {day(20): dt.datetime(2023, 5, 5)}


def test_replaced_and_emptied_days_switch_together_and_old_versions_go(spark, tmp_dir):
    mart, schema = os.path.join(tmp_dir, "mart"), "k string, trade_date date"
    day = lambda d: dt.date(2023, 5, d)
    write = lambda rows, **how: P.publish_by_date(spark.createDataFrame(rows, schema), mart, "trade_date", spark=spark, **how)
    read = lambda: sorted(tuple(r) for r in P.read_published(spark, mart, spark.createDataFrame([], schema).schema).collect())
    write([("a", day(1)), ("a", day(2)), ("a", day(3))])
    before = P.newest_version(spark, mart)
    old = P.read_published(spark, mart, spark.createDataFrame([], schema).schema)
    assert write([("b", day(1))], dates=[day(1), day(2)]) == [day(2)]
    assert read() == [("a", day(3)), ("b", day(1))]
    assert sorted(tuple(r) for r in old.collect()) == [("a", day(k)) for k in (1, 2, 3)]  # a reader of the version before
    with pytest.raises(P.Conflict):
        P.replace_partitions(spark.createDataFrame([("c", day(1))], schema), mart, "trade_date", since=before[1])
    P.replace_partitions(spark.createDataFrame([("c", day(3))], schema), mart, "trade_date", since=before[1])  # untouched meanwhile
    assert read() == [("b", day(1)), ("c", day(3))]
    folders = lambda: len([n for n in os.listdir(mart) if n.startswith("data=")])
    assert folders() == 3
    P.expire_versions(spark, mart, keep=1)
    assert read() == [("b", day(1)), ("c", day(3))] and folders() == 2 and len(P.names(spark, f"{mart}/_versions")) == 1
    write([], dates=[day(1), day(3)])
    assert read() == []
