"""Stored-table jobs: day-by-day loads equal the bulk catalog; a retried load changes nothing."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from dvspark import schemas as S
from dvspark.operators import marts as M
from dvspark.operators import publish as P
from dvspark.operators import vault as V
from dvspark.plans import catalog as C
from dvspark.plans import daily_load as D
from dvspark.sources import testviews as tv

from .conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_daily_loads_equal_bulk_and_retry_is_a_no_op(spark, tmp_dir):
    root = os.path.join(tmp_dir, "wh")
    raw = tv.raw_quotes(spark, SF_SMALL).where(F.col("trade_date") <= "2024-01-03")
    inst = tv.raw_instruments(spark, SF_SMALL)
    days = [r.trade_date for r in raw.select("trade_date").distinct().orderBy("trade_date").collect()]
    D.load_vault(spark, root, "ref-1", instruments=inst)
    for day in days:
        for src in ("intraday", "eod"):
            batch = raw.where((F.col("trade_date") == F.lit(day)) & (F.col("source") == src))
            D.load_vault(spark, root, f"{day}-{src}", quotes=batch)
    before = _rows(D.read_vault(spark, root, "sat_quote_prices"))
    assert before == _rows(C.sat_quotes(raw))
    assert _rows(D.read_vault(spark, root, "hub_instrument")) == _rows(C.hub_instrument(raw))

    # retry the last load: identical tables
    last = raw.where((F.col("trade_date") == F.lit(days[-1])) & (F.col("source") == "eod"))
    D.load_vault(spark, root, f"{days[-1]}-eod", quotes=last)
    assert _rows(D.read_vault(spark, root, "sat_quote_prices")) == before  # fresh read: file listings change

    D.build_marts(spark, root, days, dt.datetime(2024, 1, 4, 20), fx=False)
    mart = P.read_published(spark, D.table_path(root, "dm", "dm_quotes_daily"), S.DM_QUOTES_DAILY)
    run = F.lit("2024-01-04 20:00:00").cast("timestamp_ntz")
    expected = M.mart_quotes_daily(C.sat_quotes(raw), C.hub_instrument(raw), C.sat_details(inst), loaded_at=run)
    assert _rows(mart.select(*expected.columns)) == _rows(expected)
    log = P.read_versioned(spark, D.table_path(root, "dm", "mart_refresh_log"), S.MART_REFRESH_LOG)
    assert log.count() == len(days)


def test_fx_load_and_mart(spark, tmp_dir):
    root = os.path.join(tmp_dir, "wh")
    rates = tv.raw_rates(spark, SF_SMALL).where(F.col("rate_date") < "1995-02-01")
    for src in ("cbr", "exchange_rate_api"):  # cbr lands first each day (18h), the API later (20h)
        D.load_vault(spark, root, src, rates=rates.where(F.col("source") == src))
    dates = [r.rate_date for r in rates.select("rate_date").distinct().collect()]
    D.build_marts(spark, root, dates, dt.datetime(1995, 2, 1, 20))
    fx = P.read_published(spark, D.table_path(root, "dm", "dm_fx_rates"), S.DM_FX_RATES)
    run = F.lit("1995-02-01 20:00:00").cast("timestamp_ntz")
    expected = M.mart_fx_rates(C.sat_rates(rates), C.lnk_rate_currency(rates), C.hub_currency(rates), loaded_at=run)
    assert _rows(fx.select(*expected.columns)) == _rows(expected)


def test_mart_build_prunes_satellite_partitions(spark, tmp_dir):
    root = os.path.join(tmp_dir, "wh")
    raw = tv.raw_quotes(spark, SF_SMALL).where(F.col("trade_date") <= "2024-01-02")
    D.load_vault(spark, root, "bulk", quotes=raw)
    sat = D.read_vault(spark, root, "sat_quote_prices").where(F.col("trade_date") == F.lit("2024-01-02").cast("date"))
    plan = sat._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_date" in plan and "(trade_date" in plan.split("PartitionFilters:")[1]


def test_stored_scan_of_a_delta_is_bounded_by_the_batch_dates(spark, tmp_dir):
    root = os.path.join(tmp_dir, "wh")
    raw = tv.raw_quotes(spark, SF_SMALL).where(F.col("trade_date") <= "2024-01-02")
    D.load_vault(spark, root, "bulk", quotes=raw)
    batch = C.quote_versions(raw.where(F.col("trade_date") == "2024-01-02")).select(*C.SAT_QUOTE_COLS)
    delta = V.satellite_delta(batch, D.read_vault(spark, root, "sat_quote_prices"), C.QUOTE_GRAIN, date_col="trade_date")
    plan = delta._jdf.queryExecution().executedPlan().toString()
    assert any("trade_date" in p.split("\n")[0] and "Subquery subquery" in p.split("\n")[0] for p in plan.split("PartitionFilters: [")[1:])


def test_corrected_retry_replaces_its_load(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    raw = tv.raw_quotes(spark, SF_SMALL).where(F.col("trade_date") <= "2024-01-03")
    P.append_load(raw, path, "l1", ["trade_date"])
    P.append_load(raw.where(F.col("trade_date") == "2024-01-03"), path, "l2", ["trade_date"])
    fewer = raw.where(F.col("trade_date") <= "2024-01-02")
    P.append_load(fewer, path, "l1", ["trade_date"])  # corrected: a day less
    assert _rows(P.read_loads(spark, path, S.RAW_QUOTES, only_load="l1")) == _rows(fewer)
    P.append_load(raw.limit(0), path, "l1", ["trade_date"])  # corrected: nothing
    assert P.read_loads(spark, path, S.RAW_QUOTES, only_load="l1").count() == 0
    assert P.read_loads(spark, path, S.RAW_QUOTES, only_load="l2").count() > 0


def test_refresh_log_goes_on_after_a_crash(spark, tmp_dir):
    root = os.path.join(tmp_dir, "log")
    row = lambda day: spark.createDataFrame([("m", dt.date(2023, 3, day), dt.datetime(2023, 3, day, 20))], S.MART_REFRESH_LOG)
    key = ["mart_name", "execution_date"]
    P.upsert_versioned(spark, root, row(1), key, "refreshed_at", S.MART_REFRESH_LOG)
    row(9).write.parquet(os.path.join(root, "_writing-of-a-run-that-died"))
    P.upsert_versioned(spark, root, row(2), key, "refreshed_at", S.MART_REFRESH_LOG)
    P.upsert_versioned(spark, root, row(2), key, "refreshed_at", S.MART_REFRESH_LOG)
    assert sorted(r.execution_date.day for r in P.read_versioned(spark, root, S.MART_REFRESH_LOG).collect()) == [1, 2]


def test_gates_stop_a_broken_load_and_skip_an_empty_one(spark, tmp_dir):
    root, landing = os.path.join(tmp_dir, "wh"), os.path.join(tmp_dir, "quotes")
    os.makedirs(landing)
    body = {"Time Series (Daily)": {"2023-03-14": {"1. open": "4", "2. high": "5", "3. low": "3", "4. close": "4", "5. volume": "9"}}}
    with open(os.path.join(landing, "ZQX.json"), "w") as out:
        json.dump(body, out)
    when = dt.datetime(2023, 3, 14, 20)
    assert D.run_load(spark, root, "a", when, quotes=landing) == "ok"
    assert D.run_load(spark, root, "b", when, quotes=landing) == "skip"  # the same bars again: nothing new
    D._append(root, "vault", "hub_instrument", D.read_vault(spark, root, "hub_instrument"), "copy")
    body["Time Series (Daily)"]["2023-03-15"] = body["Time Series (Daily)"]["2023-03-14"]
    with open(os.path.join(landing, "ZQX.json"), "w") as out:
        json.dump(body, out)
    with pytest.raises(D.GateError, match="hub_instrument: 1 duplicates"):
        D.run_load(spark, root, "c", when, quotes=landing)


def _quote_file(folder, symbol, *days, close="4"):
    os.makedirs(folder, exist_ok=True)
    bar = {"1. open": "4", "2. high": "9", "3. low": "3", "4. close": close, "5. volume": "9"}
    with open(os.path.join(folder, f"{symbol}.json"), "w") as out:
        json.dump({"Time Series (Daily)": {d: bar for d in days}}, out)


def test_a_second_load_reads_new_files_only(spark, tmp_dir, monkeypatch):
    root, landing = os.path.join(tmp_dir, "wh"), os.path.join(tmp_dir, "quotes")
    reads = []
    real = D.QJ.read_quote_responses
    monkeypatch.setattr(D.QJ, "read_quote_responses", lambda s, paths: (reads.append(sorted(p.rpartition("/")[2] for p in paths)), real(s, paths))[1])
    when = dt.datetime(2023, 3, 14, 20)
    _quote_file(landing, "ZQX", "2023-03-14")
    open(os.path.join(landing, "EMPTY.json"), "w").close()
    assert D.run_load(spark, root, "a", when, quotes=landing) == "ok"
    _quote_file(landing, "ZQY", "2023-03-14")
    with open(os.path.join(landing, "BROKEN.json"), "w") as out:
        out.write("{")
    assert D.run_load(spark, root, "b", when, quotes=landing) == "ok"
    assert D.run_load(spark, root, "c", when, quotes=landing) == "skip"  # no new file
    assert D.run_load(spark, root, "b", when, quotes=landing) == "ok"  # a retry reads what its load has read
    _quote_file(landing, "EMPTY", "2023-03-14", "2023-03-15")  # it was still being written
    _quote_file(landing, "ZQX", "2023-03-15", "2023-03-16")  # written again
    assert D.run_load(spark, root, "d", when, quotes=landing) == "ok"
    assert reads == [["ZQX.json"], ["BROKEN.json", "ZQY.json"], ["BROKEN.json", "ZQY.json"], ["EMPTY.json", "ZQX.json"]]
    mart = P.read_published(spark, D.table_path(root, "dm", "dm_quotes_daily"), S.DM_QUOTES_DAILY)
    assert sorted((r.instrument_bk, r.trade_date.day) for r in mart.collect()) == [("EMPTY", 14), ("EMPTY", 15), ("ZQX", 14), ("ZQX", 15), ("ZQX", 16), ("ZQY", 14)]
    bad = P.read_loads(spark, D.table_path(root, "raw", "quarantine"), D.REJECTED)
    assert [r.reason for r in bad.collect()] == ["corrupt_document"]


INSTRUMENTS = "symbol string, instrument_name string, exchange string, asset_type string, source string, loaded_at timestamp_ntz"


def test_details_have_the_end_dates_of_the_bulk_history_whatever_the_order_of_loads(spark, tmp_dir):
    import random

    rng = random.Random(3)
    rows = [(f"I{i}", rng.choice(["one", "two"]), rng.choice(["X", None]), "stock", f"s{h}", dt.datetime(2023, 1, 1, h)) for h in range(6) for i in range(5) if rng.random() < 0.7]
    rows += [("I0", "one", "X", "stock", "s0", dt.datetime(2023, 1, 1, 0))]
    data = spark.createDataFrame(sorted(set(rows), key=str), INSTRUMENTS)
    names = S.SAT_INSTRUMENT_DETAILS.names
    for order in ([0, 1, 2, 3, 4, 5], [5, 0, 3, 1, 4, 2]):
        root = os.path.join(tmp_dir, "wh" + "".join(map(str, order)))
        for h in [*order, order[1], order[-1]]:  # two loads are run again
            batch = data.where(F.hour(F.col("loaded_at").cast("timestamp")) == h)
            D._append(root, "raw", "raw_instruments", batch, f"load:{h}")
            D.load_vault(spark, root, f"load:{h}", instruments=batch)
        assert _rows(D.read_vault(spark, root, "sat_instrument_details").select(*names)) == _rows(C.sat_details(data).select(*names))
        D._append(root, "raw", "raw_instruments", data.limit(0), "load:3")  # corrected: the load held nothing
        D.load_vault(spark, root, "load:3", instruments=data.limit(0))
        fewer = data.where(F.hour(F.col("loaded_at").cast("timestamp")) != 3)
        assert _rows(D.read_vault(spark, root, "sat_instrument_details").select(*names)) == _rows(C.sat_details(fewer).select(*names))
        gates = {(g.gate, g.subject): g.n for g in D.check_load(spark, root, f"load:{order[2]}").collect()}
        assert gates["duplicates", "sat_instrument_details"] == 0


def test_a_late_load_of_details_leaves_the_right_version_current(spark, tmp_dir):
    root = os.path.join(tmp_dir, "wh")
    for load, name, hour in (("a", "one", 1), ("b", "one", 5), ("c", "seven", 3)):  # the second says nothing new, the third comes late
        batch = spark.createDataFrame([("Q", name, "X", "stock", load, dt.datetime(2023, 1, 1, hour))], INSTRUMENTS)
        D._append(root, "raw", "raw_instruments", batch, load)
        D.load_vault(spark, root, load, instruments=batch)
    found = D.read_vault(spark, root, "sat_instrument_details").orderBy("load_date").collect()
    assert [(r.instrument_name, r.load_date.hour, r.load_end_date and r.load_end_date.hour) for r in found] == [("one", 1, 3), ("seven", 3, 5), ("one", 5, None)]


def test_gates_read_the_days_and_buckets_of_their_load(spark, tmp_dir):
    root = os.path.join(tmp_dir, "wh")
    raw = tv.raw_quotes(spark, SF_SMALL).where(F.col("trade_date") <= "2024-01-04")
    rates = tv.raw_rates(spark, SF_SMALL).where(F.col("rate_date") < "1995-01-10")
    D.load_vault(spark, root, "bulk", quotes=raw.where("trade_date < '2024-01-04'"), rates=rates)
    one = raw.where("trade_date = '2024-01-04'").orderBy("symbol").limit(1)
    D.load_vault(spark, root, "day", quotes=one)
    gates = D.check_load(spark, root, "day")
    found = {(g.gate, g.subject): g.n for g in gates.collect()}
    assert found["rows", "sat_quote_prices"] == 1 and sum(n for (gate, _), n in found.items() if gate != "rows") == 0
    files = [f.rpartition("/wh/")[2] for f in gates.inputFiles()]
    scans = gates._jdf.queryExecution().executedPlan().toString()
    assert files and "Subquery" in scans  # the days of the satellite
    hub = D.read_vault(spark, root, "hub_instrument", buckets=["00", "05"])
    plan = hub._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    symbol = one.first().symbol
    # Duplicates and orphans among what the load touches, exactly.
    D._append(root, "vault", "hub_instrument", D.read_vault(spark, root, "hub_instrument").where(F.col("instrument_bk") == symbol), "copy")
    again = {(g.gate, g.subject): g.n for g in D.check_load(spark, root, "day").collect()}
    assert again["duplicates", "hub_instrument"] == 1
    D._append(root, "vault", "hub_instrument", D.read_vault(spark, root, "hub_instrument").limit(0), "copy")
    for load in ("bulk", "day"):
        left = D.read_vault(spark, root, "hub_instrument", only_load=load).where(F.col("instrument_bk") != symbol).persist()
        left.count()
        D._append(root, "vault", "hub_instrument", left, load)
    again = {(g.gate, g.subject): g.n for g in D.check_load(spark, root, "day").collect()}
    assert again["orphans", "sat_quote_prices.hub_instrument_hk"] == 1


def test_rows_without_a_link_part_are_quarantined(spark, tmp_dir):
    root = os.path.join(tmp_dir, "wh")
    batch = spark.createDataFrame([("Q", "one", None, "stock", "s", dt.datetime(2023, 1, 1)), ("R", "two", "X", "stock", "s", dt.datetime(2023, 1, 1))], INSTRUMENTS)
    D.load_vault(spark, root, "l", instruments=batch)
    (bad,) = P.read_loads(spark, D.table_path(root, "vault", "quarantine"), D.REJECTED).collect()
    assert (bad.stage, bad.reason, json.loads(bad.payload)["symbol"]) == ("lnk_quote_instrument", "null_link_part", "Q")


def test_two_rate_feeds_and_cross_rates_in_one_run(spark, tmp_dir):
    root, xml, api = (os.path.join(tmp_dir, n) for n in ("wh", "xml", "api"))
    for folder in (xml, api):
        os.makedirs(folder)
    with open(os.path.join(xml, "2023-03-14.xml"), "w", encoding="windows-1251") as out:
        out.write('<?xml version="1.0" encoding="windows-1251"?><ValCurs Date="14.03.2023" name="x"><Valute ID="1"><NumCode>1</NumCode><CharCode>AAA</CharCode><Nominal>10</Nominal><Name>Доллар</Name><Value>50,5</Value></Valute></ValCurs>')
    with open(os.path.join(api, "m.json"), "w") as out:  # units of base for one of target, the other way round
        out.write('{"base_currency": "BBB", "target_currency": "RUB", "rate": "2", "rate_date": "2023-03-14", "source": "api"}\n{"broken\n')
    when = dt.datetime(2023, 3, 14, 20)
    assert D.run_load(spark, root, "a", when, rates=xml, rate_messages=api) == "ok"
    fx = P.read_published(spark, D.table_path(root, "dm", "dm_fx_rates"), S.DM_FX_RATES).collect()
    assert sorted((r.base_currency, r.target_currency, float(r.rate)) for r in fx) == [("RUB", "AAA", 5.05), ("RUB", "BBB", 2.0)]
    cross = P.read_published(spark, D.table_path(root, "dm", "dm_fx_cross_rates"), S.DM_FX_CROSS_RATES).collect()
    assert sorted((r.from_currency, r.to_currency, float(r.cross_rate)) for r in cross) == [("AAA", "BBB", 2.525), ("BBB", "AAA", 0.3960396)]
    log = P.read_versioned(spark, D.table_path(root, "dm", "mart_refresh_log"), S.MART_REFRESH_LOG).collect()
    assert sorted(r.mart_name for r in log) == ["dm_fx_cross_rates", "dm_fx_rates"]
    bad = P.read_loads(spark, D.table_path(root, "raw", "quarantine"), D.REJECTED).collect()
    assert [(r.stage, r.reason) for r in bad] == [("rate_messages", "corrupt_json")]


def test_a_load_parses_a_file_once_and_lists_folders_in_few_tasks(spark, tmp_dir, monkeypatch):
    root, landing = os.path.join(tmp_dir, "wh"), os.path.join(tmp_dir, "quotes")
    for k in range(150):
        _quote_file(os.path.join(landing, f"symbol=S{k}"), f"S{k}", "2023-03-14")
    with open(os.path.join(landing, "symbol=S7", "BROKEN.json"), "w") as out:
        out.write("{")
    docs, kept = [], []
    read, append = D.QJ.read_quote_responses, P.append_load
    monkeypatch.setattr(D.QJ, "read_quote_responses", lambda s, paths: (docs.append(read(s, paths)), docs[-1])[1])
    monkeypatch.setattr(P, "append_load", lambda df, path, *rest: (kept.append(docs[0].storageLevel.useDisk) if path.endswith(("raw_quotes", "quarantine")) else None, append(df, path, *rest))[1])
    D.land_raw(spark, root, "a", F.lit("2023-03-14 20:00:00").cast("timestamp_ntz"), quotes=landing)
    assert kept == [True, True] and not docs[0].storageLevel.useDisk  # given back at the end
    assert D.read_raw(spark, root, "raw_quotes").count() == 150
    assert [r.reason for r in P.read_loads(spark, D.table_path(root, "raw", "quarantine"), D.REJECTED).collect()] == ["corrupt_document"]

    sc, limit = spark.sparkContext, spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    sc.setJobGroup("listing", "folders of a landing")
    assert D.new_files(spark, root, "quotes", landing, "a").count() == 151
    sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert 0 < max(s.numTasks for s in stages if s) <= 16 * sc.defaultParallelism
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == limit
