"""Landings of many small files and tables of many small days: the time goes with the work, not with a task's or a call's fixed cost."""

import datetime as dt
import json
import os
from decimal import Decimal

from pyspark.sql import functions as F

from dvspark.functions.cols import FilesWithBytes, load_files
from dvspark.operators import publish as P
from dvspark.plans import daily_load as D
from dvspark.sources import quotes_json as QJ

RAW = "symbol string, source string, trade_date date, open_price decimal(18,6), high_price decimal(18,6), low_price decimal(18,6), close_price decimal(18,6), volume long"
WHEN = dt.datetime(2023, 3, 14, 20)


def _raw(spark):
    symbols = ["A/B", "C=D%", "Ж[1]", "plain", None]
    rows = [(s, src, dt.date(2023, month, 7), 4, 9, 3, 4, 11) for s in symbols for src in ("one", "two:") for month in (3, 4)]
    return spark.createDataFrame([(*r[:3], *map(Decimal, r[3:7]), r[7]) for r in rows], RAW)


def _files(folder):
    return sorted(os.path.relpath(os.path.join(at, f), folder) for at, _, found in os.walk(folder) for f in found)


def test_responses_land_as_a_file_each_and_a_second_writing_replaces_them(spark, tmp_dir):
    responses = QJ.responses_from_quotes(_raw(spark))
    here = os.path.join(tmp_dir, "here")
    for _ in range(2):  # as a task that is run again
        QJ.land_responses(responses, here, 3)
    files = _files(here)
    assert len(files) == responses.count() == 20  # no checksums, no half-written ones
    assert {os.path.dirname(f) for f in files} >= {"source=one/symbol=A%2FB", "source=two%3A/symbol=C%3DD%25", "source=one/symbol=__HIVE_DEFAULT_PARTITION__", "source=one/symbol=Ж%5B1%5D"}
    # A store that is not of the scheme "file" has the same folders, by Spark's writer.
    os.makedirs(os.path.join(tmp_dir, "store"))
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.many.link./landing", f"file://{tmp_dir}/store")
    QJ.land_responses(responses, "viewfs://many/landing/there", 3)
    there = [f for f in _files(os.path.join(tmp_dir, "store", "there")) if f.endswith(".txt") and "part-" in f]
    assert sorted(map(os.path.dirname, there)) == sorted(map(os.path.dirname, files))

    def quotes(folder, names):
        docs = QJ.read_quote_responses(spark, FilesWithBytes(f"{folder}/{n}" for n in names))
        found, bad = QJ.parse_quote_responses(docs, mode="all", source=F.regexp_extract("doc_id", "source=([^/]+)/", 1), loaded_at=WHEN)
        assert bad.count() == 0
        return sorted(map(tuple, found.drop("loaded_at").collect()))

    rows = quotes(here, files)
    assert rows == quotes("viewfs://many/landing/there", there) and len(rows) == 20
    assert {r[0] for r in rows} >= {"C=D%", "Ж[1]", "plain"}


def test_texts_of_many_files_come_together_and_no_empty_ones_are_sought_among_listed_ones(spark, tmp_dir):
    for k in range(90):
        with open(os.path.join(tmp_dir, f"S{k}.json"), "w") as out:
            json.dump({"Note": str(k)}, out)
    paths = [os.path.join(tmp_dir, f) for f in os.listdir(tmp_dir)]
    assert load_files(spark.read.format("text"), spark, paths).count() == 90
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "128m")  # a task a file
    try:
        docs = QJ.read_quote_responses(spark, FilesWithBytes(paths)).persist()
        assert docs.count() == 90 and docs.rdd.getNumPartitions() <= 8
        docs.unpersist()
    finally:
        spark.conf.set(name, before)
    join = lambda given: "Join" in QJ.read_quote_responses(spark, given)._jdf.queryExecution().optimizedPlan().toString()
    assert join(paths) and not join(FilesWithBytes(paths))


def test_rows_against_the_rules_keep_their_feed(spark, tmp_dir):
    root, xml, api = (os.path.join(tmp_dir, n) for n in ("wh", "xml", "api"))
    for folder in (xml, api):
        os.makedirs(folder)
    with open(os.path.join(xml, "2023-03-14.xml"), "w") as out:
        out.write('<ValCurs Date="14.03.2023"><Valute><CharCode>AAA</CharCode><Nominal>1</Nominal><Value>5</Value></Valute><Valute><CharCode>RUB</CharCode><Nominal>1</Nominal><Value>1</Value></Valute></ValCurs>')
    with open(os.path.join(api, "m.json"), "w") as out:
        for code, rate in (("BBB", "2"), ("CCC", "-1")):
            out.write(json.dumps({"base_currency": code, "target_currency": "RUB", "rate": rate, "rate_date": "2023-03-14", "source": "api"}) + "\n")
    D.land_raw(spark, root, "a", F.lit(WHEN).cast("timestamp_ntz"), rates=xml, rate_messages=api)
    bad = P.read_loads(spark, D.table_path(root, "raw", "quarantine"), D.REJECTED).collect()
    seen = sorted((r.stage, r.reason, json.loads(r.payload)["target_currency"], "_stage" in r.payload) for r in bad)
    assert seen == [("rate_messages_rules", "rate_positive", "CCC", False), ("rates_xml_rules", "distinct_currencies", "RUB", False)]
    assert sorted(r.target_currency for r in D.read_raw(spark, root, "raw_rates").collect()) == ["AAA", "BBB"]


def test_many_small_days_are_written_by_several_tasks_and_listed_by_few(spark, tmp_dir):
    path = os.path.join(tmp_dir, "mart")
    days = spark.range(300).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("day"), F.explode(F.sequence(F.lit(1), F.lit(25))).alias("n"))
    least = spark.conf.get(P.MIN_TASK)
    P.publish_by_date(days.withColumn("text", F.md5(F.concat_ws(" ", "day", "n"))), path, "day")
    assert spark.conf.get(P.MIN_TASK) == least
    files = [os.path.basename(f) for f in _files(path) if f.endswith(".parquet") and "/." not in f]
    assert len(files) == 300  # a small day is one file
    assert len({f.split("-")[1] for f in files}) > 1
    sc = spark.sparkContext
    sc.setJobGroup("days", "listing")
    found = P.read_published(spark, path, days.withColumn("text", F.lit("")).schema)
    sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("days") for s in tracker.getJobInfo(j).stageIds]
    assert 0 < max(s.numTasks for s in stages if s) <= 16 * sc.defaultParallelism
    assert found.count() == 7500
