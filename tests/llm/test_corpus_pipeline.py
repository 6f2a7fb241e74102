"""The pipeline's stages against brute force."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from dvspark.llm import line_crf, neardup

from ..conftest import SF_SMALL
from .test_text_operators import components_by_force, shingles


def near_pairs():
    """Pairs of texts around similarity 0.8, under doc_ids 2 k and 2 k + 1."""
    random.seed(4)
    rows = []
    for k in range(60):
        base = [f"w{random.randrange(10**6)}" for _ in range(200)]
        copy = list(base)
        for at in random.sample(range(200), random.choice([3, 4, 5, 6])):
            copy[at] = f"e{random.randrange(10**6)}"
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(copy))]
    return rows


def test_near_duplicate_stage_equals_brute_force_at_080(spark):
    rows = near_pairs()
    similar = [len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) for (_, a), (_, b) in zip(rows[::2], rows[1::2], strict=True)]
    assert sum(0.8 <= s < 0.85 for s in similar) >= 5 and min(similar) < 0.8
    force = components_by_force(rows, percent=80)
    left = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert left == {i for i, c in force.items() if i == c}


def test_matches_needed_keep_the_chance_of_a_miss_below_the_bound():
    assert neardup.matches_needed(85) == 39 and neardup.matches_needed(80) == 34 and neardup.matches_needed(100) == 64


def test_rows_of_one_doc_id_are_judged_by_their_own_text(spark, tmp_dir):
    one, two, item = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(5, one, 1), (5, two, 1), (5, two, 1), (9, two, 1), (None, one, 1), (None, item, 1), (None, "only here", 2), (7, None, 1), (8, None, 1), (None, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    left = corpus_pipeline.near_duplicates(spark, docs, "")
    assert left.columns == docs.columns
    assert sorted(map(str, left.collect())) == sorted(map(str, docs.distinct().where("coalesce(doc_id, 0) <> 9 AND NOT (doc_id IS NULL AND text LIKE 'a%')").collect()))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    clean = corpus_pipeline.decontamination(spark, left.union(spark.createDataFrame([(5, item, 1)], docs.schema)), tmp_dir)
    assert clean.columns == docs.columns and clean.where(F.col("text") == item).count() == 0 and clean.count() == left.count() - 1


def test_a_repeated_doc_id_trains_as_one_text(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(line_crf, "fit", lambda x, size, first, label: seen.append(label.tolist()))
    docs = spark.createDataFrame([(1, f"Some line of text {k}.") for k in range(50)] + [(2, "Another line of it."), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    line_crf.train(docs, labels, F.lit(True))
    assert [sorted(s) for s in seen] == [[0, 1, 1]]


def test_columns_named_as_a_stages_own_and_maps_pass_through(spark):
    """The same rows stay as without the extra columns, and keep them."""
    plain = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    long_text = spark.createDataFrame([(10**6, "Some words of prose go on here. " * 100_000, "en", "s", 1)], plain.schema)
    plain = plain.union(long_text)
    names = ["_row", "_row_", "_quality", "_lang_pred", "_lang_score", "_first", "_bad", "_gone", "component_id"]
    odd = plain.select("*", *(F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names), F.create_map(F.lit("k"), F.col("doc_id")).alias("m"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        expected = {r.doc_id for r in stage(spark, plain, SF_SMALL).select("doc_id").collect()}
        found = stage(spark, odd, SF_SMALL)
        assert found.columns == odd.columns, name
        rows = found.drop("text").collect()
        assert {r.doc_id for r in rows} == expected and len(rows) == len(expected)
        assert all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names) and all(r.m == {"k": r.doc_id} for r in rows)


def test_of_equal_rows_the_smallest_by_the_other_columns_stays(spark):
    docs = spark.createDataFrame([(1, "same text", 3, {"a": 1}), (1, "same text", 2, {"b": 1}), (1, "same text", 2, {"a": 2})], "doc_id long, text string, n int, m map<string,int>")
    assert [(r.n, r.m) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()] == [(2, {"a": 2})]


def test_rows_whose_first_hash_is_equal_stay_apart(spark, monkeypatch):
    """All rows under one first hash, as two texts of a very large corpus may be: none goes for another."""
    monkeypatch.setattr(corpus_pipeline, "row_id", lambda: F.lit(7).cast("long"))
    docs = spark.createDataFrame([(1, "one text"), (2, "another text"), (2, "another text")], "doc_id long, text string")
    assert sorted(map(tuple, corpus_pipeline.near_duplicates(spark, docs, "").collect())) == [(1, "one text"), (2, "another text")]
