"""Collocations against SQL and plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from dvspark.llm import queries, runs, son_phrases

from ..compare import compare, duck
from ..conftest import SF_MID

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, min_count, max_words, covered, first):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, max_words + 1):
                f[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang in f:
        c, kept = {p: k for p, k in f[lang].items() if k >= min_count}, []
        for p, a in c.items():
            if len(p) > 1:
                score, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                longer = (b for q, b in c.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)))
                if not any(100 * b >= covered * a for b in longer):
                    kept.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, w.decode(), -a, left, right, n[lang], -s) for i, (s, a, w, left, right) in enumerate(sorted(kept)[:first], 1)]
    return sorted(out)


def got(docs, *how):
    found = son_phrases.collocations(docs, *how).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r) for r in found.collect())


def corpus():
    random.seed(13)
    vocab = [f"w{i}" for i in range(25)] + ["Ä", "日本", "x-y", "’"]
    rows = []
    for k in range(250):
        text = "".join(random.choices(vocab, [3 / (i + 1) for i in range(len(vocab))])[0] + random.choice([" "] * 8 + [".", ", ", "\n", " \t", "\r", "  ", "!"]) for _ in range(random.randrange(60)))
        rows.append((random.choice([k, None, 7]), text, random.choice(["en", "en", "en", "de", None, ""])))
    rows += [(900, "New York City is big. New York City is new! new york city", "en")] * 30
    return rows + [(901, None, "en"), (902, "", "fr"), (903, " \t.,;", "it"), (904, "one two three", "es"), (905, "A b C d " * 30000, "en"), (906, "a b, " * 30000, "la")]


def test_collocations_equal_sql(spark):
    info = compare(spark, duck(SF_MID), "op13", queries.QUERIES["op13_son_collocations"], queries.ORACLE["op13_son_collocations"], SF_MID)
    assert info["ok"], info


@pytest.mark.parametrize("how", [(10, 3, 50, 2000), (3, 4, 60, 15), (5, 2, 50, 7)])
def test_collocations_equal_plain_python(spark, how):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, b"x") for r in rows], "doc_id long, text string, lang string, shard int, hash binary").repartition(3)
    assert got(docs, *how) == by_hand(rows, *how)


def test_another_polynomial_gives_the_same(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    words = son_phrases._count_words

    def under_another(docs):
        level = docs.mapInArrow(words(3), "lang string, shard int, word string, key binary, hash long, n long")
        return level.groupBy("lang", "shard", "word", "key", "hash").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n"), 3

    monkeypatch.setattr(son_phrases, "_hashed", under_another)
    assert got(docs) == by_hand(rows, 10, 3, 50, 2000)
    assert len({runs.base(k) for k in range(100)}) == 100 and all(runs.base(k) % 2 for k in range(100))


def test_words_of_equal_hash_are_hashed_anew(spark, monkeypatch):
    """Two words are made to collide under the first polynomial: it is not used."""
    count = son_phrases._count_words

    def colliding(seed):
        whole = count(seed)

        def run(batches):
            for b in whole(batches):
                keys = [b"\0" * 8 if seed == 0 and w in ("new", "york") else k for w, k in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(keys, pa.binary()), *b.columns[4:]], b.schema.names)

        return run

    monkeypatch.setattr(son_phrases, "_count_words", colliding)
    docs = spark.createDataFrame(corpus()[:260], "doc_id long, text string, lang string")
    rows, seed = son_phrases._hashed(docs.selectExpr("text", "coalesce(lang, 'und') AS lang", "0 AS shard"))
    assert seed == 1 and rows.where("word = 'new'").count() == 1


def test_a_shard_hands_on_all_that_reaches_its_support(spark):
    """The union of the shards holds every phrase that is frequent over all, and is far smaller than all phrases."""
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    found = son_phrases.frequent(docs)
    least = found.counts.groupBy("words").agg({"f": "min", "key": "count"}).collect()
    assert {r.words for r in least} == {1, 2, 3} and all(r["min(f)"] >= 10 for r in least)
    segments = list(runs.segments(pa.array(["a b c. d e\nf", "g h", None, "i"]), son_phrases._WORD_END, son_phrases._PIECE_END, runs.Powers()))
    phrases = son_phrases._Phrases(segments[0], np.zeros(4, np.uint64))
    phrases.longer()
    assert [segments[0].data[segments[0].starts[i]] for i in np.flatnonzero(phrases.whole)] == [ord(c) for c in "abdg"]
    phrases.longer()
    assert [segments[0].data[segments[0].starts[i]] for i in np.flatnonzero(phrases.whole)] == [ord("a")]


def test_without_rows_or_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert got(empty) == [] and got(spark.createDataFrame([(1, None, "en"), (2, "..", None), (3, "once only", "en")], empty.schema)) == []
