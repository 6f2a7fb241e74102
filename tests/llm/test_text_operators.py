"""Operators on documents against brute force, the tokenizers' own libraries, and held-out labels."""

import hashlib
import json
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from dvspark.llm import bpe, langid, line_crf, neardup, ngram_lm, prefix_counts, queries, templates

from ..conftest import SF_MID, SF_SMALL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "lorem ipsum dolor " * 4000 + "x" * 20_000
#: Extra columns have names that the operators use themselves.
EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, sig int, rep int, t string, w int, held_out string, lang_pred string, shingles int, crowd int"
EDGE_TEXTS = [None, "", " \n\t ", "one", "Two words", LONG, "a b c d e f", "a b c d e f", "12 !? 34", "привет мир", "naïve İΣς ²½ \x1c\x85", "<|endoftext|> x", "'re we'll\n\nDON'T"]


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def documents(sf):
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{sf}/documents.parquet'").fetchall()


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(k, t, "en" if k % 2 else None, None, None, 1.0, 2, 3, "t", 4, "h", "l", 5, 6) for k, t in enumerate(EDGE_TEXTS)]
    rows += [(None, "no id at all here", None, None, None, None, None, None, None, None, None, None, None, None), rows[6], (6, "other text of a repeated id", *rows[6][2:])]
    return spark.createDataFrame(rows, EDGE_SCHEMA)


def texts_of(df):
    return [r.text for r in df.collect()]


# ------------------------------------------------------------------ 1 language model
def kneser_ney(train, texts, order=ngram_lm.ORDER):
    """Straight from the formulas, with dictionaries."""
    c = Counter(w for t in train for w in t)
    grams = lambda t: list(zip(*((["<s>"] * (order - 1) + t)[k : k + len(t)] for k in range(order)), strict=True))
    counts = {order: Counter(g for t in train for g in grams(t))}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])

    def discounts(counts):
        n = Counter(counts)
        if not (n[1] and n[2] and n[3]):
            return [0, 0.5, 0.5, 0.5]
        y = n[1] / (n[1] + 2 * n[2])
        d = [0, 1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]
        return d if all(0 < d[k] <= k for k in (1, 2, 3)) else [0, 0.5, 0.5, 0.5]

    d = {n: discounts(counts[n].values()) for n in counts}
    behind = defaultdict(lambda: [0, 0])
    for n in range(2, order + 1):
        for g, k in counts[n].items():
            behind[g[:-1]][0] += k
            behind[g[:-1]][1] += d[n][min(k, 3)]
    kinds, v, follow = sum(counts[1].values()), len(c), counts[1]
    rest = sum(d[1][min(k, 3)] for k in follow.values()) / kinds if kinds else 1.0

    def p(g):
        n, k = len(g), counts[len(g)][g]
        if n == 1:
            return max(k - d[1][min(k, 3)], 0) / max(kinds, 1) + rest / (v + 1)
        total, mass = behind.get(g[:-1], (0, 0))
        return max(k - d[n][min(k, 3)], 0) / total + mass / total * p(g[1:]) if total else p(g[1:])

    n = sum(c.values())
    return [(len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), sum(math.log10(p(g)) for g in grams(t))) for t in texts]


def test_language_model_equals_brute_force_and_beats_the_base(spark):
    docs = {i: [*words(t), "\n"] for i, t, _ in documents(SF_SMALL)}
    found = {r.doc_id: r for r in queries.QUERIES["op1_kneser_ney"](spark, SF_SMALL).collect()}
    held = {i for i in docs if zlib.crc32(str(i).encode()) % 7 == 2}
    expected = kneser_ney([t for i, t in docs.items() if i not in held], docs.values())
    assert found.keys() == docs.keys()
    for i, (n, known, total, base, score) in zip(docs, expected, strict=True):
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i in held, n, known, total)
        assert abs(r.base_score - base) < 1e-6 and abs(r.score - score) < 1e-6
    assert sum(found[i].score for i in held) > sum(found[i].base_score for i in held)


@pytest.mark.parametrize("order", [2, 3, 4])
def test_language_model_edges(spark, edge, order):
    texts = texts_of(edge)
    model = ngram_lm.train(edge, order)
    found = ngram_lm.score(edge, model, F.lit(False)).collect()
    expected = kneser_ney([[*words(t), "\n"] for t in texts], [[*words(t), "\n"] for t in texts], order)
    got = sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in found)
    assert got == sorted((a, b, c, round(d, 6), round(e, 6)) for a, b, c, d, e in expected)


def test_language_model_without_texts(spark, edge):
    with pytest.raises(ValueError):
        ngram_lm.train(edge, 1)
    nothing = ngram_lm.train(edge.limit(0))
    assert nothing.tokens == 0 and ngram_lm.score(edge.limit(0), nothing, F.lit(True)).count() == 0
    assert all(math.isfinite(r.score) for r in ngram_lm.score(edge, nothing, F.lit(True)).collect())


# --------------------------------------------------------------------- 2 quality
def test_counts_keep_their_size(tmp_path):
    """Large ones too, beyond 32 bits."""
    model = ngram_lm.Model(str(tmp_path), 2, 1, {}, {2: [1, 1, 1, 1]}, [1, 1, 1, 1], 1, 4, 4, 4)
    for most in (1, 254, 255, 256, 70_000, 2**40):
        ngram_lm._put_values(f"{tmp_path}/words-0.values", np.array([[1, 2], [most, 300]]))
        ngram_lm.put(f"{tmp_path}/words-0.keys", np.array([5, 9], np.uint64).tobytes())
        assert ngram_lm.Lookup(model).words(np.array([9, 5, 7], np.uint64)).tolist() == [[most, 300], [1, 2], [0, 0]]


def test_quality_of_held_out_labels(spark):
    found = {r.doc_id: r for r in queries.QUERIES["op2_line_crf_quality"](spark, SF_MID).collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF_MID}/labels.parquet'").fetchall()
    held = [(found[i], q) for i, q in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(r.held_out and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r, _ in held)
    for label in (0, 1):
        right = [r.predicted == label for r, q in held if q == label]
        assert sum(right) >= 0.95 * len(right)
    assert len(found) == 1000


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    model = line_crf.Crf(np.zeros(1), np.ones(1), np.zeros(1), rng.normal(size=(2, 2)), 0.5)
    nodes, first = rng.normal(size=9), np.array([0, 4, 4 + 1, 9])
    good, pairs = model.marginals(nodes, first)
    total = np.zeros((2, 2))
    for a, b in zip(first, first[1:], strict=False):
        weight, on = {}, np.zeros(b - a)
        for labels in np.ndindex(*[2] * (b - a)):
            s = sum(n for n, y in zip(nodes[a:b], labels, strict=True) if y) + sum(model.ties[x, y] for x, y in zip(labels, labels[1:], strict=False))
            weight[labels] = math.exp(s)
        z = sum(weight.values())
        for labels, w in weight.items():
            on += np.array(labels) * w / z
            for x, y in zip(labels, labels[1:], strict=False):
                total[x, y] += w / z
        assert np.allclose(good[a:b], on)
    assert np.allclose(pairs, total)


def test_quality_edges(spark, edge):
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (4, 1, 0), (None, 1, 0), (5, None, 1), (99, 0, 0)], "doc_id long, quality int, toxic int")
    model = line_crf.train(edge, labels, F.lit(True))
    scored = line_crf.score(edge.drop("score"), model, keep_text=True).collect()
    assert len(scored) == edge.count() and all(0 <= r.score <= 1 for r in scored)
    assert sorted(str(r.text) for r in scored) == sorted(map(str, texts_of(edge)))
    assert line_crf.train(edge, labels.limit(0), F.lit(True)) is None
    assert {r.score for r in line_crf.score(edge.drop("score"), None).collect()} == {line_crf.CUT}
    assert line_crf.score(edge.limit(0).drop("score"), model).count() == 0


# ------------------------------------------------------------ 3 and 5 token counts, ids
def fuzz(alphabet, n, size=40):
    random.seed(5)
    return ["".join(random.choice(alphabet) for _ in range(random.randint(0, size))) for _ in range(n)]


def test_prefix_counts_equal_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as spec:
        counter = prefix_counts.PrefixCounter(json.load(spec))
    size = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    texts = [t or "" for t in EDGE_TEXTS] + [t for _, t, _ in documents(SF_SMALL)] + fuzz("ab'sltreVdLm  \n1 2.,éÉ!\xa0\x85x²ɐ日ΣİǅÅé", 800) + ["<|endoftext|>a<|startoftext|>", "!<|endoftext|>!"]
    assert [int(c.sum(dtype=int)) for c in counter.changes(texts)] == [size(t) for t in texts]
    for text in fuzz("ab'sltreVdLm  \n1 2.,éÉ!x²日", 60):
        plain = counter.normalised(text)
        counts = np.cumsum(counter.changes([text])[0], dtype=int)
        assert counts.tolist() == [size(plain[:k]) for k in range(1, len(plain) + 1)]
        cut = prefix_counts.prefix_within(counter.changes([text])[0], 5)
        assert cut == max([k for k in range(len(plain) + 1) if size(plain[:k]) <= 5])


def test_byte_bpe_equals_the_library():
    import tiktoken

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = bpe.BlockEncoder(ranks, public_tokenizers.PATTERN)
    texts = [t or "" for t in EDGE_TEXTS] + [t for _, t, _ in documents(SF_SMALL)] + fuzz("ab'sltredvm  \n\t1 2.,é!\xa0\x85x²ɐ日", 2000) + ["ab" * 3000, "aaaa" * 500]
    ids, begin = encoder.encode(texts)
    for text, a, b in zip(texts, begin, begin[1:], strict=False):
        assert ids[a:b].tolist() == library.encode_ordinary(text)
        assert encoder.decode(ids[a:b]) == text.encode()


def test_replay_prefers_a_lower_rank_that_a_merge_makes_possible():
    """A table where a later merge forms an earlier token, and where one token has several splits."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 300, b"bc": 301, b"ab": 302, b"aa": 303, b"aaa": 304, b"cab": 305}
    replay = bpe.MergeReplay(ranks)
    pieces = [p.encode() for p in fuzz("abc", 400, 12) + ["aaaaaaa", "abcabc", "cabab", "bcabcab"] if p]
    for piece, ids in zip(pieces, replay.encode(pieces), strict=True):
        expected = [ranks[piece]] if piece in ranks else replay._one_by_one(piece).tolist()
        assert ids.tolist() == expected


def test_token_queries_over_edges(spark, edge):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rows = bpe.bpe_round_trip(edge, ranks, public_tokenizers.PATTERN).collect()
    assert sorted(r.decoded_sha256 for r in rows) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for t in texts_of(edge))
    assert all(hashlib.sha256(r.ids).hexdigest() == r.ids_sha256 and len(r.ids) == 4 * r.n_tokens for r in rows)
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as spec:
        spec = spec.read()
    rows = prefix_counts.prefix_counts(edge, spec, 3).collect()
    assert sorted(r.n_bytes for r in rows) == sorted(len((t or "").encode()) for t in texts_of(edge))
    assert all(r.over_limit == (r.n_tokens > 3) and np.frombuffer(r.changes, "i1").sum(dtype=int) == r.n_tokens for r in rows)
    assert prefix_counts.prefix_counts(edge.limit(0), spec, 3).count() == bpe.bpe_round_trip(edge.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


# ------------------------------------------------------------------- 4 language
def test_language_of_held_out_texts(spark):
    found = {r.doc_id: r for r in queries.QUERIES["op4_viterbi_language"](spark, SF_MID).collect()}
    held = [(found[i], lang) for i, _, lang in documents(SF_MID) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(r.held_out and 0 <= r.score <= 1 for r, _ in held)
    assert sum(r.lang_pred == lang for r, lang in held) >= 0.98 * len(held)


def test_labelling_is_the_best_of_all():
    """Against every labelling, on short runs of random scores."""
    rng = np.random.default_rng(2)
    model = langid.LanguageModel(["a", "b", "c"], np.ones((langid.BUCKETS, 3)), np.ones((len(langid.SCRIPTS), 3)))

    def value(scores, labels):
        return sum(scores[i, k] for i, k in enumerate(labels)) - langid.SWITCH * sum(x != y for x, y in zip(labels, labels[1:], strict=False))

    for _ in range(40):
        scores = -rng.gamma(1.0, 9.0, size=(6, 3))
        best = max(value(scores, labels) for labels in np.ndindex(*[3] * 6))
        assert abs(value(scores, model.label(scores).tolist()) - best) < 1e-9


def test_spans_and_edges(spark, edge):
    rows = [(i, t, lang, None, None, None, None, None, None, None, None, None, None, None) for i, t, lang in documents(SF_SMALL)]
    known = spark.createDataFrame(rows, EDGE_SCHEMA)
    model = langid.train(known, F.lit(True))
    text = {lang: next(t for _, t, own in documents(SF_SMALL) if own == lang and 500 < len(t) < 3000 and "|" not in t and "***" not in t and "!!" not in t) for lang in ("en", "de")}
    spans = model.spans(text["en"][:400] + "\n" + text["de"][:400])
    assert [lang for lang, _ in spans] == ["en", "de"]
    found = langid.predict(edge.select("doc_id", "text", "score"), model, keep_text=True).collect()
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in (r.text or ""))) for r in found)
    assert langid.predict(edge.limit(0).select("doc_id", "text"), model).count() == 0
    empty = langid.train(known.limit(0), F.lit(True))
    assert {r.lang_pred for r in langid.predict(edge.select("doc_id", "text"), empty).collect()} == {"und"}


# ------------------------------------------------------------- 7 near duplicates
def shingles(text):
    w = words(text)
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components_by_force(rows, percent=85):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, u in sets[:a]:
            if i is not None and j is not None and s and u and 100 * len(s & u) >= percent * len(s | u):
                x, y = top(i), top(j)
                parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in parent}


def _check_near(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = components_by_force(rows)
    found = neardup.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.n_shingles) for r in found) == sorted((str(i), len(shingles(t))) for i, t in rows)
    for r in found:
        assert r.component_id == expected.get(r.doc_id) and r.kept == (r.doc_id is None or expected[r.doc_id] == r.doc_id)


def test_near_duplicates_equal_brute_force(spark, edge):
    _check_near(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    _check_near(spark, edge)
    assert neardup.near_duplicates(edge.limit(0)).count() == 0


def test_a_crowd_of_near_copies(spark, monkeypatch):
    """More near copies than a long list holds, edited more and less, in several blocks."""
    monkeypatch.setattr(neardup, "BLOCK", 40)
    random.seed(9)
    base = [f"w{random.randrange(5000)}" for _ in range(160)]
    rows = []
    for k in range(130):
        copy = list(base)
        for _ in range(random.choice([0, 1, 2, 3, 5, 8])):
            copy[random.randrange(160)] = f"e{random.randrange(10**6)}"
        rows.append((k, " ".join(copy)))
    _check_near(spark, spark.createDataFrame(rows, "doc_id long, text string"))


# ------------------------------------------------------------ 8 decontamination
def test_verbatim_items_are_found_and_clean_documents_left(spark):
    found = queries.QUERIES["op8_template_decontamination"](spark, SF_MID).where("contaminated").collect()
    duckdb.sql(f"CREATE OR REPLACE TEMP TABLE d AS SELECT * FROM '{SF_MID}/documents.parquet'")
    duckdb.sql(f"CREATE OR REPLACE TEMP TABLE b AS SELECT * FROM '{SF_MID}/benchmark.parquet'")
    verbatim = set(duckdb.sql("SELECT doc_id, item_id FROM d, b WHERE contains(d.text, b.text)").fetchall())
    pairs = {(r.doc_id, r.item_id) for r in found}
    assert verbatim and verbatim <= pairs
    text = {i: set(re.findall(r"\w+", t.lower())) for i, t, _ in documents(SF_MID)}
    items = dict(duckdb.sql("SELECT item_id, text FROM b").fetchall())
    for doc, item in pairs - verbatim:  # parts of an item: most of its words are there
        w = re.findall(r"\w+", items[item].lower())
        assert sum(x in text[doc] for x in w) >= 0.5 * len(w)


QUESTION = "If the train from Paris travels 120 km in 2 hours and then Anna walks 3 km more, how far did Anna go, asked Bob of Anna?"
CHANGED = "if the train from London travels 95 km in 4 hours and then Mary walks 7 km more, how far did Mary go, asked Tom of Mary?"
BROKEN = "If the train from London travels 95 km in 4 hours and then Mary walks 7 km more, how far did Paul go, asked Tom of Mary?"


def test_changed_slots_are_seen_through_if_consistent(spark, edge):
    bench = spark.createDataFrame([(1, QUESTION, 0), (1, QUESTION, 0), (2, "the of and", 0), (3, None, 0), (None, QUESTION, 0), (4, "", 0)], "item_id long, text string, window int")
    rows = [(1, "Some words first. " + QUESTION + " And more behind it."), (2, "Before it came this: " + CHANGED), (3, "Nothing of the kind is here, only 120 km and Anna."), (4, QUESTION.upper()), (5, None), (6, ""), (7, LONG + QUESTION), (None, QUESTION), (8, "Then: " + BROKEN)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("at", F.lit(1)).withColumn("copy", F.lit("x"))
    found = {r.doc_id: r for r in templates.contaminated(docs, bench).collect()}
    assert {i for i, r in found.items() if r.contaminated} == {1, 2, 4, 7} and {r.item_id for r in found.values()} == {1}
    assert found[1].changed_slots == 0 and found[2].changed_slots >= 5
    assert sorted(str(r.doc_id) for r in templates.clean(docs, bench).collect()) == ["3", "5", "6", "8", "None"]
    assert templates.clean(docs, bench).columns == docs.columns
    assert templates.contaminated(edge, bench).count() == templates.contaminated(docs.limit(0), bench).count() == templates.contaminated(docs, bench.limit(0)).count() == 0


def test_windows_by_shuffle_give_the_same(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SF_SMALL}/{n}.parquet") for n in ("documents", "benchmark"))
    before = sorted(map(str, templates.contaminated(docs, bench).collect()))
    monkeypatch.setattr(templates, "BROADCAST_WINDOWS", 0)
    assert before == sorted(map(str, templates.contaminated(docs, bench).collect())) and before


# --------------------------------------------------------------------- pipeline
def test_pipeline_stages(spark, edge):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF_MID}/labels.parquet'").fetchall())
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "language", "near_duplicates", "decontamination", "encoding"]
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in kept.select("doc_id").collect()}
        after = stage(spark, kept, SF_MID)
        assert after.columns == docs.columns
        kept = spark.createDataFrame(after.collect(), docs.schema)
        left = {r.doc_id for r in kept.select("doc_id").collect()}
        gone = before - left
        assert left <= before and kept.count() == len(left)
        if name == "quality":
            assert sum(labels[i] == 0 for i in gone if i in labels) >= 0.95 * sum(q == 0 for q in labels.values())
            assert sum(labels[i] == 1 for i in gone if i in labels) <= 0.02 * len(labels)
        if name == "language":
            assert len(gone) <= 0.01 * len(before)
        if name == "near_duplicates":
            force = components_by_force([(i, t) for i, t, _ in documents(SF_MID) if i in before], percent=corpus_pipeline.NEAR_PERCENT)
            assert left == {i for i, c in force.items() if i == c}
    last = corpus_pipeline.STAGES[-1][1](spark, kept, SF_MID)
    assert last.count() == kept.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, edge.limit(0), SF_SMALL).count() == 0
        assert stage(spark, edge, SF_SMALL).count() >= 0


def test_entry_lists_every_operator():
    import __spark_entry__

    found = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{k}_") for n in found) for k in range(1, 14)] == [1] * 13 and "pipeline" in found
    assert os.path.exists(queries.__file__)
