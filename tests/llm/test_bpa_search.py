"""Ranked search against SQL and plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from dvspark.llm import bitmaps, bpa_search, queries, runs

from ..compare import compare, duck
from ..conftest import SF_MID

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def by_hand(docs, items, k):
    held = [(d, Counter(ts), len(ts)) for d, t in docs if (ts := terms(t))]
    n_docs, n_terms, df = len(held), sum(n for _, _, n in held), Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for d, c, n in held:
            m = 25 + 75 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(item, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def test_search_equals_sql(spark):
    info = compare(spark, duck(SF_MID), "op12", queries.QUERIES["op12_best_position_search"], queries.ORACLE["op12_best_position_search"], SF_MID)
    assert info["ok"], info


def corpus(n=400):
    random.seed(12)
    vocab = [f"w{i}" for i in range(60)] + ["Äpfel", "日本", "x9"]
    text = lambda size: " ".join(random.choices(vocab, [1 / (i + 1) for i in range(len(vocab))], k=size))
    docs = [(random.choice([k, k, 5, None]), text(random.randrange(1, 80))) for k in range(n)]
    docs += [(1000 + k, docs[3][1]) for k in range(30)]  # ties beyond the k-th place
    docs += [(2000, None), (2001, ""), (2002, " .,-!"), (2003, "W1 w1-W2_w3 " * 20000)]
    items = [(k, text(random.randrange(1, 30))) for k in range(25)] + [(3, "other text of w3 w9"), (3, "other text of w3 w9"), (90, None), (91, ""), (92, "unknown words"), (None, "w5 w60 日本"), (93, docs[3][1])]
    return docs, items


def test_search_equals_plain_python_over_many_shards_and_blocks(spark, monkeypatch):
    docs, items = corpus()
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, q int").repartition(3)
    q = spark.createDataFrame([(*r, "z") for r in items], "item_id long, text string, key string")
    rows = lambda k: sorted((tuple(r) for r in bpa_search.search(d, q, k).select("item_id", "rank", "doc_id", "score").collect()), key=repr)
    assert rows(10) == by_hand(docs, items, 10)
    monkeypatch.setattr(bpa_search, "CELLS", 64)
    monkeypatch.setattr(bpa_search, "BLOCK_TERMS", 40)
    assert rows(3) == by_hand(docs, items, 3)


def test_best_position_search_of_a_shard_reads_less_than_all_and_misses_nothing():
    rng = np.random.default_rng(1)
    n_docs, n_terms = 4000, 8
    row = np.concatenate([np.sort(rng.choice(n_docs, 1500, replace=False)) for _ in range(n_terms)])
    term = np.repeat(np.arange(n_terms), 1500)
    tf = rng.zipf(1.7, len(row)).clip(1, 200)
    n = rng.integers(1, 300, n_docs)
    held = bpa_search.Shard(n, row, term, tf, n_terms, n_docs, int(n.sum()))
    looked_up = []
    place = held.place

    class Spy:
        def __getitem__(self, at):
            looked_up.append(at[1].size)
            return place[at]

    held.place = Spy()
    for asked, factor in [(np.array([0]), np.array([5])), (np.array([1, 2]), np.array([7, 1])), (np.array([3]), np.array([1]))]:
        looked_up.clear()
        score = np.zeros(n_docs, np.int64)
        m = 25 + 75 * n * n_docs // n.sum()
        for t, f in zip(asked, factor):
            at = term == t
            score[row[at]] += f * (10**9 * tf[at] // (1000 * tf[at] + 8 * m[row[at]]))
        truth = np.lexsort((np.arange(n_docs), -score))[:10]
        doc, got = held.best(asked, factor, 10)
        assert doc.tolist() == truth.tolist() and got.tolist() == score[truth].tolist()
        assert sum(looked_up) < 1000
        above = int(score[truth[4]]) + 1  # what a task already has
        assert set(held.best(asked, factor, 10, above)[0]) >= set(truth[score[truth] >= above])


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "b c")], "item_id long, text string")
    assert bpa_search.search(docs.limit(0), items).count() == bpa_search.search(docs, items.limit(0)).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "-")], docs.schema)
    assert bpa_search.search(nothing, items).count() == bpa_search.search(docs, nothing.toDF("item_id", "text")).count() == 0
    assert [tuple(r) for r in bpa_search.search(docs, items).select("item_id", "rank", "doc_id").collect()] == [(1, 1, 1)]


# ----------------------------------------------------------- terms and bitmaps
def test_runs_of_bytes_equal_the_pattern_whatever_the_segments():
    random.seed(3)
    texts = ["".join(random.choice("aB1é .,\nz😀") for _ in range(random.randrange(60))) for _ in range(300)] + [None, "", "x" * 500, "a b" * 300]
    between, powers = ~runs.byte_table(range(48, 58), range(65, 91), range(97, 123), range(128, 256)), runs.Powers()
    for limit in (7, 50, 1 << 20):
        found, hashes = [[] for _ in texts], {}
        for s in runs.segments(pa.array(texts, pa.string()), between, between, powers, limit):
            for a, b, r, h in zip(s.starts, s.ends, s.row, s.hash):
                found[r].append(s.data[a:b].tobytes().decode())
                assert hashes.setdefault(found[r][-1], h) == h
        assert found == [terms(t) for t in texts] and len(set(hashes.values())) == len(hashes)


def test_a_bitmap_has_all_its_members_and_few_others(spark):
    rng = np.random.default_rng(5)
    members = rng.integers(0, 1 << 64, 5000, dtype=np.uint64)
    members[:3] = 0, (1 << 64) - 1, 1 << 63
    held = bitmaps.bitmap_of(spark.createDataFrame([(int(x),) for x in members.view(np.int64)] + [(None,)], "h long"), "h")
    assert held.has(members).all() and held.has(rng.integers(0, 1 << 64, 20000, dtype=np.uint64)).mean() < 0.1
    assert not bitmaps.bitmap_of(spark.createDataFrame([], "h long"), "h").has(members).any()
