"""The mix of sources against plain Python and SQL."""

import hashlib
import random
import re
from fractions import Fraction

from pyspark.sql import functions as F

from dvspark.llm import mixing, queries

from ..compare import compare, duck
from ..conftest import SF_MID

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(rows, weights=(1, 2, 3), block=mixing.BLOCK, most=mixing.REPEATS):
    """(doc_id, size, source_size, target, taken) of (doc_id, text, source) rows, by a mix that is made slot by slot."""
    golden, sources = 0x9E3779B97F4A7C15, sorted({s for _, _, s in rows if s is not None}) + [None] * any(s is None for _, _, s in rows)
    docs = [(d, len(WORDS.findall(t or "")), s, "null" if t is None else hashlib.md5(t.encode()).hexdigest()) for d, t, s in rows]
    size = {s: sum(n for _, n, x, _ in docs if x == s) for s in sources}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    left, free, target = sum(size.values()), list(sources), {}
    while True:
        level = Fraction(left, sum(weight[s] for s in free) or 1)
        above = [s for s in free if level * weight[s] > most * size[s]]
        if not above:
            break
        for s in above:
            target[s] = Fraction(most * size[s])
            left -= most * size[s]
            free.remove(s)
    target |= {s: level * weight[s] for s in free}
    goal = {s: int(target[s]) for s in sources}
    order = {}
    for s in sources:
        order[s] = sorted((d for d in docs if d[2] == s), key=lambda d: (int(hashlib.md5(f"{'null' if d[0] is None else d[0]}:{d[3]}".encode()).hexdigest()[:15], 16), d[0] is not None, d[0] or 0, d[3]))
    stream = {s: [(k, at) for k, d in enumerate(order[s]) for at in range(d[1])] for s in sources}
    total = sum(goal.values())
    taken = {(s, k): 0 for s in sources for k in range(len(order[s]))}
    given = dict.fromkeys(sources, 0)

    def slot(s):  # the next block of a source's stream
        begin = given[s] % size[s]
        n = min(block - begin % block, size[s] - begin, goal[s] - given[s])
        for k, _ in stream[s][begin : begin + n]:
            taken[s, k] += 1
        given[s] += n

    for i in range(-(-total // block)):
        at, low = (i * golden % 2**64) * total // 2**64, 0
        s = next(s for s in sources if (low := low + goal[s]) > at)
        if given[s] < goal[s]:
            slot(s)
    for s in sources:
        while given[s] < goal[s]:
            slot(s)
    return sorted(((d[0], d[1], size[s], float(target[s]), taken[s, k]) for s in sources for k, d in enumerate(order[s])), key=repr)


def got(docs):
    mixed = mixing.mix(docs)
    return mixed, sorted(((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in mixing.words_taken(mixed).collect()), key=repr)


def test_mix_equals_sql(spark):
    con = duck(SF_MID)
    info = compare(spark, con, "op11", queries.QUERIES["op11_golden_mix"], queries.ORACLE["op11_golden_mix"], SF_MID)
    assert info["ok"], info


def test_mix_equals_plain_python_with_hot_sources_and_copies(spark):
    random.seed(11)
    rows = []
    for k in range(300):
        source = random.choice(["a", "a", "a", "B", "ä", "", None, "tiny"]) if k else "tiny"
        rows.append((random.choice([None, k, k, 7]), " ".join(["w"] * (random.randrange(1, 400) if source != "tiny" else 3)), source))
    rows += [(500, "x y\tz w" * 200, "a")] * 40 + [(501, None, "a"), (502, "", "B"), (503, " \n ", "empty"), (504, None, None)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, size int, src string").repartition(5)
    mixed, found = got(docs)
    force = by_hand(rows)
    assert [r[:3] for r in found] == [r[:3] for r in force]
    assert all(abs(a[3] - b[3]) < 1e-6 for a, b in zip(found, force, strict=True)) and [r[4] for r in found] == [r[4] for r in force]
    assert all(r[4] <= 3 * r[1] for r in found)
    taken = {r.source: (r.target, r.taken) for r in mixing.words_taken(mixed).groupBy("source").agg(F.max("target").alias("target"), F.sum("taken").alias("taken")).collect()}
    assert all(0 <= target - n < 1 for target, n in taken.values())


def test_any_run_of_slots_holds_the_sources_in_proportion(spark):
    random.seed(12)
    docs = spark.createDataFrame([(k, " ".join(["w"] * 900), random.choice("abbcccd")) for k in range(3000)], "doc_id long, text string, source string")
    mixed = mixing.mix(docs)
    share = {r.src: r.goal for r in mixed.sources.collect()}
    total = sum(share.values())
    slots = [r.src for r in mixed.pieces.select("slot", "src").distinct().orderBy("slot").collect()]
    for start in range(0, len(slots) - 200, 97):
        part = slots[start : start + 200]
        assert all(abs(part.count(s) - 200 * n / total) <= 6 for s, n in share.items())


def test_texts_of_the_mix_are_the_words_that_it_takes(spark):
    rows = [(k, " ".join(f"w{k}.{j}" for j in range(50 * (k % 4))), "ab"[k % 2]) for k in range(40)] + [(99, "one two three", "c")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed, found = got(docs)
    pieces = mixing.mixed_texts(mixed, docs).collect()
    words = {}
    for r in pieces:
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
        assert set(r.text.split()) <= set(next(t for d, t, _ in rows if d == r.doc_id).split())
    by_doc = {}
    for doc, _, _, _, taken in found:
        by_doc[doc] = by_doc.get(doc, 0) + taken
    assert words == {d: n for d, n in by_doc.items() if n}
    slots = {}
    for r in pieces:
        slots.setdefault(r.slot, []).append((r.at, len(r.text.split())))
    for parts in slots.values():  # a slot's pieces follow one another
        assert [a for a, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts))]


def test_without_rows_or_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert got(empty)[1] == []
    assert got(spark.createDataFrame([(1, None, "a"), (None, "", None)], empty.schema))[1] == sorted([(1, 0, 0, 0.0, 0), (None, 0, 0, 0.0, 0)], key=repr)
