"""Operators on conversations, pages and embeddings against plain Python and brute force."""

import re
from collections import defaultdict

import duckdb
import numpy as np
import zstandard
from pyspark.sql import functions as F

from dvspark.llm import kmeans_tree, queries, quotes, shared_files, warc

from ..conftest import SF_SMALL


# ------------------------------------------------------------------ 6 quotations
def by_hand(rows):
    """reply, thread and depth of (conv, turn, role, text) rows, one message a turn; no units but whole bodies, paragraphs, lines."""
    norm = lambda t: re.sub(r"\s+", " ", t).strip().lower()
    parsed = {}
    for conv, turn, _, text in rows:
        lines = [(len(re.sub("[^>]", "", m.group(0))) if (m := re.match(r"(?:[ \t]*>)+", x)) else 0, re.sub(r"^(?:[ \t]*>)+", "", x)) for x in re.split("\r?\n", text or "")]
        own, passages, before = [], [], None
        for k, (level, line) in enumerate(lines):
            if level == 0:
                above = k + 1 < len(lines) and lines[k + 1][0] > 0
                if not (above and re.match(r"[ \t]*On .{1,200} wrote:[ \t]*$", line)):
                    own.append(line)
            elif before == level:
                passages[-1][1].append(line)
            else:
                passages.append((level, [line]))
            before = level
        body = "\n".join(own).strip(" \t\r\n") if passages else (text or "")
        parsed[conv, turn] = (body, passages)
    held = defaultdict(set)
    for key, (body, _) in parsed.items():
        for unit in {body, *re.split(r"\n\s*\n", body), *body.split("\n")} if body else ():
            if len(norm(unit)) >= quotes.LEAST:
                held[norm(unit)].add(key)
    reply = {}
    for (conv, turn), (_, passages) in parsed.items():
        options = []
        for level, lines in passages:
            for unit in {norm(x) for x in [*lines, " ".join(lines)]}:
                if len(unit) < quotes.LEAST or unit not in held:
                    continue
                same = min((k for k in held[unit] if k[0] == conv), default=None)
                first = min(held[unit])
                original = same if same and same[1] < turn else first if first[0] < conv else None
                if original:
                    options.append((level, -len(unit), original))
        earlier = max((k for k in parsed if k[0] == conv and k[1] < turn), default=None)
        reply[conv, turn] = min(options)[2] if options else earlier
    out = {}
    for key in parsed:
        root, depth = key, 0
        while reply[root]:
            root, depth = reply[root], depth + 1
        out[key] = (reply[key], root, depth, parsed[key][0], len(parsed[key][1]))
    return out


def test_quote_links_equal_plain_python(spark):
    rng = np.random.default_rng(4)
    rows, lines = [], [f"Line number {k} says something long" for k in range(12)]
    for conv in range(14):
        turn = 0
        for _ in range(rng.integers(1, 7)):
            text = "\n".join(lines[i] for i in rng.integers(0, 12, rng.integers(1, 3)))
            if rows and rng.random() < 0.6:
                quoted = rows[rng.integers(len(rows))][3].split("\n")
                mark = rng.choice(["> ", ">", ">> ", "> > "])
                text = "On Friday Ann wrote:\n" * int(rng.random() < 0.5) + "\n".join(mark + x.upper() for x in quoted) + "\nMy answer " + str(rng.integers(10**6)) + "\n" + text
            rows.append((conv, turn, "user", text))
            turn += int(rng.integers(1, 4))  # with gaps
    found = quotes.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("msg", F.lit(1)).withColumn("depth", F.lit("x"))).collect()
    expected = by_hand(rows)
    assert len(found) == len(rows)
    for r in found:
        reply, root, depth, body, passages = expected[r.conv_id, r.turn]
        assert ((r.reply_conv, r.reply_turn) if r.reply_conv is not None else None, (r.thread_conv, r.thread_turn), r.depth, r.n_quotes) == (reply, root, depth, passages)
        assert r.chat == "user: " + body


def test_quote_link_edges(spark):
    rows = [(None, 3, "user", "alone"), (3, None, "user", None), (4, 0, None, ""), (4, 0, None, ""), (5, 1, "user", "> " * 30 + "deep"), (5, 2, "user", "x" * 50_000), (5, 2, "bot", "x" * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = quotes.reply_ordered(df).collect()
    assert len(found) == 6 and sum(r.copies for r in found) == 7
    assert all(r.depth == 0 for r in found if r.conv_id in (None, 3, 4))
    assert sorted(r.depth for r in found if r.conv_id == 5) == [0, 1, 1]
    assert quotes.reply_ordered(df.limit(0)).count() == 0


def test_all_conversations_come_back_in_order(spark):
    found = queries.QUERIES["op6_quote_links"](spark, SF_SMALL)
    rows = duckdb.sql(f"SELECT conv_id, turn, role || ': ' || text FROM '{SF_SMALL}/conversations.parquet'").fetchall()
    got = found.collect()
    assert sorted((r.conv_id, r.turn, r.chat) for r in got) == sorted(rows)
    place = {(c, t): k for c in {c for c, _, _ in rows} for k, (_, t) in enumerate(sorted((c2, t) for c2, t, _ in rows if c2 == c))}
    assert all(r.depth == place[r.conv_id, r.turn] for r in got)


# ------------------------------------------------------------------------ 9 WARC
def test_archives_round_trip(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()]
    rows += [(1000 + k, f"u{k}", "same payload") for k in range(30)] + [(2000, None, None), (2001, "e\r\nvil: x", ""), (None, "n", "same payload"), (None, "n", "only null ids"), (1029, "again", "same payload"), (3000, "long", "ü" * 300_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("latest", F.lit(2))
    archives = warc.write_archives(df, archive_bytes=200_000)
    listed = archives.collect()
    assert sum(a.records for a in listed) == len(rows) and len(listed) > 1
    latest = {}
    for i, _, h in rows:
        if i is not None:
            latest[h or ""] = max(i, latest.get(h or "", i))
    expected = []
    for i, _, h in rows:
        h = h or ""
        refers = latest.get(h)
        revisit = refers is not None and (i is None or i < refers)
        expected.append((str(i), len(h.encode()), warc.digest_of(h.encode()), "revisit" if revisit else "response", str(refers if revisit else None)))
    got = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in warc.read_archives(archives).collect()]
    assert sorted(got) == sorted(expected)
    # Each archive begins with its dictionary; every record is a frame of its own that this dictionary opens.
    with_dictionary = 0
    for a in listed:
        data = shared_files.get(a.path)
        if data[:4] != b"\x5d\x2a\x4d\x18":
            continue
        with_dictionary += 1
        size = int.from_bytes(data[4:8], "little")
        opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
        at, frames = 8 + size, 0
        while at < len(data):
            one = opener.decompressobj()
            assert one.decompress(data[at:]).startswith(b"WARC/1.1\r\n")
            at, frames = len(data) - len(one.unused_data), frames + 1
        assert frames == a.records
    assert with_dictionary
    assert warc.read_archives(warc.write_archives(df.limit(0))).count() == 0


def test_small_payloads_stay_responses(spark):
    df = spark.createDataFrame([(1, "a", "xx"), (2, "b", "xx"), (3, "c", "long enough"), (4, "d", "long enough")], "page_id long, url string, html string")
    found = {r.page_id: r.refers_to for r in warc.with_revisits(df, least=5).collect()}
    assert found == {1: None, 2: None, 3: 4, 4: None}


def test_a_damaged_payload_is_noticed(tmp_path):
    data = warc.archive([warc.record(1, "u", b"payload", None), warc.record(2, None, b"payload", 1)])
    heads = [(h["WARC-Type"], b) for h, b in warc.read_records(data)]
    assert [t for t, _ in heads] == ["response", "revisit"] and heads[0][1].endswith(b"\r\n\r\npayload") and not heads[1][1].endswith(b"payload")


# ------------------------------------------------------------------------ 10 ANN
def _recall(found, rows, queries_, k=10):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    hit = total = 0
    for q in queries_:
        at = int(np.flatnonzero(ids == q)[0])
        d = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        order = [j for j in np.lexsort((ids, d)) if np.isfinite(d[j])][:k]
        got = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in got] == list(range(1, len(order) + 1))
        assert [(r.score, r.vec_id) for r in got] == sorted((r.score, r.vec_id) for r in got)
        place = {int(i): float(v) for i, v in zip(ids, d, strict=True)}
        assert all(abs(place[r.vec_id] - r.score) < 1e-12 for r in got)
        hit += len({r.vec_id for r in got} & {int(ids[j]) for j in order})
        total += len(order)
    return hit / total


def test_recall_of_the_tree(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "LEAF_ROWS", 32)
    monkeypatch.setattr(kmeans_tree, "SPLIT_ROWS", 50)
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    found = kmeans_tree.nearest_neighbours(df, F.col("vec_id") % 20 == 0).collect()
    assert _recall(found, rows, [i for i, _ in rows if i % 20 == 0]) >= 0.9


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (100, [0.0, 0.0]), (200, None), (300, []), (400, [nan, 1.0]), (500, [inf, 1.0]), (600, [None, 1.0]), (700, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (800, [3.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("leaf", F.lit(1)).withColumn("v", F.lit(2))
    found = kmeans_tree.nearest_neighbours(df, F.col("vec_id") % 100 == 0, k=3).collect()
    assert {r.query_id for r in found} == {0, 800}
    assert [(r.vec_id, r.rank) for r in sorted(found, key=lambda r: (r.query_id, r.rank)) if r.query_id == 0] == [(1, 1), (2, 2), (3, 3)]
    assert kmeans_tree.nearest_neighbours(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_one_vector_many_times(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "LEAF_ROWS", 16)
    monkeypatch.setattr(kmeans_tree, "SPLIT_ROWS", 20)
    rng = np.random.default_rng(1)
    rows = [(k, [1.0, 2.0, 3.0, 4.0] if k % 3 == 0 else rng.normal(size=4).tolist()) for k in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = kmeans_tree.nearest_neighbours(df, F.col("vec_id") % 100 == 0).collect()
    assert _recall(found, rows, range(0, 600, 100)) >= 0.9
    assert [r.vec_id for r in sorted((r for r in found if r.query_id == 300), key=lambda r: r.rank)] == [0, 3, 6, 9, 12, 15, 18, 21, 24, 27]
