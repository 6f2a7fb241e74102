"""13: collocations of words by SON partitioning.

Texts are cut into pieces at punctuation and line ends, pieces into words; a
phrase is a row of words inside a piece.  The frequent phrases of a language
are mined as follows:

1. Words are counted.  Only words that are frequent over all can be in a
   frequent phrase.
2. The rows are dealt into ``SHARDS`` shards by a hash.  A shard is mined whole,
   level by level: phrases of n words whose both parts of n - 1 words may be
   frequent are counted in it, and those stay that reach the shard's part of
   the support, ``min_count`` times its share of the language's words, rounded up.
   A phrase that is frequent over all reaches that in one shard at least.
3. The union of the shards' phrases is counted over all texts, exactly.

A shard's support must be above 1 to be of use, so there are fewer shards than
``min_count`` however large the corpus; a shard is a share of all rows that many
tasks count together, not the content of one task.  Counts are summed up in a
task before they are shuffled by (language, phrase), so no phrase, however
common, is a hot key, and no phrase is left out.  What levels 2 and 3 have to
count is looked up in a bitmap of bounded size; it lets no phrase of the union
out, and others that pass are counted and then fall to the exact support.

A phrase is known by its words' 64-bit hashes; words are counted as text, and
if two have one hash all is hashed anew by another polynomial, so no two
phrases are ever one.

Scores (floor(1000000 a a / (l r)) at the worst cut) are exact in 38 digits.

Defined cases: null lang is ``und``; null and empty texts hold no words, a lang
without words gives no rows; repeated rows and ids count each time; extra
columns with any names; empty table: no rows.  Long texts are cut behind
punctuation for memory; a single piece is held whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dvspark.llm.bitmaps import Bitmap, bitmap_of
from dvspark.llm.blocks import mix
from dvspark.llm.common import stored
from dvspark.llm.runs import Powers, Segment, byte_table, segments

#: Shards of the corpus; below the support.
SHARDS = 4
#: Phrases that a task sums up before it hands them on.
HELD = 1 << 21
#: Score of a phrase whose words occur nowhere else.
SCALE = 1_000_000
UND = "und"

_PIECE_END = byte_table(*(ord(c) for c in ".,;:!?"), range(0x0A, 0x0E))
_WORD_END = _PIECE_END | byte_table(0x20, 0x09)


def _lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "big")


class _Phrases:
    """Phrases of a segment, level by level: ``hash`` of the phrase that begins at each word, ``whole`` where there is one."""

    def __init__(self, s: Segment, lang_hash: np.ndarray):
        self.word = s.hash
        piece = np.cumsum(_PIECE_END[s.data])[s.starts] if len(s.starts) else np.zeros(0, np.int64)
        self._joint = (piece[1:] == piece[:-1]) & (s.row[1:] == s.row[:-1])  # word i and the next are in one piece
        self.hash = mix(s.hash ^ lang_hash[s.row])
        self.whole = np.ones(len(s.row), bool)
        self.words = 1

    def longer(self, known: np.ndarray | None = None) -> None:
        """Phrases of one word more, where both parts are in ``known`` (if given)."""
        part = self.whole if known is None else self.whole & known
        n = self.words
        size = max(0, len(self.word) - n)
        self.whole = part[:size] & part[1 : size + 1] & self._joint[n - 1 : n - 1 + size]
        self.hash = mix(self.hash[:size] * np.uint64(0xD1B54A32D192ED03) + self.word[n : n + size])
        self.words = n + 1


class _Langs:
    """Codes of the languages that a task has met."""

    def __init__(self):
        self.codes, self.names = {}, []

    def of(self, column: pa.Array) -> np.ndarray:
        held = column.dictionary_encode()
        codes = np.array([self.codes.setdefault(x, len(self.codes)) for x in held.dictionary.to_pylist()], np.int64)
        self.names = list(self.codes)
        return codes[np.asarray(held.indices)]

    def hashes(self, codes: np.ndarray) -> np.ndarray:
        return np.array([_lang_hash(x) for x in self.names], np.uint64)[codes]

    def column(self, codes: np.ndarray) -> pa.Array:
        return pa.DictionaryArray.from_arrays(pa.array(codes.astype(np.int32)), pa.array(self.names, pa.string())).cast(pa.string())


def _sum_equal(columns: list[np.ndarray], count: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    if not len(count):
        return columns, count
    order = np.lexsort(columns)
    columns = [c[order] for c in columns]
    differs = np.zeros(len(order) - 1, bool)
    for c in columns:
        differs |= c[1:] != c[:-1]
    first = np.flatnonzero(np.r_[True, differs])
    return [c[first] for c in columns], np.add.reduceat(count[order], first)


class _Sums:
    """Counts of keys (some arrays of equal length) of one task, handed on when there are ``HELD`` of them."""

    def __init__(self, emit):
        self.emit, self.parts, self.size = emit, [], 0

    def add(self, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        columns, count = _sum_equal(columns, np.ones(len(columns[0]), np.int64))
        self.parts.append((columns, count))
        self.size += len(count)
        if self.size > HELD:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            columns = [np.concatenate(c) for c in zip(*(p[0] for p in self.parts))]
            columns, count = _sum_equal(columns, np.concatenate([p[1] for p in self.parts]))
            for at in range(0, len(count), 1 << 18):
                yield self.emit([c[at : at + (1 << 18)] for c in columns], count[at : at + (1 << 18)])
        self.parts, self.size = [], 0


def _bytes(words: list[np.ndarray]) -> pa.Array:
    """The words' hashes one behind the other, as binary keys."""
    flat = np.ascontiguousarray(np.stack(words, axis=1).astype(">u8"))
    width = 8 * len(words)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(flat), [None, pa.py_buffer(flat.tobytes())]).cast(pa.binary())


def _count_words(seed: int):
    """(text, lang, shard) -> words (lang, word, key, hash, n), and (lang, shard, n) with all the words of a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, langs = Powers(seed), _Langs()
        names = ["lang", "shard", "word", "key", "hash", "n"]
        for batch in batches:
            lang, shard = langs.of(batch.column(1)), batch.column(2).to_numpy(zero_copy_only=False)
            hashes = langs.hashes(lang)
            for s in segments(batch.column(0), _WORD_END, _PIECE_END, powers):
                if not len(s.row):
                    continue
                order = np.lexsort((s.hash, lang[s.row]))
                h, of = s.hash[order], lang[s.row][order]
                first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (of[1:] != of[:-1])])
                n = np.diff(np.r_[first, len(h)])
                at = order[first]
                raw = s.data.tobytes()
                words = pa.array([raw[a:b] for a, b in zip(s.starts[at].tolist(), s.ends[at].tolist())], pa.binary()).cast(pa.string())
                none = pa.nulls(len(at))
                phrase = mix(h[first] ^ hashes[s.row[at]])
                yield pa.RecordBatch.from_arrays([langs.column(of[first]), none.cast(pa.int32()), words, _bytes([h[first]]), pa.array(phrase.view(np.int64)), pa.array(n)], names)
                (of, k), n = _sum_equal([lang[s.row], shard[s.row]], np.ones(len(s.row), np.int64))
                none = pa.nulls(len(n))
                yield pa.RecordBatch.from_arrays([langs.column(of), pa.array(k.astype(np.int32)), none.cast(pa.string()), none.cast(pa.binary()), none.cast(pa.int64()), pa.array(n)], names)

    return run


def _mine_shards(seed: int, parts: list[Bitmap]):
    """(text, lang, shard) -> (lang, shard, hash, n): the phrases of one word more than the last of ``parts`` holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, langs = Powers(seed), _Langs()
        sums = _Sums(lambda c, n: pa.RecordBatch.from_arrays([langs.column(c[2]), pa.array(c[1].astype(np.int32)), pa.array(c[0].view(np.int64)), pa.array(n)], ["lang", "shard", "hash", "n"]))
        for batch in batches:
            lang, shard = langs.of(batch.column(1)), batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            hashes = langs.hashes(lang)
            for s in segments(batch.column(0), _WORD_END, _PIECE_END, powers):
                phrases = _Phrases(s, hashes)
                for known in parts:
                    phrases.longer(known.has(phrases.hash))
                at = np.flatnonzero(phrases.whole)
                yield from sums.add([phrases.hash[at], shard[s.row[at]], lang[s.row[at]]])
        yield from sums.flush()

    return run


def _count_all(seed: int, asked: list[Bitmap]):
    """(text, lang) -> (lang, key, n): the phrases of 2, 3, ... words that are in ``asked``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, langs = Powers(seed), _Langs()
        emit = lambda c, n: pa.RecordBatch.from_arrays([langs.column(c[-1]), _bytes(c[-2::-1]), pa.array(n)], ["lang", "key", "n"])
        sums = [_Sums(emit) for _ in asked]
        for batch in batches:
            lang = langs.of(batch.column(1))
            hashes = langs.hashes(lang)
            for s in segments(batch.column(0), _WORD_END, _PIECE_END, powers):
                phrases = _Phrases(s, hashes)
                for known, held in zip(asked, sums):
                    phrases.longer()
                    at = np.flatnonzero(phrases.whole)
                    at = at[known.has(phrases.hash[at])]
                    # Sorted by language, then word by word.
                    yield from held.add([*(s.hash[at + k] for k in reversed(range(phrases.words))), lang[s.row[at]]])
        for held in sums:
            yield from held.flush()

    return run


@dataclass
class Frequent:
    """``counts``: lang, key, words, f of all frequent words and phrases; ``names``: lang, key, word; ``totals``: lang, n."""

    counts: DataFrame
    names: DataFrame
    totals: DataFrame


def _hashed(docs: DataFrame) -> tuple[DataFrame, int]:
    """Words and totals under the first polynomial that gives no two words one hash."""
    seed = 0
    while True:
        rows = docs.mapInArrow(_count_words(seed), "lang string, shard int, word string, key binary, hash long, n long")
        rows = stored(rows.groupBy("lang", "shard", "word", "key", "hash").agg(F.sum("n").alias("n")), "phrases-words")
        words = rows.where(F.col("word").isNotNull())
        if words.groupBy("key").agg((F.min("word") != F.max("word")).alias("two")).where("two").limit(1).count() == 0:
            return rows, seed
        seed += 1


def frequent(docs: DataFrame, min_count: int = 10, max_words: int = 3) -> Frequent:
    """Words and phrases of up to ``max_words`` words that occur ``min_count`` times or more in ``docs`` (doc_id, text, lang)."""
    rows = docs.select(
        "text",
        F.coalesce(F.col("lang"), F.lit(UND)).alias("lang"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(SHARDS)).cast("int").alias("shard"),
    )
    level, seed = _hashed(rows)
    shards = level.where(F.col("word").isNull()).select("lang", "shard", F.col("n").alias("here"))
    totals = stored(shards.groupBy("lang").agg(F.sum("here").alias("total")), "phrases-totals")
    words = level.where(F.col("word").isNotNull() & (F.col("n") >= min_count))
    least = _div(_exact("here") * min_count + _exact("total") - 1, _exact("total"))
    support = stored(shards.join(totals, "lang").select("lang", "shard", least.alias("least")), "phrases-support")
    known = [bitmap_of(words, "hash")]
    for _ in range(2, max_words + 1):
        mined = rows.mapInArrow(_mine_shards(seed, known), "lang string, shard int, hash long, n long")
        mined = mined.repartition("lang", "shard", "hash").groupBy("lang", "shard", "hash").agg(F.sum("n").alias("n"))
        union = mined.join(support, ["lang", "shard"]).where("n >= least").select("hash")
        known.append(bitmap_of(stored(union, "phrases-union"), "hash"))
    counted = rows.select("text", "lang").mapInArrow(_count_all(seed, known[1:]), "lang string, key binary, n long")
    counted = counted.repartition("lang", "key").groupBy("lang", "key").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
    phrases = stored(counted, "phrases-counted")
    counts = words.select("lang", "key", F.col("n").alias("f")).unionByName(phrases).withColumn("words", (F.length("key") / 8).cast("int"))
    return Frequent(counts, words.select("lang", "key", "word"), totals.select("lang", F.col("total").alias("n")))


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(18,0)")


def _div(a: Column, b: Column) -> Column:
    """Whole-numbered quotient of decimals, without rounding."""
    return ((a - F.pmod(a, b)) / b).cast("long")


def _part(first: Column | int, words: Column | int) -> Column:
    """``words`` words of a key from the ``first`` (from 0) on."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.substring(F.col("key"), lit(first) * 8 + 1, lit(words) * 8)


def scored(found: Frequent) -> DataFrame:
    """lang, key, words, a, l, r, score, k of every frequent phrase, by its lowest-scoring cut."""
    phrases = found.counts.where("words > 1").withColumnRenamed("f", "a")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({"_left": _part(0, F.col("k")), "_right": _part(F.col("k"), F.col("words") - F.col("k"))})
    left = found.counts.select("lang", F.col("key").alias("_left"), F.col("f").alias("l"))
    right = found.counts.select("lang", F.col("key").alias("_right"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "_left"]).join(right, ["lang", "_right"])
    both = (_exact("l") * _exact("r")).cast("decimal(38,0)")
    cuts = cuts.withColumn("score", _div((_exact("a") * _exact("a")).cast("decimal(38,0)") * F.lit(SCALE), both))
    lowest = cuts.groupBy("lang", "key", "words").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("_cut"))
    return lowest.select("lang", "key", "words", "_cut.a", "_cut.l", "_cut.r", "_cut.score", "_cut.k")


def collocations(docs: DataFrame, min_count: int = 10, max_words: int = 3, covered: int = 50, first: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``first`` best phrases of every language.

    A phrase goes if a longer one that holds it has ``covered`` per cent of its occurrences or more.
    """
    found = frequent(docs, min_count, max_words)
    phrases = scored(found)
    if max_words > 2:
        spans = F.expr("flatten(transform(sequence(2, words - 1), m -> transform(sequence(0, words - m), i -> struct(i, m))))")
        inner = found.counts.where("words > 2").withColumn("_span", F.explode(spans))
        inner = inner.select("lang", _part(F.col("_span.i"), F.col("_span.m")).alias("key"), "f").groupBy("lang", "key").agg(F.max("f").alias("_longer"))
        phrases = phrases.join(inner, ["lang", "key"], "left").where(F.coalesce(100 * F.col("_longer") < covered * F.col("a"), F.lit(True))).drop("_longer")
    phrases = stored(phrases, "phrases-scored")
    # The (score, a) that the first ranks reach down to, then only their phrases get their words.
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    steps = phrases.groupBy("lang", "score", "a").count().withColumn("_nth", F.row_number().over(best)).where(F.col("_nth") <= first)
    above = F.coalesce(F.sum("count").over(best.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    steps = steps.withColumn("_above", above).where(F.col("_above") < first).select("lang", "score", "a")
    top = phrases.join(steps, ["lang", "score", "a"])
    for k in range(max_words):
        names = found.names.select("lang", F.col("key").alias("_key"), F.col("word").alias(f"_word{k}"))
        top = top.withColumn("_key", _part(k, 1)).join(names, ["lang", "_key"], "left").drop("_key")
    top = top.withColumn("phrase", F.concat_ws(" ", *(f"_word{k}" for k in range(max_words))))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = top.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= first)
    return ranked.join(found.totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
