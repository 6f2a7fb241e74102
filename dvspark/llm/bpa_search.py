"""12: ranked lexical search by the Best Position Algorithm over impact lists.

Terms are runs of letters, digits and all bytes beyond ASCII, A-Z lower-cased.
The documents are read once: every text gives its number of terms and the
counts of those terms that a query may ask for.  Weights come from counts over
all documents.

The documents are searched shard by shard, a shard being the next documents of
a partition, as many as give ``CELLS`` (term, document) cells.  Each term has an
impact list there, its documents by falling score, and a query's lists are read
side by side (sorted accesses).  A document met for the first time is looked up
in all lists at once (direct accesses), and its places in them are marked as
seen.  A list's best position is the end of its unbroken run of seen places from
the top; no document still unseen scores more than the sum of the lists' scores
there, which is tighter than at the last places read.  A query stops once that
sum is strictly below its k-th best score, of this shard or of those that the
task searched before, so ties at the k-th place are all found.  A task hands on
at most k documents a query, and those are ranked.

Queries go in blocks of about ``BLOCK_TERMS`` terms, one job a block; what a
block holds is all that reaches the driver.  Terms are compared by 64-bit
hashes: the chance that any of a billion other terms falls on one of a block's
is 1e-6.

Defined cases: texts without terms (null, empty) are in no count and never
found; queries without known terms give no rows; documents that repeat a doc_id
are ranked each on their own, null doc_ids last among equal scores; items equal
in id and text are one, others with the same id are searched apart; fewer than
k documents with a score above 0: all of them; extra columns with any names;
empty tables: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dvspark.llm.bitmaps import Bitmap, bitmap_of
from dvspark.llm.common import stored
from dvspark.llm.ordered import in_order, with_total_before
from dvspark.llm.runs import Powers, byte_table, segments
from dvspark.session import work_path

#: Terms of a block of queries, about.
BLOCK_TERMS = 1 << 14
#: Cells of a shard, for terms of the block by documents.
CELLS = 1 << 22
#: Places read from every list in the first round; each round reads twice as many.
FIRST_READ = 8
#: Shares of the length rule, in hundredths.
LENGTH_SHARE = 75

_BETWEEN = ~byte_table(range(0x30, 0x3A), range(0x41, 0x5B), range(0x61, 0x7B), range(0x80, 0x100))


def _row_counts(texts: pa.Array, keep: Bitmap | None, powers: Powers):
    """For the rows of a batch: number of terms; row, hash and count of the kept ones, by row and hash."""
    n = np.zeros(len(texts), np.int64)
    parts, last, split = [], -1, False
    for s in segments(texts, _BETWEEN, _BETWEEN, powers):
        if not len(s.row):
            continue
        n += np.bincount(s.row, minlength=len(n))
        split |= int(s.row[0]) == last  # a long row goes on
        last = int(s.row[-1])
        row, h = s.row, s.hash
        if keep is not None:
            known = keep.has(h)
            row, h = row[known], h[known]
        parts.append(_summed(row, h, np.ones(len(row), np.int64)))
    if not parts:
        return n, np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    row, h, count = (np.concatenate(x) for x in zip(*parts))
    return (n, *(_summed(row, h, count) if split else (row, h, count)))


def _summed(row: np.ndarray, h: np.ndarray, count: np.ndarray):
    order = np.lexsort((h, row))
    row, h, count = row[order], h[order], count[order]
    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])][: len(row)])
    return row[first], h[first], np.add.reduceat(count, first) if len(first) else count[:0]


def term_counts(rows: DataFrame, key: str, text: str, keep: Bitmap | None = None) -> DataFrame:
    """key, n (terms with repeats), terms (distinct hashes, those in ``keep`` only), tfs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            n, row, h, tf = _row_counts(batch.column(0), keep, powers)
            bounds = pa.array(np.searchsorted(row, np.arange(len(n) + 1)).astype(np.int32))
            terms = pa.ListArray.from_arrays(bounds, pa.array(h.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(n), terms, pa.ListArray.from_arrays(bounds, pa.array(tf))], ["key", "n", "terms", "tfs"])

    given = rows.select(F.col(text).alias("text"), F.col(key).cast("long").alias("key"))
    return given.mapInArrow(count, "key long, n long, terms array<long>, tfs array<long>")


class Shard:
    """Impact lists of some documents, and where each document stands in them.  ``term``: the term's place in the block."""

    def __init__(self, n: np.ndarray, row: np.ndarray, term: np.ndarray, tf: np.ndarray, terms: int, docs_all: int, words_all: int):
        m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * docs_all) // words_all
        score = (1_000_000_000 * tf) // (1000 * tf + 8 * m[row])
        order = np.lexsort((row, -score, term))
        term, self.doc, self.score = term[order], row[order], score[order]
        self.first = np.searchsorted(term, np.arange(terms + 1))
        self.place = np.full((terms, len(n)), -1, np.int32)
        self.place[term, self.doc] = np.arange(len(term)) - self.first[term]
        self.docs = len(n)

    def best(self, terms: np.ndarray, factor: np.ndarray, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(doc, score) of the k best by (-score, doc), among those above 0; documents below ``floor`` may be left out."""
        length = self.first[terms + 1] - self.first[terms]
        terms, factor, length = terms[length > 0], factor[length > 0], length[length > 0]
        first = self.first[terms]
        base = np.cumsum(length) - length
        seen, known = np.zeros(int(length.sum()), bool), np.zeros(self.docs, bool)
        best = np.zeros(len(terms), np.int64)  # places seen without a gap from the top
        docs, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        top = np.zeros(0, np.int64)
        depth, read = 0, FIRST_READ
        while len(terms) and depth < length.max():
            at = np.arange(depth, min(depth + read, int(length.max())))
            there = at[None, :] < length[:, None]
            new = np.unique(self.doc[(first[:, None] + at[None, :])[there]])
            new = new[~known[new]]
            known[new] = True
            depth, read = depth + read, read * 2
            step = max(1, (1 << 20) // len(terms))
            for part in (new[i : i + step] for i in range(0, len(new), step)):
                place = self.place[terms[:, None], part[None, :]]
                lists, hits = np.nonzero(place >= 0)
                place = place[lists, hits].astype(np.int64)
                total = np.zeros(len(part), np.int64)
                np.add.at(total, hits, factor[lists] * self.score[first[lists] + place])
                seen[base[lists] + place] = True
                docs.append(part)
                scores.append(total)
                top = np.concatenate([top, total])
                if len(top) > k:
                    top = np.partition(top, len(top) - k)[len(top) - k :]
            bound = 0
            for i in range(len(terms)):
                rest = seen[base[i] + best[i] : base[i] + length[i]]
                best[i] = length[i] if rest.all() else best[i] + int(rest.argmin())
                if best[i] < length[i]:
                    bound += int(factor[i] * self.score[first[i] + best[i] - 1])
            kth = int(top.min()) if len(top) == k else 0
            if max(kth, floor) > bound:
                break
        doc, score = np.concatenate(docs), np.concatenate(scores)
        order = np.lexsort((doc, -score))[:k]
        order = order[score[order] > 0]
        return doc[order], score[order]


class Block:
    """Some queries: each one's distinct terms (places in ``terms``) and their weights by how often it asks for them."""

    def __init__(self, rows):
        self.terms = np.unique(np.array([r.term for r in rows], np.int64).view(np.uint64))
        q = np.array([r.q for r in rows], np.int64)
        factor = np.array([r.weight * r.times for r in rows], np.int64)
        at = np.searchsorted(self.terms, np.array([r.term for r in rows], np.int64).view(np.uint64))
        order = np.argsort(q, kind="stable")
        self.q, start = np.unique(q[order], return_index=True)
        self.terms_of = np.split(at[order], start[1:])
        self.factor_of = np.split(factor[order], start[1:])


def _search(block: Block, docs_all: int, words_all: int, k: int):
    """mapInArrow function over (key, n, terms, tfs): the best k documents of the partition for every query."""
    width = max(64, CELLS // max(1, len(block.terms)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {}  # query -> its best so far: keys, null marks, scores

        def shard(batch: pa.RecordBatch) -> None:
            n = batch.column(1).to_numpy(zero_copy_only=False)
            null = np.asarray(batch.column(0).is_null())
            key = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            order = np.lexsort((key, null))  # equal scores go by doc_id
            lists, tf = batch.column(2), batch.column(3).flatten().to_numpy(zero_copy_only=False)
            sizes = np.diff(np.asarray(lists.offsets))
            rank = np.empty(len(n), np.int64)
            rank[order] = np.arange(len(n))
            row, h = np.repeat(rank, sizes), lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.minimum(np.searchsorted(block.terms, h), len(block.terms) - 1)
            asked = block.terms[at] == h
            held = Shard(n[order], row[asked], at[asked], tf[asked], len(block.terms), docs_all, words_all)
            for q, terms, factor in zip(block.q, block.terms_of, block.factor_of):
                have = found.get(q)
                floor = int(have[2][-1]) if have is not None and len(have[2]) == k else 0
                doc, score = held.best(terms, factor, k, floor)
                if not len(doc):
                    continue
                keys, nulls = key[order][doc], null[order][doc]
                if have is not None:
                    keys, nulls, score = (np.concatenate(x) for x in zip(have, (keys, nulls, score)))
                first = np.lexsort((keys, nulls, -score))[:k]
                found[q] = keys[first], nulls[first], score[first]

        waiting, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, width - rows)
                waiting.append(part)
                rows += part.num_rows
                batch = batch.slice(part.num_rows)
                if rows == width:
                    shard(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])
                    waiting, rows = [], 0
        if rows:
            shard(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])
        for q, (keys, nulls, scores) in found.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), q)), pa.array(keys, mask=nulls), pa.array(scores)], ["q", "doc_id", "score"])

    return run


def search(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` best documents (doc_id, text) of every query (item_id, text)."""
    spark = docs.sparkSession
    items = queries.select("item_id", "text").distinct()
    items = stored(with_total_before(in_order(items, "search-items", F.col("item_id"), F.col("text")), F.lit(1), "q"), "search-queries")
    asked = stored(term_counts(items, "q", "text"), "search-asked")
    terms = asked.select(F.explode("terms").alias("term"))
    counts = stored(term_counts(docs, "doc_id", "text", bitmap_of(terms, "term")), "search-counts")
    docs_all, words_all = counts.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000.0 * F.log((F.lit(2 * docs_all + 2) / (2 * F.col("df") + 1)).cast("double"))).cast("long")
    weights = held.join(terms.distinct(), "term", "left_semi").select("term", weight.alias("weight")).where("weight > 0")
    blocks = items.join(asked.select(F.col("key").alias("q"), "terms", "tfs"), "q")
    blocks = with_total_before(blocks, F.size("terms"), "before").withColumn("block", F.floor(F.col("before") / BLOCK_TERMS))
    each = blocks.select("block", "q", F.explode(F.arrays_zip("terms", "tfs")).alias("t")).select("block", "q", F.col("t.terms").alias("term"), F.col("t.tfs").alias("times"))
    each = stored(each.join(weights, "term"), "search-weights")
    path = work_path(spark, "search-found")
    schema = "q long, doc_id long, score long"
    spark.createDataFrame([], schema).write.parquet(path)
    for b in sorted(r.block for r in each.select("block").distinct().collect()):  # a row a block
        block = Block(each.where(F.col("block") == b).collect())  # about BLOCK_TERMS rows
        counts.where("n > 0").mapInArrow(_search(block, docs_all, words_all, k), schema).write.mode("append").parquet(path)
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    found = spark.read.schema(schema).parquet(path).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.join(items.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")
