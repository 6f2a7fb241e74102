"""Near duplicates by a signature-coordinate inverted join, confirmed on full shingle sets.

1. Every text becomes its set of distinct 5-word shingles (64-bit hashes) and
   a signature of ``COORDINATES`` minimum hashes.  Texts with equal sets form a
   class, held by the smallest doc_id; all that follows is about classes.
2. Classes are posted under coordinate-value pairs.  Two classes with at least
   ``matches`` equal coordinates (see ``matches_needed``) must meet within the
   first COORDINATES - matches + 1 coordinates of any order common to all, so
   only that prefix is posted, values on long lists last (they are the least
   telling).
3. Short lists: the collisions of each pair are counted, and the pair's whole
   signatures compared; pairs at the match threshold that could reach the
   similarity by their set sizes are confirmed on their full sets.
4. Long lists (more than ``LONG`` classes).  A class is there only if at least
   matches of its coordinates are shared by that many classes: one of a crowd
   of near copies.  Its pairs are not listed.  Classes that share long lists
   form a crowd; a crowd is dealt into blocks of ``BLOCK`` classes, and every
   two blocks meet in one task, which counts each class's common shingles with
   all others at once by merging the posting lists of its shingles, skipping
   lists that hold one class alone.  The task returns a spanning forest of the
   confirmed links, so a crowd of n classes gives some n links for each block
   of others, not n * n.
5. Components of the confirmed links; each class's members follow it.

The signature decides which pairs are looked at: ``matches`` follows from the
similarity asked for, so that a pair just at it has a chance of under ``MISS``
to fall below (0.85: 39 of 64, chance 6.3e-7; 0.80: 34, 3.2e-7).  Everything
else is exact.

Defined cases: null, empty and white-space-only texts have no shingle and link
with nothing; fewer than five words count as one shingle; rows that repeat a
doc_id are one document with the links of each of its texts, reported per row;
null doc_ids are kept, link with nothing and have no component; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dvspark.llm.bitmaps import Bitmap, bitmap_of
from dvspark.llm.blocks import mix, word_blocks
from dvspark.llm.common import stored
from dvspark.llm.components import components

WORDS = 5
COORDINATES = 64
MISS = 1e-6
LONG = 48
BLOCK = 1024

_STEP = np.array([pow(0x9FB21C651E98DF25, k + 1, 1 << 64) for k in range(WORDS)], dtype=np.uint64)
_COORD = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def matches_needed(percent: int) -> int:
    """The most equal coordinates that a pair of this similarity has but for a chance below MISS (binomial)."""
    p = percent / 100
    at_most = np.cumsum([math.comb(COORDINATES, k) * p**k * (1 - p) ** (COORDINATES - k) for k in range(COORDINATES + 1)])
    return max(1, int(np.searchsorted(at_most, MISS)))


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text in turn."""
    for first, last, block in word_blocks(column):
        h, n = block.hash, len(block.hash)
        rolled = np.zeros(max(0, n - WORDS + 1), np.uint64)
        for k in range(WORDS if len(rolled) else 0):
            rolled += h[k : n - WORDS + 1 + k] * _STEP[k]
        rolled = mix(rolled)
        for k in range(last - first):
            a, b = int(block.first[k]), int(block.first[k + 1])
            if b - a >= WORDS:
                yield np.unique(rolled[a : b - WORDS + 1])
            elif b > a:
                yield mix(np.array([(h[a:b] * _STEP[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The top 32 bits of the least product of any shingle with each coordinate's factor."""
    least = np.full(COORDINATES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for first in range(0, len(shingles), 4096):
        np.minimum(least, (_COORD[:, None] * shingles[None, first : first + 4096]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def set_key(shingles: np.ndarray) -> bytes:
    """Names a set by its size and two independent 64-bit sums."""
    return np.array([len(shingles), shingles.sum(dtype=np.uint64), mix(shingles + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64)], np.uint64).tobytes()


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, sizes, keys, signs = [], [], [], []
        for doc_id, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1)), strict=True):
            ids.append(doc_id)
            sizes.append(len(s))
            keys.append(set_key(s))
            signs.append(signature(s).view(np.int32) if len(s) else None)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signs, pa.list_(pa.int32()))], names=["doc_id", "n_shingles", "set_key", "sig"])


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [*shingle_sets(batch.column(1))]
        yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["set_key", "shingles"])


def _post(coord: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Hash that names a list: a coordinate and its value."""
    return mix((coord.astype(np.uint64) + np.uint64(1)) << np.uint64(32) | value.view(np.uint32).astype(np.uint64))


def _list_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        coord, value = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int32) for k in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(_post(coord, value).view(np.int64))], ["post"])


def _late(long_lists: Bitmap):
    """(cid, n, sig) -> also late: the coordinates whose values are on long lists.

    The bitmap lets a few other lists pass as long, for all classes alike, so
    the order of coordinates is still common to all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, COORDINATES)
            row, coord = np.nonzero(long_lists.has(_post(np.arange(COORDINATES)[None, :], sig)))
            bounds = np.searchsorted(row, np.arange(len(sig) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(bounds), pa.array(coord.astype(np.int32)))], ["cid", "n", "sig", "late"])

    return run


def _local_crowds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cid, coords, sig) -> (cid, lead, null) of every class and (null, lead, post) of the lists of each lead.

    Classes of a batch that share lists, directly or through others, get one
    lead (the smallest cid), so that a crowd is joined on its lists' names once
    a batch and not once a class.
    """
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        order = np.argsort(ids)
        sizes = np.diff(np.asarray(batch.column(1).offsets))
        row = np.repeat(np.arange(len(ids)), sizes)
        coord = batch.column(1).flatten().to_numpy(zero_copy_only=False)
        sig = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, COORDINATES)
        post = _post(coord, np.ascontiguousarray(sig[row, coord]))
        lists, at = np.unique(post, return_inverse=True)
        lead = np.empty(len(ids), np.int64)
        lead[order] = np.arange(len(ids))  # by rank of the cid
        while True:  # the least lead around, over lists and back, with leads of leads taken at once
            least = np.full(len(lists), len(ids), np.int64)
            np.minimum.at(least, at, lead[row])
            new = lead.copy()
            np.minimum.at(new, row, least[at])
            new = np.minimum(new, new[order[new]])
            if (new == lead).all():
                break
            lead = new
        held = np.unique(np.stack([lead[row], at], axis=1), axis=0) if len(row) else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[order[lead]]), pa.nulls(len(ids), pa.int64())], ["cid", "lead", "post"])
        yield pa.RecordBatch.from_arrays([pa.nulls(len(held), pa.int64()), pa.array(ids[order[held[:, 0]]]), pa.array(lists[held[:, 1]].view(np.int64))], ["cid", "lead", "post"])


def _linked(a: int, b: int, common: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (a + b - common)


def _confirmed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = pa.Table.from_batches([batch])
        sets = [[np.frombuffer(x, np.uint64) for x in table[c].to_pylist()] for c in ("set_a", "set_b")]
        keep = [bool(_linked(len(x), len(y), len(x) + len(y) - len(np.unique(np.concatenate([x, y]))), percent)) for x, y in zip(*sets, strict=True)]
        found = table.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        yield from found.to_batches()


def _crowd_links(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Spanning forest of the links between the two blocks of one task (or within its only block)."""
    pdf = pdf.sort_values("cid")
    ids, side = pdf["cid"].to_numpy(), pdf["block"].to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    every, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(inverse, kind="stable")
    posting, begin = owner[order], np.concatenate([[0], np.cumsum(count)])
    offset = np.concatenate([[0], np.cumsum(sizes)])
    parent = np.arange(len(sets))

    def top(k: int) -> int:
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    links = []
    two = len(np.unique(side)) > 1
    for k in range(len(sets)):
        mine = inverse[offset[k] : offset[k + 1]]
        mine = mine[count[mine] > 1]  # lists that hold this class alone are skipped
        size = count[mine]
        if not len(mine):
            continue
        index = np.repeat(begin[mine] - np.cumsum(size) + size, size) + np.arange(size.sum())
        common = np.bincount(posting[index], minlength=len(sets))
        near = _linked(sizes[k], sizes, common, percent)
        near[: k + 1] = False
        if two:
            near &= side != side[k]
        for other in np.flatnonzero(near).tolist():
            x, y = top(k), top(other)
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append((ids[k], ids[other]))
    return pd.DataFrame(links, columns=["a", "b"]).astype("int64")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``; a link: 100 * intersection >= percent * union."""
    needed = matches_needed(percent)
    prefix = COORDINATES - needed + 1
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(texts.mapInArrow(_signed, "doc_id long, n_shingles long, set_key binary, sig array<int>"), "signatures")
    with_set = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = with_set.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").cast("int").alias("n"), F.first("sig").alias("sig"))
    classes = stored(classes.withColumn("cid", F.xxhash64("set_key")), "classes")

    posted = classes.select("cid", F.posexplode("sig").alias("coord", "value"))
    long_lists = posted.groupBy("coord", "value").count().where(F.col("count") > LONG).select("coord", "value").mapInArrow(_list_names, "post long")
    # The common order: coordinates on short lists first, then those on long lists, each by number.
    ranked = classes.select("cid", "n", "sig").mapInArrow(_late(bitmap_of(stored(long_lists, "long-lists"), "post")), "cid long, n int, sig array<int>, late array<int>")
    ranked = stored(ranked, "ranked")
    early = F.array_except(F.sequence(F.lit(0), F.lit(COORDINATES - 1)), F.col("late"))
    short = ranked.select("cid", "n", "sig", F.explode(F.slice(early, 1, prefix)).alias("coord"))
    short = short.select("cid", "n", "coord", F.element_at("sig", F.col("coord") + 1).alias("value"))
    lists = short.groupBy("coord", "value").agg(F.sort_array(F.collect_list(F.struct("cid", "n"))).alias("post")).where(F.size("post") > 1)
    pairs = lists.select(F.posexplode("post").alias("i", "x"), "post").select("x", F.explode(F.expr("slice(post, i + 2, size(post))")).alias("y"))
    small, large = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    pairs = pairs.where(100 * small.cast("long") >= percent * large).select(F.col("x.cid").alias("a"), F.col("y.cid").alias("b"))
    counted = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("met"))
    both = counted.join(classes.select(F.col("cid").alias("a"), F.col("sig").alias("sig_a")), "a").join(classes.select(F.col("cid").alias("b"), F.col("sig").alias("sig_b")), "b")
    matches = F.expr("size(filter(zip_with(sig_a, sig_b, (p, q) -> p = q), m -> m))")
    candidates = stored(both.where(matches >= needed).select("a", "b"), "candidates")

    in_crowd = ranked.where(F.size(early) < prefix).select("cid", F.slice(F.sort_array("late"), 1, F.lit(prefix) - F.size(early)).alias("coords"), "sig")
    local = stored(in_crowd.mapInArrow(_local_crowds, "cid long, lead long, post long"), "local-crowds")
    posts = local.where("post IS NOT NULL").select("lead", "post")
    heads = posts.groupBy("post").agg(F.min("lead").alias("head"))
    around = posts.join(heads, "post").select(F.col("lead").alias("cid"), "head").union(local.where("cid IS NOT NULL").select("cid", "lead")).distinct()
    crowds = components(around, "cid", "head").select(F.col("node").alias("cid"), F.col("component").alias("crowd"))
    crowds = stored(crowds, "crowds")
    sized = crowds.groupBy("crowd").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = crowds.join(sized, "crowd").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))

    wanted = candidates.select(F.col("a").alias("cid")).union(candidates.select("b")).union(crowds.select("cid")).distinct()
    wanted = classes.join(wanted, "cid", "left_semi").select("set_key", "cid", F.col("rep").alias("doc_id"))
    sets = texts.join(wanted.select("doc_id"), "doc_id", "left_semi").mapInArrow(_with_sets, "set_key binary, shingles binary")
    sets = stored(sets.join(wanted.select("set_key", "cid"), "set_key").dropDuplicates(["cid"]).select("cid", "shingles"), "sets")

    pair_sets = candidates.join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("set_a")), "a").join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("set_b")), "b")
    links = pair_sets.mapInArrow(lambda batches: _confirmed(batches, percent), "a long, b long")

    # Every two blocks of a crowd meet in one task, a block with itself too; a class goes to all tasks of its block.
    tasks = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("block", o).alias("lo"), F.greatest("block", o).alias("hi")))
    meet = dealt.select("cid", "crowd", "block", F.explode(tasks).alias("task")).select("cid", "crowd", "block", "task.lo", "task.hi")
    crowd_links = meet.join(sets, "cid").groupBy("crowd", "lo", "hi").applyInPandas(lambda pdf: _crowd_links(pdf, percent), "a long, b long")

    # The texts of a doc_id that the table repeats are one document.
    same = with_set.select("doc_id", F.xxhash64("set_key").alias("cid")).groupBy("doc_id").agg(F.min("cid").alias("a"), F.collect_set("cid").alias("all")).where(F.size("all") > 1)
    same = same.select("a", F.explode("all").alias("b"))
    found = components(links.union(crowd_links).union(same), "a", "b").withColumnRenamed("node", "cid")
    named = classes.select("cid", "rep").join(found, "cid")
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "component").select("cid", "component_id")
    of_class = classes.select("set_key", "cid", "rep").join(named, "cid", "left").select("set_key", F.coalesce("component_id", "rep").alias("component_id"))
    out = signed.select("doc_id", "n_shingles", "set_key").join(of_class, "set_key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
