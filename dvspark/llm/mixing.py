"""11: mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

A source's words are a stream: its documents in an order shuffled by a hash,
cut into blocks of ``BLOCK`` words, from the start again when they are used up
(at most ``REPEATS`` times).  The mix is a row of slots.  Slot i gets the point
frac(i * golden ratio), reckoned in whole numbers of 2**-64, and the point's
place among the sources' cumulative targets names the slot's source, so any
run of slots holds every source nearly in proportion.  A source's slots are
ranked, and its j-th slot takes block j of the stream.

The points miss a share by a few slots at most.  Slots of a source that has its
target are left out, and what a source still lacks comes in closing slots at
the end, so a source gives ``floor(target)`` words, to the word.

Targets: every source's weight's share of all words, at most ``REPEATS`` times
the source's own words; what is cut off there is shared by weight among the
others until none is above.

At scale: nothing is ranked or summed up in one task or on the driver.  Slots
are ranked in chunks of ``CHUNK``, documents in cells of their hash, and totals
before a chunk or cell are added to that.  Slots meet sources by an equi-join
on ``CELLS`` stretches of the cumulative targets, and blocks by (source, block).
The targets take a pass over the table of sources for each time that further
sources are cut off.  Rows equal in source, doc_id and text are one entry with
a number of copies, so a text on a third of all rows is no hot key.

Defined cases: null text has no words; null source is a source of its own, the
last; null and repeated doc_ids, extra columns with any names: allowed; sources
or tables without words have target 0; no rows: no rows.  Reruns give the same,
as the order depends on doc_id and text only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dvspark.llm.common import stored
from dvspark.llm.ordered import explode_range, in_order, with_total_before

#: Words of a block.
BLOCK = 1024
#: Most times that a source's words are used.
REPEATS = 3
#: Slots that are ranked together.
CHUNK = 1 << 16
#: Stretches of the cumulative targets that slots and sources meet on.
CELLS = 1 << 16
#: Entries that are ordered together, about.
CELL_ROWS = 1 << 11
#: Hexadecimal digits of the hash that shuffles.
DIGITS = 15

#: 2**64 / golden ratio, to the next odd number.
_GOLDEN = 0x9E3779B97F4A7C15
_WORDS = r"[^\x20\x09-\x0D]+"


def cycle(nth: Column) -> Column:
    """Weights 1, 2, 3, 1, ... by the source's place among all (from 0)."""
    return nth % 3 + 1


@dataclass
class Mix:
    """``sources``: src, source, size, weight, target, goal (words to take).  ``entries``: doc by doc, with ``copies`` and
    where its words begin in its source's stream.  ``pieces``: slot by slot, which words of which entry."""

    sources: DataFrame
    entries: DataFrame
    pieces: DataFrame


def _exact(c) -> Column:
    return F.col(c).cast("decimal(38,0)") if isinstance(c, str) else F.lit(str(c)).cast("decimal(38,0)")


def _div(a: Column, b: Column) -> Column:
    """Whole-numbered quotient of decimals, without rounding."""
    return ((a - F.pmod(a, b)) / b).cast("long")


def targets(sources: DataFrame) -> DataFrame:
    """``target`` and ``goal`` of sources with ``size`` and a whole-numbered ``weight``; all sizes are shared out by weight."""
    total, weights = sources.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    most = F.col("size") * REPEATS
    left, share, cut = total, weights, -1
    while True:
        # An equal share a weight only grows from round to round, so who was cut off stays so.
        above = _exact("weight") * _exact(left) > _exact("size") * REPEATS * _exact(share)
        n, used, gone = sources.where(above).agg(F.count(F.lit(1)), F.coalesce(F.sum(most), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
        if n == cut or gone == weights:
            break
        left, share, cut = total - used, weights - gone, n
    if not total:
        return sources.withColumns({"target": F.lit(0.0), "goal": F.lit(0).cast("long")})
    whole = _div(_exact("weight") * _exact(left), _exact(share))
    part = F.col("weight").cast("double") * F.lit(float(left)) / F.lit(float(share))
    return sources.withColumns({"target": F.when(above, most.cast("double")).otherwise(part), "goal": F.when(above, most).otherwise(whole)})


def schedule(sources: DataFrame) -> DataFrame:
    """slot, src, block, words: the slots of sources (src, size, goal, ``_part``, ``_nth``) in order, without holes in a source's rank."""
    spark = sources.sparkSession
    whole = F.floor(F.col("goal") / F.col("size")).cast("long")
    each = F.ceil(F.col("size") / BLOCK).cast("long")
    need = whole * each + F.ceil((F.col("goal") - whole * F.col("size")) / BLOCK).cast("long")
    given = sources.where("goal > 0").select("src", "size", "goal", "_part", "_nth", each.alias("_blocks"), need.alias("_need"))
    given = stored(with_total_before(given, F.col("goal"), "_from"), "mix-goals")
    total, = given.agg(F.coalesce(F.sum("goal"), F.lit(0))).first()
    n, stretch = -(-total // BLOCK), max(1, -(-total // CELLS))
    spread = explode_range(given.select("src", "_from", (F.col("_from") + F.col("goal")).alias("_to")), F.floor(F.col("_from") / stretch), F.floor((F.col("_to") - 1) / stretch), "_cell")
    point = F.pmod(_exact("slot") * _exact(_GOLDEN), _exact(1 << 64))
    slots = spark.range(n).withColumnRenamed("id", "slot").withColumn("_at", _div(point * _exact(total), _exact(1 << 64))).withColumn("_cell", F.floor(F.col("_at") / stretch))
    slots = slots.join(spread, "_cell").where("_at >= _from AND _at < _to").select("slot", "src", F.floor(F.col("slot") / CHUNK).alias("_chunk"))
    slots = stored(slots, "mix-slots")
    before = Window.partitionBy("src").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = slots.groupBy("src", "_chunk").count().select("src", "_chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("src", "_chunk").orderBy("slot")) - 1
    ranked = slots.withColumn("_rank", rank).join(chunks, ["src", "_chunk"]).select("slot", "src", (F.col("_before") + F.col("_rank")).alias("rank"))
    ranked = ranked.join(given.select("src", "_need"), "src").where("rank < _need").drop("_need")
    lacking = given.join(slots.groupBy("src").count(), "src", "left").withColumn("_have", F.coalesce("count", F.lit(0)))
    lacking = with_total_before(lacking.select("src", "_part", "_nth", "_have", "_need"), F.greatest(F.col("_need") - F.col("_have"), F.lit(0)), "_behind")
    closing = explode_range(lacking, F.col("_have"), F.col("_need") - 1, "rank").select((F.lit(n) + F.col("_behind") + F.col("rank") - F.col("_have")).alias("slot"), "src", "rank")
    placed = ranked.unionByName(closing).join(given.select("src", "size", "goal", "_blocks"), "src")
    placed = placed.withColumn("block", F.col("rank") % F.col("_blocks")).withColumn("_start", F.floor(F.col("rank") / F.col("_blocks")) * F.col("size") + F.col("block") * BLOCK)
    words = F.least(F.lit(BLOCK), F.col("size") - F.col("block") * BLOCK, F.col("goal") - F.col("_start"))
    return placed.select("slot", "src", "block", words.cast("long").alias("words"))


def shuffled(rows: DataFrame) -> DataFrame:
    """Entries (src, doc_id, digest, size, copies) with ``start``: the words of the source before them in the order of their hashes."""
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "digest").cast("binary"))
    n = rows.count()
    bits = max(0, (n // CELL_ROWS).bit_length())
    order = F.conv(F.substring(key, 1, DIGITS), 16, 10).cast("long")
    placed = rows.withColumn("_order", order).withColumn("_cell", F.shiftright("_order", 4 * DIGITS - bits))
    words = F.col("size") * F.col("copies")
    cells = placed.groupBy("src", "_cell").agg(F.sum(words).alias("_sum"))
    before = Window.partitionBy("src").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("src", "_cell", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("src", "_cell").orderBy("_order", "doc_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_in", F.coalesce(F.sum(words).over(within), F.lit(0)))
    return placed.join(cells, ["src", "_cell"]).withColumn("start", F.col("_before") + F.col("_in")).drop("_order", "_cell", "_in", "_before")


def mix(docs: DataFrame, weight: Callable[[Column], Column] = cycle) -> Mix:
    """The mix of ``docs`` (doc_id, text, source); ``weight`` of a source by its place in code-point order."""
    size = F.coalesce(F.regexp_count("text", F.lit(_WORDS)), F.lit(0)).cast("long")
    sized = docs.select("source", "doc_id", F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("null")).alias("digest"), size.alias("size"))
    entries = stored(sized.groupBy("source", "doc_id", "digest", "size").agg(F.count(F.lit(1)).alias("copies")), "mix-entries")
    sources = entries.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("size"))
    sources = with_total_before(in_order(sources, "mix-sources", F.col("source").asc_nulls_last()), F.lit(1), "src")
    sources = stored(sources.withColumn("weight", weight(F.col("src")).cast("long")), "mix-weights")
    sources = stored(targets(sources), "mix-targets")
    known = sources.select("src", F.col("source").alias("_source"))
    placed = entries.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("source", "_source")
    placed = stored(shuffled(placed), "mix-order")
    held = explode_range(placed.where("size > 0"), F.floor(F.col("start") / BLOCK), F.floor((F.col("start") + F.col("size") * F.col("copies") - 1) / BLOCK), "block")
    lo = F.greatest(F.col("block") * BLOCK, F.col("start"))
    hi = F.least(F.col("block") * BLOCK + F.col("words"), F.col("start") + F.col("size") * F.col("copies"))
    pieces = schedule(sources).join(held, ["src", "block"]).withColumns({"_lo": lo, "_hi": hi}).where("_lo < _hi")
    pieces = pieces.select(
        "slot", (F.col("_lo") - F.col("block") * BLOCK).alias("at"), "src", "doc_id", "digest", "size",
        (F.col("_lo") - F.col("start")).alias("first"), (F.col("_hi") - F.col("start")).alias("behind"),
    )
    return Mix(sources, placed, pieces)


def words_taken(mixed: Mix) -> DataFrame:
    """A row for every row of the mixed documents: doc_id, size, src, source, source_size, target, taken.

    Copies of one entry come one behind the other in the stream, so of the
    words taken in its last, unfinished round the first copies have theirs.
    """
    key = ["src", "doc_id", "digest", "size"]
    taken = mixed.pieces.groupBy(*key).agg(F.sum(F.col("behind") - F.col("first")).alias("_taken")).toDF(*(f"_{c}" for c in key), "_taken")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) if c == "doc_id" else F.col(c) == F.col(f"_{c}") for c in key]
    entries = mixed.entries.join(taken, same, "left").drop(*(f"_{c}" for c in key)).withColumn("_taken", F.coalesce("_taken", F.lit(0)))
    rows = explode_range(entries, F.lit(0).cast("long"), F.col("copies") - 1, "copy")
    words = F.col("size") * F.col("copies")
    rounds = F.when(words > 0, F.floor(F.col("_taken") / words)).otherwise(0)
    rest = F.least(F.greatest(F.col("_taken") - rounds * words - F.col("copy") * F.col("size"), F.lit(0)), F.col("size"))
    sources = mixed.sources.select("src", "source", F.col("size").alias("source_size"), "target")
    return rows.withColumn("taken", (rounds * F.col("size") + rest).cast("long")).join(sources, "src").select("doc_id", "size", "source_size", "target", "taken", "source", "src")


def mixed_texts(mixed: Mix, docs: DataFrame) -> DataFrame:
    """The mix itself: slot, at (words of the slot before), source, doc_id, text (the piece's words, one blank between)."""
    sources = mixed.sources.select("src", "source")
    digest = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("null"))
    whole = docs.select(F.col("source").alias("_source"), F.col("doc_id").alias("_doc_id"), digest.alias("_digest"), F.regexp_extract_all("text", F.lit(_WORDS), 0).alias("_words"))
    whole = whole.groupBy("_source", "_doc_id", "_digest").agg(F.first("_words").alias("_words"))
    rows = mixed.pieces.join(sources, "src")
    rows = rows.join(whole, (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source")))
    # A piece over several copies: its words by their place in one copy.
    words = F.transform(F.sequence(F.col("first"), F.col("behind") - 1), lambda k: F.element_at("_words", (k % F.col("size") + 1).cast("int")))
    return rows.select("slot", "at", "source", "doc_id", F.array_join(words, " ").alias("text"))
