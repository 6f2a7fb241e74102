"""Benchmark decontamination by template windows: copies with other numbers, names or units are found too.

A text becomes template tokens: a number is ``<num>``, a unit behind a number
``<unit>``, a capitalised word that begins no sentence ``<name>``, any other
word itself in lower case; signs fall away and white space of any length and
kind is one blank.  Every window of ``WINDOW`` template tokens is hashed; the
windows of the benchmark's items (shorter items: one window of all their
tokens) are joined with those of the documents.  A window must hold ``LITERAL``
plain words at least, so that placeholders alone match nothing.

Names depend on capitals, so the same tokens give a second set of windows, of
their words and values in lower case without slots: copies in another case.
An item's window counts as matched if either set hits.  Items without a
template window (lists of numbers, tables, names) are matched by the second set
alone, so exactly.  Letters of scripts without blanks are a token each.

For the documents with a hit, the slots' values come back in a second step:
the hits of one item at one offset are one alignment.  Its slots are consistent
if each value of the item stands for one value in the document (two may stand
for the same).  A value that stands for several takes the template windows that
hold it out of the alignment, not the others; if it stands for itself too, as
in a copy with one place edited, only those in which it stands for several.
Verbatim windows always stay.  The share of the item's windows that are left
over all alignments is its coverage; from ``COVERAGE`` on, the document is
contaminated by the item.  So it is, whatever the item's length, if windows
left in one alignment cover ``RUN_WORDS`` tokens in a row.

Only DataFrame and SQL functions run here.  The documents' windows are joined
by a broadcast of the benchmark's while those are counted and few
(``BROADCAST_WINDOWS``), else by a shuffle.  A window hash that occurs in a
third of all documents makes one row for each of them and item, never pairs of
documents.

Defined cases: null and empty texts match nothing, items without a token too;
items of fewer than LITERAL tokens can't be told from chance inside a text and
match the documents that hold these tokens and no others; repeated
items are one by their item_id and text; rows that repeat a doc_id are one
document; null ids match nothing; empty tables give no rows; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dvspark.llm.common import stored

WINDOW = 8
LITERAL = 4
COVERAGE = 0.5
RUN_WORDS = 50
BROADCAST_WINDOWS = 500_000

#: Units that are a slot when a number stands before them.
UNITS = ("km", "m", "cm", "mm", "kg", "g", "mg", "lb", "lbs", "oz", "l", "ml", "mi", "miles", "mile", "ft", "feet", "in", "inches", "inch", "yd", "yards", "h", "hr", "hrs", "hours", "hour", "min", "mins", "minutes", "minute", "s", "sec", "seconds", "second", "days", "day", "weeks", "week", "months", "month", "years", "year", "usd", "eur", "gbp", "dollars", "dollar", "euros", "euro", "pounds", "pound", "cents", "percent", "kmh", "mph", "kw", "kwh", "w", "v", "hz", "gb", "mb", "kb")

_NUM, _UNIT, _NAME = "\u0001", "\u0002", "\u0003"


#: White space, and the marks where a text holds them itself.
_SPACE = r"\x01-\x03\t-\r\x85\p{Z}"


#: Scripts without blanks: Thai, Lao, Myanmar, Khmer, Han, kana, Bopomofo.
_NO_BLANKS = r"\x{E00}-\x{EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{2FD5}\x{3005}-\x{3007}\x{3021}-\x{3029}\x{3040}-\x{312F}\x{31A0}-\x{31BF}\x{31F0}-\x{31FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{A9E0}-\x{A9FF}\x{AA60}-\x{AA7F}\x{F900}-\x{FAFF}\x{FF66}-\x{FF9F}\x{20000}-\x{3FFFF}"

#: Every text with a letter of these scripts has a character of this kind (the ranges left out hold none of them).
_MAY_LACK_BLANKS = r"[\x{E00}-\x{1DFF}\x{2E80}-\x{10FFFF}]"

#: A slot in a marked text; a blank stands before each mark.
_SLOT = rf"[{_NUM}{_UNIT}{_NAME}][^ ]*"


def template_text(text: Column) -> Column:
    """The text, in lower case, with a mark before each slot's value."""
    units = "|".join(sorted(UNITS, key=lambda u: (-len(u), u)))
    spaced = F.regexp_replace(text, rf" [{_SPACE}]+|[{_SPACE}&&[^ ]][{_SPACE}]*", " ")
    # A name: a capital and small letters, behind a word (a comma may stand between), not behind a sentence's end.
    named = F.regexp_replace(spaced, r"\p{Lu}(?<=[\p{L}\p{N}],? \p{Lu})[\p{Ll}\p{M}]+(?![\p{L}\p{M}\p{N}])", f" {_NAME}$0 ")
    numbered = F.regexp_replace(named, r"\p{N}+(?:[.,:]\p{N}+)*", f" {_NUM}$0 ")
    return F.regexp_replace(F.lower(numbered), rf"({_NUM}[\p{{N}}.,:]*) *(?:({units})(?!\p{{L}})|[%€$£])", f"$1 {_UNIT}$2 ")


def tokens(text: Column) -> Column:
    """Tokens in order; a slot's is its mark and its value."""
    marked = template_text(F.coalesce(text, F.lit("")))
    # Without a letter of a script without blanks: all between slots and words becomes a blank, which is cheaper.
    parted = F.array_remove(F.split(F.regexp_replace(marked, rf"({_SLOT})|[^\p{{L}}\p{{M}} ]+", "$1 "), " "), "")
    return F.when(F.coalesce(text, F.lit("")).rlike(_MAY_LACK_BLANKS), _extracted(marked)).otherwise(parted)


def _extracted(marked: Column) -> Column:
    word, letter = rf"[\p{{L}}\p{{M}}&&[^{_NO_BLANKS}]]+", rf"[{_NO_BLANKS}&&[\p{{L}}\p{{M}}]]\p{{M}}*"
    return F.regexp_extract_all(marked, F.lit(f"{_SLOT}|{word}|{letter}"), 0)


def _is_slot(t: Column) -> Column:
    return F.substring(t, 1, 1).isin(_NUM, _UNIT, _NAME)


def _plain(t: Column) -> Column:
    """A token without its mark."""
    return F.ltrim(t, F.lit(_NUM + _UNIT + _NAME))


def _items(benchmark: DataFrame) -> DataFrame:
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    return rows.withColumn("t", tokens(F.col("text"))).where(F.size("t") > 0)


def _hashes(rows: DataFrame) -> DataFrame:
    """Columns h and v: the hash of each token without and with its value; the same for a plain word."""
    return rows.withColumn("v", F.transform("t", lambda t: F.xxhash64(_plain(t)))).withColumn("h", F.zip_with("t", "v", lambda t, v: F.when(_is_slot(t), F.xxhash64(F.substring(t, 1, 1))).otherwise(v)))


def _places(rows: DataFrame, *keep: str, widths: list[int]) -> DataFrame:
    """w, at, template, words: both hashes of every window of each of the ``widths`` over columns ``h`` and ``v``."""
    rows = rows.select(*keep, "h", "v", F.explode(F.array(*map(F.lit, widths))).alias("w")).withColumn("n", F.size("v") - F.col("w") + 1)
    # Below LITERAL tokens: only the whole text.
    places = rows.where((F.col("n") == 1) | ((F.col("n") > 1) & (F.col("w") >= LITERAL))).select(*keep, "h", "v", "w", "n", F.posexplode("v").alias("at", "_token")).where("at < n")

    def hashed(of: str) -> Column:
        some = [F.when(F.col("w") == w, F.xxhash64(*(F.get(of, F.col("at") + k) for k in range(w)))) for w in widths]
        return F.coalesce(*some)

    return places.select(*keep, "w", "at", hashed("h").alias("template"), hashed("v").alias("words"))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, version, at, w, verbatim, window, counted and the item's number of counted windows; templates only with enough plain words."""
    items = _hashes(_items(benchmark)).withColumn("literal", F.transform("t", lambda t: (~_is_slot(t)).cast("int"))).withColumn("size", F.least(F.size("t"), F.lit(WINDOW)))
    found = _places(items, "item_id", "text", "literal", "size", widths=list(range(1, WINDOW + 1))).where("w = size")
    both = F.array(F.struct(F.lit(False).alias("verbatim"), F.col("template").alias("window")), F.struct(F.lit(True).alias("verbatim"), F.col("words").alias("window")))
    found = found.select("item_id", "text", "literal", "w", "at", F.inline(both))
    plain = F.aggregate(F.slice("literal", F.col("at") + 1, F.col("w")), F.lit(0), lambda a, b: a + b)
    found = found.withColumn("enough", plain >= LITERAL).where("verbatim OR enough")
    found = found.select("item_id", F.xxhash64("text").alias("version"), "at", "w", "verbatim", "window", "enough")
    sizes = found.where("verbatim").groupBy("item_id", "version").agg(F.count_if("enough").alias("templates"), F.count(F.lit(1)).alias("all"))
    # Counted are the windows with enough plain words, or all if there is none.
    found = found.join(sizes, ["item_id", "version"]).withColumn("counted", F.col("enough") | (F.col("templates") == 0))
    return found.select("item_id", "version", "at", "w", "verbatim", "window", "counted", F.when(F.col("templates") > 0, F.col("templates")).otherwise(F.col("all")).alias("item_windows"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, matched_windows, item_windows, coverage, changed_slots, contaminated: a row for each document and item that share a consistent window."""
    spark = docs.sparkSession
    items = stored(item_windows(benchmark), "item-windows")
    widths = sorted(r.w for r in items.select("w").distinct().collect())  # WINDOW and below: a few numbers
    few = items.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    wanted = items.select("w", "window").distinct()
    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    tokened = rows.select("doc_id", F.xxhash64("text").alias("copy"), tokens(F.col("text")).alias("t"))
    schema = "doc_id long, copy long, w int, at int, window long"
    hits = spark.createDataFrame([], schema)
    if widths:
        # A window without a slot has one hash, and is looked up once.
        windows = F.when(F.col("template") == F.col("words"), F.array("words")).otherwise(F.array("words", "template"))
        found = _places(_hashes(tokened), "doc_id", "copy", widths=widths).select("doc_id", "copy", "w", "at", F.explode(windows).alias("window"))
        hits = found.join(F.broadcast(wanted) if few else wanted, ["w", "window"], "left_semi").select("doc_id", "copy", "w", "at", "window")
    hits = stored(hits, "window-hits")

    # One row for each window of an item that a document has at one offset; a verbatim one has its words, whatever set of the document hit.
    matched = hits.withColumnRenamed("at", "doc_at").join(items, ["w", "window"]).withColumn("offset", F.col("doc_at") - F.col("at"))
    matched = matched.select("doc_id", "copy", "item_id", "version", "offset", "at", "w", "verbatim", "counted", "item_windows").distinct()
    alignments = matched.groupBy("doc_id", "copy", "item_id", "version", "offset").agg(F.collect_set(F.struct("at", "w", "verbatim", "counted")).alias("windows"), F.first("item_windows").alias("item_windows"))
    alignments = stored(alignments, "alignments")
    hit = alignments.select("doc_id").distinct()
    hit = F.broadcast(hit) if hit.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS else hit
    hit_docs = stored(rows.join(hit, "doc_id", "left_semi").select("doc_id", F.xxhash64("text").alias("copy"), tokens(F.col("text")).alias("doc_values")).dropDuplicates(["doc_id", "copy"]), "hit-documents")
    item_texts = _items(benchmark).select("item_id", F.xxhash64("text").alias("version"), tokens(F.col("text")).alias("item_values"))
    both = alignments.join(item_texts, ["item_id", "version"]).join(hit_docs, ["doc_id", "copy"])

    # Positions of the item inside the alignment's template windows that are slots, with both values.
    end = lambda x: x["at"] + x["w"] - 1
    templates = F.filter("windows", lambda x: ~x["verbatim"])
    covered = F.array_distinct(F.flatten(F.transform(templates, lambda x: F.sequence(x["at"], end(x)))))
    slot_at = F.filter(covered, lambda p: _is_slot(F.get(F.col("item_values"), p)))
    slots = F.transform(slot_at, lambda p: F.struct(p.alias("p"), F.get("item_values", p).alias("i"), F.get("doc_values", p + F.col("offset").cast("int")).alias("d")))
    # Each step is stored: the next one's functions run for every slot and window and must not hold this one's in them.
    slotted = stored(both.select("doc_id", "copy", "item_id", "version", "windows", "item_windows", slots.alias("slots")), "alignment-slots")
    # Values of the item that stand for several of the document; lost: and never for themselves.
    valued = stored(slotted.withColumn("pairs", F.array_distinct(F.transform("slots", lambda s: F.struct(s["i"].alias("i"), s["d"].alias("d"))))), "alignment-pairs")
    values = F.transform("pairs", lambda q: q["i"])
    several = F.array_distinct(F.filter(values, lambda v: F.size(F.filter("pairs", lambda q: q["i"] == v)) > 1))
    one_each = F.size(F.array_distinct(values)) == F.size("pairs")
    unclear = stored(valued.withColumn("unclear", F.when(one_each, F.array().cast("array<string>")).otherwise(several)), "alignment-values")
    unclear = unclear.withColumn("lost", F.filter("unclear", lambda v: ~F.exists("pairs", lambda q: (q["i"] == v) & (q["d"] == v))))
    unclear = stored(unclear.withColumn("unclear_slots", F.filter("slots", lambda s: F.array_contains("unclear", s["i"]))), "alignment-unclear")
    held = lambda x: F.filter("unclear_slots", lambda s: s["p"].between(x["at"], end(x)))
    count = lambda slots, of: F.size(F.array_distinct(F.transform(slots, of)))
    clear = lambda x: (count(held(x), lambda s: s["i"]) == count(held(x), lambda s: F.struct(s["i"], s["d"]))) & ~F.exists(held(x), lambda s: F.array_contains("lost", s["i"]))
    left = F.filter("windows", lambda x: x["verbatim"] | clear(x))
    changed = F.size(F.filter("pairs", lambda q: ~F.array_contains("lost", q["i"]) & (q["i"] != q["d"])))
    kept = stored(unclear.select("doc_id", "item_id", "version", "item_windows", changed.alias("changed"), left.alias("left")), "alignments-left")
    # The longest row of tokens that the windows left in one alignment cover.
    at = F.array_sort(F.array_distinct(F.flatten(F.transform("left", lambda x: F.sequence(x["at"], end(x))))))
    state = lambda last, now, most: F.struct(last.alias("last"), now.alias("now"), most.alias("most"))

    def longer(run: Column, p: Column) -> Column:
        now = F.when(p == run["last"] + 1, run["now"] + 1).otherwise(F.lit(1))
        return state(p, now, F.greatest(run["most"], now))

    kept = stored(kept.withColumn("covered", at), "alignments-covered")
    run = F.aggregate("covered", state(F.lit(-2), F.lit(0), F.lit(0)), longer, lambda r: r["most"])
    consistent = kept.withColumn("run", run).select("*", F.explode("left").alias("x")).select("*", "x.at", "x.counted")
    by_version = consistent.groupBy("doc_id", "item_id", "version").agg(F.countDistinct(F.when(F.col("counted"), F.col("at"))).alias("matched"), F.first("item_windows").alias("item_windows"), F.max("changed").alias("changed"), F.max("run").alias("run"))
    best = by_version.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("matched", "item_windows", "changed"), F.struct(F.col("matched") / F.col("item_windows"), "matched", "version")).alias("b"), F.max("run").alias("run"))
    coverage = F.col("b.matched") / F.col("b.item_windows")
    found = (coverage >= COVERAGE) | (F.col("run") >= RUN_WORDS)
    return best.select("doc_id", "item_id", F.col("b.matched").alias("matched_windows"), F.col("b.item_windows").alias("item_windows"), coverage.alias("coverage"), F.col("b.changed").cast("int").alias("changed_slots"), found.alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns."""
    bad = contaminated(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs["doc_id"].cast("long") == bad["_bad"], "left_anti")
