"""Quotation linking: replies without their quotes, ordered behind what they answer.

A line's quote level is the number of ``>`` marks it begins with.  Lines of one
level in a row are a passage; an attribution line ("On ... wrote:") right above
a quote belongs to it.  Passages, and their single lines, are normalised (marks
off, lower case, white space to one blank) and hashed; so are the own words of
every message: the whole, its paragraphs and its lines.  A hash join links a
passage to its original: an earlier message of the same conversation, else the
first message of the table, by (conv_id, turn), that holds the passage, if it
lies before the reply's conversation.  A message answers the original of its
lowest quote level (of several, that with most characters, then the first);
without a linked quote, the message before it in its conversation.

The originals of one hash are reduced to the first of each conversation and of
the table before the join, so a line that half of all messages hold still
gives one row a passage.  Reply chains are resolved by pointer doubling, one
join a round; neither conversations nor threads are gathered.  Sorting a
thread's rows by (depth, conv_id, turn) puts every answer behind its question.

Only DataFrame functions run here.

Defined cases: null and empty texts are messages without words; rows alike in
conv_id, turn, role and text are one message (``copies`` of them); different
messages of one turn stay apart, all answering the turn before; a message with
null conv_id or turn stands alone; quotes of unknown passages are taken off and
link nothing; passages of under ``LEAST`` characters link nothing; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dvspark.llm.common import stored

LEAST = 12
_MARKS = r"^(?:[ \t]*>)+"
_ATTRIBUTION = r"^[ \t]*On .{1,200} wrote:[ \t]*$"


def normalised(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def messages(conversations: DataFrame) -> DataFrame:
    """msg, conv_id, turn, role, text, copies of every distinct message."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    named = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    # xxhash64 skips nulls, so what is null is part of the name.
    return named.withColumn("msg", F.xxhash64("conv_id", "turn", "role", "text", F.concat(*(F.col(c).isNull().cast("string") for c in ("conv_id", "turn", "role", "text")))))


def split_quotes(msgs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(msg, body) of every message, and (msg, level, part, unit) of the quoted passages and their lines."""
    is_quoting = F.coalesce(F.col("text"), F.lit("")).rlike(r"(?m)^[ \t]*>")
    plain = msgs.where(~is_quoting).select("msg", F.coalesce("text", F.lit("")).alias("body"))
    lines = msgs.where(is_quoting).select("msg", F.posexplode(F.split("text", "\r?\n")).alias("at", "line"))
    marks = F.regexp_extract("line", _MARKS, 0)
    lines = lines.withColumn("level", F.length(F.regexp_replace(marks, "[^>]", ""))).withColumn("words", F.regexp_replace("line", _MARKS, ""))
    in_text = Window.partitionBy("msg").orderBy("at")  # the lines of one text
    above_quote = (F.col("level") == 0) & (F.lead("level").over(in_text) > 0) & F.col("line").rlike(_ATTRIBUTION)
    lines = lines.withColumn("begins", (F.coalesce(F.lag("level").over(in_text), F.lit(-1)) != F.col("level")).cast("int")).withColumn("attribution", F.coalesce(above_quote, F.lit(False)))
    lines = lines.withColumn("passage", F.sum("begins").over(in_text))
    ordered = lambda c: F.transform(F.sort_array(F.collect_list(F.struct("at", c))), lambda x: x[c])
    own = lines.where("level = 0 AND NOT attribution").groupBy("msg").agg(F.btrim(F.array_join(ordered("line"), "\n"), F.lit(" \t\r\n")).alias("body"))
    bodies = plain.union(msgs.where(is_quoting).select("msg").join(own, "msg", "left").select("msg", F.coalesce("body", F.lit("")).alias("body")))
    passages = lines.where("level > 0").groupBy("msg", "passage", "level").agg(ordered("words").alias("rows"))
    units = passages.select("msg", "passage", "level", F.explode(F.array_append(F.col("rows"), F.array_join("rows", " "))).alias("unit"))
    return bodies, units.select("msg", "passage", "level", normalised(F.col("unit")).alias("unit"))


def links(msgs: DataFrame, bodies: DataFrame, units: DataFrame) -> DataFrame:
    """msg and the original it answers by its quotes, for messages with a linked one."""
    placed = bodies.join(msgs.select("msg", "conv_id", "turn"), "msg").where("conv_id IS NOT NULL AND turn IS NOT NULL AND body <> ''")
    parts = F.concat(F.array("body"), F.split("body", r"\n\s*\n"), F.split("body", "\n"))
    held = placed.select("msg", "conv_id", "turn", F.explode(F.array_distinct(F.transform(parts, lambda p: normalised(p)))).alias("unit")).where(F.length("unit") >= LEAST)
    held = held.select("msg", "conv_id", "turn", F.xxhash64("unit").alias("hash"))
    in_conv = held.groupBy("hash", "conv_id").agg(F.min(F.struct("turn", "msg")).alias("first"))
    first = in_conv.groupBy("hash").agg(F.min(F.struct("conv_id", "first.turn", "first.msg")).alias("overall"))
    asked = units.where(F.length("unit") >= LEAST).select("msg", "level", F.length("unit").alias("size"), F.xxhash64("unit").alias("hash")).distinct()
    asked = asked.join(msgs.select("msg", "conv_id", "turn").where("conv_id IS NOT NULL AND turn IS NOT NULL"), "msg")
    found = asked.join(in_conv, ["hash", "conv_id"], "left").join(first, "hash", "left")
    same = F.when(F.col("first.turn") < F.col("turn"), F.struct(F.col("conv_id"), F.col("first.turn").alias("turn"), F.col("first.msg").alias("msg")))
    other = F.when(F.col("overall.conv_id") < F.col("conv_id"), F.col("overall"))
    found = found.withColumn("original", F.coalesce(same, other)).where("original IS NOT NULL")
    return found.groupBy("msg").agg(F.min_by("original", F.struct("level", -F.col("size"), F.col("original"))).alias("o"), F.count(F.lit(1)).alias("linked")).select("msg", F.col("o.msg").alias("quoted"), "linked")


def _before(msgs: DataFrame) -> DataFrame:
    """msg and the message of the turn before it in its conversation (of several, the one with the largest name)."""
    placed = msgs.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    turns = stored(placed.groupBy("conv_id", "turn").agg(F.max("msg").alias("last")), "turns")
    # Turns mostly count up by one, so a join on the number finds the turn before and no conversation is gathered;
    # only the ends of gaps are put in order.
    follow = turns.join(turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("last").alias("earlier")), ["conv_id", "turn"], "left")
    lead = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.lit(True).alias("followed"))
    ends = turns.join(lead, ["conv_id", "turn"], "left").where("followed IS NULL").select("conv_id", "turn", "last")
    opens = follow.where("earlier IS NULL").select("conv_id", "turn")
    gaps = ends.select("conv_id", "turn", "last").union(opens.select("conv_id", "turn", F.lit(None).cast("long")))
    back = Window.partitionBy("conv_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    gaps = gaps.withColumn("earlier", F.last("last", ignorenulls=True).over(back)).where("last IS NULL").select("conv_id", "turn", F.col("earlier").alias("over_gap"))
    follow = follow.join(gaps, ["conv_id", "turn"], "left").select("conv_id", "turn", F.coalesce("earlier", "over_gap").alias("earlier"))
    return placed.select("msg", "conv_id", "turn").join(follow, ["conv_id", "turn"]).select("msg", "earlier")


def threads(parents: DataFrame) -> DataFrame:
    """msg, root, depth from (msg, parent); parents never form a circle.

    Pointer doubling: each round joins the messages whose root isn't known yet,
    and only those, with what is known of the message they point to.
    """
    known = parents.where("parent IS NULL").select("msg", F.col("msg").alias("top"), F.lit(0).cast("long").alias("depth"))
    waiting = parents.where("parent IS NOT NULL").select("msg", F.col("parent").alias("top"), F.lit(1).cast("long").alias("depth"))
    while True:
        every = known.withColumn("final", F.lit(True)).union(waiting.withColumn("final", F.lit(False)))
        above = every.select(F.col("msg").alias("top"), F.col("top").alias("above"), F.col("depth").alias("more"), "final")
        after = stored(waiting.join(above, "top").select("msg", F.col("above").alias("top"), (F.col("depth") + F.col("more")).alias("depth"), "final"), "threads")
        known = known.union(after.where("final").drop("final"))
        waiting = after.where("NOT final").drop("final")
        if not waiting.limit(1).count():
            return known.select("msg", F.col("top").alias("root"), "depth")


def reply_ordered(conversations: DataFrame) -> DataFrame:
    """Every message without its quotes, with what it answers, its thread and its depth there.

    conv_id, turn, role, copies, thread_conv, thread_turn (the thread's first
    message), depth, reply_conv, reply_turn, n_quotes (passages), linked_quotes,
    chat ("role: words").  Sort a thread by (depth, conv_id, turn).
    """
    msgs = stored(messages(conversations), "messages")
    bodies, units = split_quotes(msgs)
    bodies, units = stored(bodies, "bodies"), stored(units, "quoted-units")
    linked = stored(links(msgs, bodies, units), "quote-links")
    parents = msgs.select("msg").join(_before(msgs), "msg", "left").join(linked, "msg", "left").select("msg", F.coalesce("quoted", "earlier").alias("parent"))
    parents = stored(parents, "parents")
    of_msg = lambda name: msgs.select(F.col("msg").alias(name), F.col("conv_id").alias(f"{name}_conv"), F.col("turn").alias(f"{name}_turn"))
    quotes = units.groupBy("msg").agg(F.countDistinct("passage").alias("n_quotes"))
    out = msgs.drop("text").join(bodies, "msg").join(threads(parents), "msg").join(parents.withColumnRenamed("parent", "reply"), "msg")
    out = out.join(of_msg("root"), "root").join(of_msg("reply"), "reply", "left").join(quotes, "msg", "left").join(linked.select("msg", "linked"), "msg", "left")
    return out.select(
        "conv_id", "turn", "role", "copies", F.col("root_conv").alias("thread_conv"), F.col("root_turn").alias("thread_turn"), "depth", "reply_conv", "reply_turn",
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("linked", F.lit(0)).alias("linked_quotes"), F.concat_ws(": ", "role", "body").alias("chat"),
    )
