"""From raw documents to token ids: quality, language, near duplicates, benchmark leaks, encoding.

Each stage takes what the one before it kept, as a table of the shape of
``documents``, and its decisions take effect; the last returns the ids.  Rows
stay whole: a stage keeps a row with all its columns or drops it.

Near duplicates and benchmark items go by row, not by doc_id: a row is named by
a hash of its doc_id and text (``row_id``).

Defined cases, beside those of the operators: rows that repeat a doc_id with
another text are documents of their own; rows that repeat both are one, the
smallest by the other columns; rows with a null doc_id are treated as all
others, but of a group of near copies a row with a doc_id stays first; columns
of any name and type pass through, those named as a stage's own too (maps count
by their JSON where rows are ordered); texts of any length are read whole;
tables without rows give none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dvspark.llm import bpe, langid, line_crf, neardup, templates
from dvspark.llm.common import fold, stored, table

#: Texts whose sets of five-word shingles are that similar or more (per cent of their union) are near copies.
NEAR_PERCENT = 80
#: Texts of which less than this is surely of one language go.
LANGUAGE_SCORE = 0.5


def free(docs: DataFrame, name: str) -> str:
    """``name``, longer by as many underscores as it takes for no column of ``docs`` to begin with it."""
    while any(c.lower().startswith(name.lower()) for c in docs.columns):
        name += "_"
    return name


def same_columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the line model scores as bad (2)."""
    score = free(docs, "_quality")
    model = line_crf.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    return line_crf.score(docs, model, score, keep_text=True).where(F.col(score) >= line_crf.CUT).select(*same_columns(docs))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents without letters, or mixed beyond one language (4)."""
    lang = free(docs, "_lang_")
    model = langid.train(docs, fold("doc_id", 5) != 0)
    found = langid.predict(docs, model, lang, keep_text=True)
    return found.where((F.col(f"{lang}pred") != langid.UND) & (F.col(f"{lang}score") >= LANGUAGE_SCORE)).select(*same_columns(docs))


def row_id() -> Column:
    """Hash of doc_id and text, with nulls marked."""
    return F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")


def second_row_id() -> Column:
    """Another hash of the same: rows are one only if both are equal, so no text goes for another's hash."""
    return F.xxhash64("text", F.col("text").isNull(), "doc_id", F.col("doc_id").isNull())


def _ordered(docs: DataFrame) -> Column:
    """A row's columns as a value that Spark can order."""
    plain = lambda f: F.to_json(f"`{f.name}`") if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`")
    return F.struct(*(plain(f).alias(f"c{k}") for k, f in enumerate(docs.schema.fields)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest doc_id of each group of near copies: similarity 0.8 or more (7)."""
    row = free(docs, "_row")
    rows = docs.withColumn(row, row_id())
    found = neardup.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), percent=NEAR_PERCENT)
    found = found.select(F.col("doc_id").alias(row), "component_id").distinct()
    placed = stored(found.join(rows.select(row, "doc_id").distinct(), row), "placed-rows")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row))
    stay = placed.groupBy("component_id").agg(first.alias("_first")).select(f"_first.{row}")
    gone = placed.join(stay, row, "left_anti").select(F.col(row).alias(f"{row}gone"))
    left = rows.join(gone, rows[row] == gone[f"{row}gone"], "left_anti")
    one = left.groupBy(row, second_row_id().alias(f"{row}second")).agg(F.min_by(F.struct(*same_columns(docs)), _ordered(docs)).alias("_first"))
    return one.select(*(F.col(f"_first.`{c}`") for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item, with other numbers or names too (8)."""
    row = free(docs, "_row")
    rows = docs.withColumn(row, row_id())
    found = templates.contaminated(rows.select(F.col(row).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    bad = found.where("contaminated").select(F.col("doc_id").alias("_bad")).distinct()
    return rows.join(bad, rows[row] == bad["_bad"], "left_anti").select(*same_columns(docs))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The byte-level BPE ids of every document left (5)."""
    import public_tokenizers

    return bpe.bpe_round_trip(docs, bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: SQL can't express the trained stages; tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
