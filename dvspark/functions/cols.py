"""Small Column helpers shared by the operators."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F


def as_col(value, literal: bool = False) -> Column:
    """Column as-is; a str is a column name unless ``literal``; other values are literals."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str) and not literal:
        return F.col(value)
    if isinstance(value, _dt.datetime) and value.tzinfo is None:
        return F.lit(value).cast("timestamp_ntz")
    return F.lit(value)


def computed_once(value: Column) -> Column:
    """``value`` as a column of its own, one a row.

    A filter on parts of a parsed text would be pushed below the parsing and
    parse the text again for every mention; it isn't pushed below a generator.
    """
    return F.explode(F.array(value))


def utc_now() -> Column:
    """The current instant as a UTC wall clock, whatever the session's zone."""
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")


def hours_after(day_col, hours: int) -> Column:
    """Wall-clock timestamp (NTZ) ``hours`` after midnight of a DATE column."""
    return as_col(day_col).cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(hours))


def _decoded(content: str, charset: str) -> Column:
    """Bytes as text.  One-byte charsets that ``decode`` lacks are read as ISO 8859-1, a character a byte, and then mapped."""
    if charset.lower().startswith(("utf-", "us-ascii", "iso-8859-1")):
        return F.decode(content, charset)
    upper = range(0x80, 0x100)
    mapped = "".join(bytes([b]).decode(charset, errors="ignore") or chr(b) for b in upper)
    return F.translate(F.decode(content, "ISO-8859-1"), "".join(map(chr, upper)), mapped)


#: Listings of many folders or files run as a Spark job; Spark's own default of 10,000 tasks takes longer to schedule than the listing itself.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session with ``value`` for the time of a block."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def few_listing_tasks(spark: SparkSession):
    """Folders are listed (when a scan is made) by as many tasks as there is work for."""
    return setting(spark, LISTING, str(min(int(spark.conf.get(LISTING)), 16 * spark.sparkContext.defaultParallelism)))


class FilesWithBytes(list):
    """Paths of files that a listing has shown to have bytes, so nobody needs to look for empty ones among them."""


def load_files(reader: DataFrameReader, spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The files below ``paths``, whose names pass to the JVM all at once and not in a call each."""
    with few_listing_tasks(spark):  # the listing is made by load
        if isinstance(paths, str):
            return reader.load(paths)
        split = spark.sparkContext._jvm.org.apache.commons.lang3.StringUtils.split
        return DataFrame(reader._jreader.load(split("\0".join(paths), "\0")), spark)


def binary_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The files below ``paths`` as Spark's ``binaryFile`` rows."""
    return load_files(spark.read.format("binaryFile").option("recursiveFileLookup", True), spark, paths)


def whole_files(spark: SparkSession, paths: str | Sequence[str], charset: str = "UTF-8") -> DataFrame:
    """(doc_id, doc_name, text) of the files below ``paths``, each read once, whole.

    Scans skip files of no bytes, so their names come from the listing that
    planning makes anyway; they are documents without text.  A scan opens a few
    dozen small files a task; the texts are then dealt by their size, so what
    follows takes no more tasks than they are worth.
    """
    files = binary_files(spark, paths)
    same_form = lambda c: F.regexp_replace(F.url_decode(c), "^file:/+", "file:/")
    text = F.regexp_replace(_decoded("content", charset), "^\ufeff", "")
    docs = files.select(same_form(F.col("path")).alias("doc_id"), text.alias("text"))
    if not isinstance(paths, FilesWithBytes):
        names = spark.createDataFrame([(n,) for n in files.inputFiles()], "doc_id string").select(same_form(F.col("doc_id")).alias("doc_id"))
        empty = names.join(files.select(same_form(F.col("path")).alias("doc_id")), "doc_id", "left_anti").withColumn("text", F.lit(""))
        docs = docs.unionByName(empty)
    return docs.hint("rebalance").withColumn("doc_name", F.regexp_extract("doc_id", "([^/]*)$", 1))


def event_time(ts_ntz, tz: str) -> Column:
    """NTZ wall clock -> TIMESTAMP instant with the same UTC wall clock.

    Watermarks need TIMESTAMP (not NTZ); reading the wall clock as UTC keeps
    event-time windows aligned to calendar days whatever the session zone.
    """
    return F.from_utc_timestamp(as_col(ts_ntz).cast("timestamp"), tz)


def wall_clock(ts_ltz, tz: str) -> Column:
    """Inverse of :func:`event_time`: instant -> NTZ UTC wall clock."""
    return F.to_utc_timestamp(as_col(ts_ltz), tz).cast("timestamp_ntz")
