"""Writes: appended loads, replaced partitions, upserted tables.

Files are Parquet; there is no table format in this install, so the guarantees
come from two facts: Spark doesn't read folders whose names begin with ``_``,
and a name can be given to a finished folder or file in one step.

* ``append_load``: a load's rows are written to a hidden folder, which becomes
  ``load_id=<id>`` when complete.  That folder is the record that the load is
  done (:func:`has_load`), so a load is seen whole or not at all, and a load
  that is run again takes the place of its first run as a whole.  Rows with a
  null partition value are kept like any others.
* ``replace_partitions``: the rows of a run go to a folder of their own, and a
  *version*, a small file that says which folder holds each partition, switches
  all replaced and emptied partitions at once.  Versions are numbered and made
  by exclusive creation: of two writers at once one makes the next version and
  the other one builds its own upon that.  Readers take the newest version.
* ``upsert_versioned``: a small keyed table (the refresh log) merged into a new
  folder; if another writer made a version meanwhile, merged again with that.

A version lists one entry a partition (calendar days, or buckets of a fixed
number), which is all that passes through the driver.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Callable, Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from dvspark.functions.cols import few_listing_tasks, setting

#: From this size a task of a write is merged with no other one; Spark's own 1 MB would have one task make the folders of years of small days.
MIN_TASK, MIN_TASK_BYTES = "spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k"

#: How Spark's writers name the partition of a null value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


# ------------------------------------------------------------------ file system
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p, jvm = _fs(spark, source)
    if not fs.rename(p, jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{target} can't be made from {source}")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none if it doesn't exist)."""
    fs, p, _ = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p, jvm = _fs(spark, path)
    size = fs.getFileStatus(p).getLen()
    stream = fs.open(p)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size)).decode()
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Makes a file with ``text``, or returns False if there is one; of several writers at once one makes it."""
    fs, p, jvm = _fs(spark, path)
    whole = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(whole, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":  # its rename would replace; a second link to a file doesn't
            local = lambda x: jvm.java.nio.file.Paths.get(jvm.org.apache.hadoop.fs.Path.getPathWithoutSchemeAndAuthority(x).toString(), spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0))
            jvm.java.nio.file.Files.createLink(local(p), local(whole))
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
            context.rename(whole, p, spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    finally:
        if fs.exists(whole):
            fs.delete(whole, False)


def _escaped(spark: SparkSession, value: str) -> str:
    """A partition value as Spark's writers spell it in a folder's name."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


# --------------------------------------------------------------- appended loads
def load_folder(spark: SparkSession, path: str, load_id: str) -> str:
    return f"{path.rstrip('/')}/load_id={_escaped(spark, load_id)}"


def has_load(spark: SparkSession, path: str, load_id: str) -> bool:
    """Whether the table holds that load, with or without rows."""
    return exists(spark, load_folder(spark, path, load_id))


def append_load(df: DataFrame, path: str, load_id: str, partition_cols: Sequence[str] = ()) -> None:
    """Write a load's rows as ``load_id=<id>``, in place of all that the load wrote before."""
    spark = df.sparkSession
    parts = list(partition_cols)
    written = f"{path.rstrip('/')}/_writing-{uuid.uuid4().hex}"
    rows = df.hint("rebalance", F.col(parts[0])) if parts else df
    rows.write.partitionBy(*parts).parquet(written)
    target = load_folder(spark, path, load_id)
    before = f"{path.rstrip('/')}/_replaced-{uuid.uuid4().hex}" if exists(spark, target) else None
    if before:
        rename(spark, target, before)
    rename(spark, written, target)
    if before:
        remove(spark, before)


def read_loads(
    spark: SparkSession, path: str, schema: StructType, exclude_load: str | None = None, only_load: str | None = None, keep_id: bool = False, only: tuple[str, Sequence[str]] | None = None
) -> DataFrame | None:
    """A table of :func:`append_load`: all loads, all but one, or one; ``None`` if never written.

    ``only``: name and wanted values of a further (text) partition column that ``schema`` doesn't have.
    """
    if not exists(spark, path):
        return None
    extra = [StructField("load_id", StringType(), True)] + ([StructField(only[0], StringType(), True)] if only else [])
    with few_listing_tasks(spark):
        df = spark.read.schema(StructType([*schema.fields, *extra])).parquet(path)
    if only:
        df = df.where(F.col(only[0]).isin(list(only[1]))).drop(only[0])
    if exclude_load is not None:
        df = df.where(F.col("load_id") != exclude_load)
    if only_load is not None:
        df = df.where(F.col("load_id") == only_load)
    return df if keep_id else df.select(*[f.name for f in schema.fields])


# ------------------------------------------------------------ replaced partitions
def _version_path(root: str, n: int) -> str:
    return f"{root.rstrip('/')}/_versions/{n:012d}"


def newest_version(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """Number and content (partition value -> folder) of a table's newest version; 0 and nothing before the first."""
    n = max((int(x) for x in names(spark, f"{root.rstrip('/')}/_versions") if x.isdigit()), default=0)
    return (n, json.loads(read_text(spark, _version_path(root, n)))) if n else (0, {})


class Conflict(RuntimeError):
    """Another writer replaced a partition that this one had read."""


def _commit(spark: SparkSession, root: str, change: Callable[[dict[str, str]], dict[str, str]]) -> int:
    while True:
        n, current = newest_version(spark, root)
        if create_new(spark, _version_path(root, n + 1), json.dumps(change(current))):
            return n + 1


def _partition_value(v) -> str:
    return NULL_PARTITION if v is None else v.isoformat() if isinstance(v, (_dt.date, _dt.datetime)) else str(v)


def replace_partitions(df: DataFrame, path: str, column: str, values: Iterable | None = None, spark: SparkSession | None = None, since: dict[str, str] | None = None) -> list:
    """M4: replace partitions of a table by those of ``df``, all at once.

    ``values``: the partitions this run is responsible for (default: those in
    ``df``).  Returns those that are without rows now.  Their set is taken from
    an ``Observation`` of the writing job: one action, no further scan.
    ``since``: the version's content that ``df`` was made from; if a partition
    was replaced after that, nothing is and :class:`Conflict` is raised.
    """
    spark = spark or df.sparkSession
    folder = uuid.uuid4().hex
    obs = Observation("partitions")
    value = F.coalesce(F.col(column).cast("string"), F.lit(NULL_PARTITION))
    rows = df.hint("rebalance", F.col(column)).observe(obs, F.collect_set(value).alias("values"))
    with setting(spark, MIN_TASK, MIN_TASK_BYTES):  # a folder takes time, not bytes
        rows.write.partitionBy(column).parquet(f"{path.rstrip('/')}/data={folder}")
    written = set(obs.get.get("values") or [])
    emptied = [v for v in (values or []) if _partition_value(v) not in written]
    gone = {_partition_value(v) for v in emptied}

    def change(now: dict[str, str]) -> dict[str, str]:
        moved = sorted(v for v in written | gone if since is not None and now.get(v) != since.get(v))
        if moved:
            remove(spark, f"{path.rstrip('/')}/data={folder}")
            raise Conflict(f"{path}: {', '.join(moved)}")
        return {k: f for k, f in now.items() if k not in gone} | dict.fromkeys(written, folder)

    _commit(spark, path, change)
    return emptied


def publish_by_date(df: DataFrame, path: str, date_col: str, dates: Iterable | None = None, spark: SparkSession | None = None) -> list:
    """M4: replace the given dates of a mart; see :func:`replace_partitions`."""
    return replace_partitions(df, path, date_col, dates, spark)


def _of_version(spark: SparkSession, path: str, schema: StructType, column: str, held: dict[str, str]) -> DataFrame:
    if not held:
        return spark.createDataFrame([], schema)
    root = path.rstrip("/")
    with few_listing_tasks(spark):
        df = spark.read.schema(StructType([*schema.fields, StructField("data", StringType(), True)])).option("basePath", root).parquet(*sorted({f"{root}/data={f}" for f in held.values()}))
    # Of partition columns only, so it is decided before any file is opened.
    at: Column = F.concat_ws("/", "data", F.coalesce(F.col(column).cast("string"), F.lit(NULL_PARTITION)))
    return df.where(at.isin([f"{f}/{v}" for v, f in held.items()])).select(*[f.name for f in schema.fields])


def read_published(spark: SparkSession, path: str, schema: StructType, column: str | None = None) -> DataFrame:
    """A table of :func:`replace_partitions` in its newest version.  ``column``: the partition column, by default the only date."""
    if column is None:
        (column,) = [f.name for f in schema.fields if f.dataType.typeName() == "date"]
    return _of_version(spark, path, schema, column, newest_version(spark, path)[1])


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Removes all but the ``keep`` newest versions, and the folders that only those had.

    Folders that no version names yet belong to running writers and stay.
    """
    root = path.rstrip("/")
    numbers = sorted(int(x) for x in names(spark, f"{root}/_versions") if x.isdigit())
    held = lambda ns: {f for n in ns for f in json.loads(read_text(spark, _version_path(root, n))).values()}
    old = numbers[: max(0, len(numbers) - keep)]
    unused = held(old) - held(numbers[len(old) :])
    for n in old:
        remove(spark, _version_path(root, n))
    for f in unused:
        remove(spark, f"{root}/data={f}")


# ------------------------------------------------------------------ upserted table
def read_versioned(spark: SparkSession, root: str, schema: StructType) -> DataFrame | None:
    held = newest_version(spark, root)[1]
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/data={held['']}") if held else None


def upsert_versioned(spark: SparkSession, root: str, new_rows: DataFrame, key: Sequence[str], order_col: str, schema: StructType, keep: int = 8) -> int:
    """M5: merge ``new_rows`` into the newest version by ``key``; the greater ``order_col`` wins (new rows win ties).

    Returns the number of the version made.  If another writer makes it first,
    the rows are merged with that one's, so neither's are lost.  The newest
    ``keep`` versions stay for those who read them.
    """
    cols = [f.name for f in schema.fields]
    incoming = new_rows.select(*cols).withColumn("_new", F.lit(1))
    w = Window.partitionBy(*key).orderBy(F.col(order_col).desc(), F.col("_new").desc())
    while True:
        n, held = newest_version(spark, root)
        current = spark.read.schema(schema).parquet(f"{root.rstrip('/')}/data={held['']}") if held else None
        merged = incoming if current is None else current.withColumn("_new", F.lit(0)).unionByName(incoming)
        folder = uuid.uuid4().hex
        merged.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(*cols).write.parquet(f"{root.rstrip('/')}/data={folder}")
        if create_new(spark, _version_path(root, n + 1), json.dumps({"": folder})):
            expire_versions(spark, root, keep)
            return n + 1
        remove(spark, f"{root.rstrip('/')}/data={folder}")
