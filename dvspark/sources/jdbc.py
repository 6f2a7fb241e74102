"""Relational-database connector settings (S3): parallel JDBC reads and batched writes.

The reference reads whole tables through one JDBC connection (no
partition column).  Here a read names a numeric/date column and bounds so
Spark opens ``num_partitions`` range queries in parallel; writes are batched
and run at READ_COMMITTED.  The core pipeline does not depend on it (it
reads and writes Parquet); it is here for deployments that keep the raw layer
in a database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed defaults taken from the reference configuration.
DEFAULT_DRIVER = "org.postgresql.Driver"
DEFAULT_BATCH_SIZE = 1000
DEFAULT_ISOLATION = "READ_COMMITTED"


def jdbc_options(url: str, user: str, password: str, driver: str = DEFAULT_DRIVER, batch_size: int = DEFAULT_BATCH_SIZE,
                 isolation: str = DEFAULT_ISOLATION, fetch_size: int = 10000) -> dict[str, str]:
    return {
        "url": url,
        "user": user,
        "password": password,
        "driver": driver,
        "batchsize": str(batch_size),
        "isolationLevel": isolation,
        "fetchsize": str(fetch_size),
    }


def read_table(spark: SparkSession, options: dict[str, str], table: str, partition_column: str | None = None,
               lower_bound=None, upper_bound=None, num_partitions: int = 8, predicate: str | None = None) -> DataFrame:
    """Read ``table`` (optionally ``WHERE predicate``) with range-partitioned parallel queries."""
    source = f"(SELECT * FROM {table} WHERE {predicate}) AS t" if predicate else table
    reader = spark.read.format("jdbc").options(**options).option("dbtable", source)
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    return reader.load()


def append_table(df: DataFrame, options: dict[str, str], table: str, num_partitions: int | None = None) -> None:
    """Append ``df``; ``num_partitions`` caps concurrent connections (coalesce, no shuffle)."""
    out = df.coalesce(num_partitions) if num_partitions else df
    out.write.format("jdbc").options(**options).option("dbtable", table).mode("append").save()
