"""Co-located storage: tables bucketed by one key, so that joins and windows on it need no exchange.

A load's tables stay append-only folders; what is read over and over with other
tables of the same key (hubs, satellites, details by the hash key) is kept as a
bucketed copy: files hold the rows of one bucket, sorted by the key.  Tables of
one key and one number of buckets are then joined bucket by bucket.  MD5 keys
spread evenly, and a window by (key, date) finds its rows in one bucket, too.

Bucketing is a property of the session's catalog.  ``open_bucketed`` enters the
files of an earlier session into it again; their names carry the bucket.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from dvspark.operators import publish as P


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """The rows as a bucketed table below ``path`` (a new folder); its description is written last, beside them."""
    spark = df.sparkSession
    rows = df.repartition(buckets, key)  # a file a bucket
    rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", f"{path.rstrip('/')}/rows").saveAsTable(_name())
    P.create_new(spark, f"{path.rstrip('/')}/_bucketed", json.dumps({"key": key, "buckets": buckets, "schema": df.schema.json()}))
    return open_bucketed(spark, path)


def open_bucketed(spark: SparkSession, path: str) -> DataFrame:
    about = json.loads(P.read_text(spark, f"{path.rstrip('/')}/_bucketed"))
    schema = StructType.fromJson(json.loads(about["schema"]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    name, key = _name(), about["key"]
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {about['buckets']} BUCKETS LOCATION '{path.rstrip('/')}/rows'")
    return spark.table(name)


def _name() -> str:
    return f"bucketed_{uuid.uuid4().hex}"
