import hashlib

from pyspark.sql import functions as F

from dvspark.functions.hashing import hash_diff, hash_key, hash_key_composite


def md5u(s: str) -> str:
    return hashlib.md5(s.encode("utf-8")).hexdigest().upper()


def test_hash_key_is_upper_md5_and_keeps_null(spark):
    df = spark.createDataFrame([("AAPL",), (" aapl",), (None,)], "s string")
    got = [r.hk for r in df.select(hash_key("s").alias("hk")).collect()]
    assert got == [md5u("AAPL"), md5u(" aapl"), None]  # no trim, no upper of the key
    assert len(got[0]) == 32


def test_composite_key_skips_null_parts(spark):
    df = spark.createDataFrame([("A", None, "B"), ("A", "B", None)], "a string, b string, c string")
    got = [r.k for r in df.select(hash_key_composite("a", "b", "c").alias("k")).collect()]
    assert got == [md5u("A||B"), md5u("A||B")]


def test_hash_diff_null_token_and_order(spark):
    df = spark.createDataFrame([("1.500000", None), (None, "1.500000")], "x string, y string")
    got = [r.h for r in df.select(hash_diff("x", "y").alias("h")).collect()]
    assert got == [md5u("1.500000||NULL"), md5u("NULL||1.500000")]


def test_hash_diff_of_decimals_is_plain_text(spark):
    df = spark.createDataFrame([(1,)], "i int").select(
        F.lit("0.00000050").cast("decimal(18,8)").alias("rate"), F.lit(10000000000).cast("bigint").alias("v")
    )
    assert df.select(hash_diff("rate", "v").alias("h")).first().h == md5u("0.00000050||10000000000")


def test_plain_decimal_text_is_session_independent(spark):
    from dvspark.functions.hashing import plain_decimal

    vals = ["0.00000050", "-123.45000000", "90.50000000", "0E-8", "-0.00000001", "9999999999.99999999"]
    df = spark.createDataFrame([(v,) for v in vals], "s string").select(F.col("s").cast("decimal(18,8)").alias("d"))
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            got = [r.t for r in df.select(plain_decimal("d", 8).alias("t")).collect()]
            assert got == ["0.00000050", "-123.45000000", "90.50000000", "0.00000000", "-0.00000001", "9999999999.99999999"]
        spark.conf.set("spark.sql.ansi.enabled", "true")
        assert [r.t for r in df.select(F.col("d").cast("string").alias("t")).collect()] == got  # = the ANSI cast
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_hash_text_matches_ansi_cast_in_both_modes(spark):
    from pyspark.sql.types import DecimalType

    from dvspark.functions.hashing import hash_text

    vals = ["0.00000050", "0", "-0.00000001", "0.00000100", "12.5", "-99999.12345678"]
    df = spark.createDataFrame([(v,) for v in vals], "s string").select(F.col("s").cast("decimal(18,8)").alias("d"))
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "true")
        want = [r.t for r in df.select(F.col("d").cast("string").alias("t")).collect()]
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            assert [r.t for r in df.select(hash_text("d", DecimalType(18, 8)).alias("t")).collect()] == want
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_both_renderings_of_a_decimal_are_one_text(spark):
    """Around the magnitude where the plain cast takes over from the exact rendering."""
    from dvspark.functions.hashing import hash_text, plain_decimal

    units = [0, 1, 9, 99, 100, 101, 999, 12345, 10**8 + 1, 10**17 + 7]
    df = spark.createDataFrame([(s * u,) for u in units for s in (1, -1)], "u bigint").select((F.col("u") / F.lit(10**8)).cast("decimal(18,8)").alias("d"))
    kind = df.schema["d"].dataType
    rows = df.select(hash_text("d", kind).alias("a"), plain_decimal(F.col("d"), 8).alias("b")).collect()
    assert all(r.a == r.b for r in rows)
