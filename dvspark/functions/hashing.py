"""Data Vault hash keys and hash-diffs as Spark Column expressions (H1-H4).

All of them are JVM built-ins (md5/upper/concat_ws) and stay inside
whole-stage codegen.  Keys are hex MD5 in upper case, 32 characters.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

from dvspark.functions.cols import as_col

# Fixed values that results depend on: the separator between key parts and
# the text that stands for NULL inside a hash-diff.
KEY_SEPARATOR = "||"
NULL_TOKEN = "NULL"


def hash_key(column) -> Column:
    """H1: ``upper(md5(cast(col as string)))``; NULL stays NULL, no trimming."""
    return F.upper(F.md5(as_col(column).cast("string")))


def hash_key_composite(*columns) -> Column:
    """H2: MD5 of the parts joined by ``||``; NULL parts are skipped by concat_ws.

    So ('A', NULL, 'B') hashes like ('A', 'B').  Link loads reject NULL parts
    before calling this (see ``operators.vault.load_link``).
    """
    parts = [as_col(c).cast("string") for c in columns]
    return F.upper(F.md5(F.concat_ws(KEY_SEPARATOR, *parts)))


def plain_decimal(column, scale: int) -> Column:
    """Exact plain text of a DECIMAL(p, scale): ``0.00000050``, ``-12.500000``.

    Built from the unscaled integer, so it never switches to scientific
    notation (a non-ANSI ``cast(decimal as string)`` prints ``5.0E-7``) and
    equals the ANSI cast text whatever the session setting.
    """
    c = as_col(column)
    if scale == 0:
        return c.cast("decimal(38,0)").cast("string")
    raw = (F.abs(c) * F.lit(10**scale)).cast("decimal(38,0)").cast("string")
    # lpad would also truncate longer strings: pad only when short
    digits = F.when(F.length(raw) <= scale, F.lpad(raw, scale + 1, "0")).otherwise(raw)
    n = F.length(digits)
    text = F.concat(
        F.when(c < 0, F.lit("-")).otherwise(F.lit("")),
        F.substring(digits, F.lit(1), n - scale),
        F.lit("."),
        F.substring(digits, n - scale + 1, F.lit(scale)),
    )
    return F.when(c.isNotNull(), text)


# Below this magnitude (and for zero: ``0E-8``) a non-ANSI decimal cast prints
# scientific notation; at or above it the plain cast is exact and cheap.
_PLAIN_CAST_FLOOR = Decimal("0.000001")


def hash_text(column, data_type: DataType | None = None) -> Column:
    """Text form of an attribute inside a hash: plain decimals, otherwise the string cast."""
    c = as_col(column)
    if isinstance(data_type, DecimalType) and data_type.scale > 0:
        # fast path for ordinary values, exact rendering only where the cast could go scientific
        return F.when(F.abs(c) >= F.lit(_PLAIN_CAST_FLOOR), c.cast("string")).otherwise(plain_decimal(c, data_type.scale))
    return c.cast("string")


def hash_diff(*columns, types: dict[str, DataType] | None = None) -> Column:
    """H3: change-detection digest; NULL attributes are hashed as the text ``NULL``.

    Column order matters.  Never pass doubles: their string form is
    engine-specific (``1.0E10``).  With ``types`` (name -> type, e.g. from the
    DataFrame schema) decimals are rendered exactly (:func:`plain_decimal`).
    """
    types = types or {}
    parts = [
        F.coalesce(hash_text(c, types.get(c) if isinstance(c, str) else None), F.lit(NULL_TOKEN)) for c in columns
    ]
    return F.upper(F.md5(F.concat_ws(KEY_SEPARATOR, *parts)))


def schema_types(df: DataFrame) -> dict[str, DataType]:
    return {f.name: f.dataType for f in df.schema.fields}
