"""Declared table contracts (no schema inference anywhere) and the M7 check.

Stored prices are NUMERIC(18,6), rates NUMERIC(18,8); timestamps are kept as
TIMESTAMP_NTZ wall clock in UTC; business dates are DATE.  The surrogate
BIGSERIAL ids of the raw tables are read by nothing and are not kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    DateType,
    DecimalType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

PRICE = DecimalType(18, 6)
RATE = DecimalType(18, 8)
RETURN_PCT = DecimalType(18, 4)  # NUMERIC(10,4) overflows on real data; widened
TS = TimestampNTZType()


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


# ---- raw layer -------------------------------------------------------------
RAW_QUOTES = _s(
    ("symbol", StringType(), False),
    ("open_price", PRICE, False),
    ("high_price", PRICE, False),
    ("low_price", PRICE, False),
    ("close_price", PRICE, False),
    ("volume", LongType(), False),
    ("trade_date", DateType(), False),
    ("source", StringType(), False),
    ("loaded_at", TS, False),
)
RAW_QUOTES_KEY = ["symbol", "trade_date", "source"]

RAW_RATES = _s(
    ("base_currency", StringType(), False),
    ("target_currency", StringType(), False),
    ("rate", RATE, False),
    ("rate_date", DateType(), False),
    ("source", StringType(), False),
    ("loaded_at", TS, False),
)
RAW_RATES_KEY = ["base_currency", "target_currency", "rate_date", "source"]

RAW_INSTRUMENTS = _s(
    ("symbol", StringType(), False),
    ("instrument_name", StringType(), False),
    ("exchange", StringType(), True),
    ("asset_type", StringType(), True),
    ("source", StringType(), False),
    ("loaded_at", TS, False),
)
RAW_INSTRUMENTS_KEY = ["symbol", "source"]

# ---- vault -----------------------------------------------------------------
HUB_INSTRUMENT = _s(
    ("hub_instrument_hk", StringType(), False),
    ("instrument_bk", StringType(), False),
    ("load_date", TS, False),
    ("record_source", StringType(), False),
)
HUB_CURRENCY = _s(
    ("hub_currency_hk", StringType(), False),
    ("currency_code", StringType(), False),
    ("load_date", TS, False),
    ("record_source", StringType(), False),
)
HUB_MARKET = _s(
    ("hub_market_hk", StringType(), False),
    ("market_code", StringType(), False),
    ("load_date", TS, False),
    ("record_source", StringType(), False),
)
LNK_QUOTE_INSTRUMENT = _s(
    ("lnk_quote_instrument_hk", StringType(), False),
    ("hub_instrument_hk", StringType(), False),
    ("hub_market_hk", StringType(), False),
    ("load_date", TS, False),
    ("record_source", StringType(), False),
)
LNK_RATE_CURRENCY = _s(
    ("lnk_rate_currency_hk", StringType(), False),
    ("hub_currency_hk_base", StringType(), False),
    ("hub_currency_hk_target", StringType(), False),
    ("load_date", TS, False),
    ("record_source", StringType(), False),
)
SAT_QUOTE_PRICES = _s(
    ("hub_instrument_hk", StringType(), False),
    ("load_date", TS, False),
    ("record_source", StringType(), False),
    ("hash_diff", StringType(), False),
    ("open_price", PRICE, False),
    ("high_price", PRICE, False),
    ("low_price", PRICE, False),
    ("close_price", PRICE, False),
    ("volume", LongType(), False),
    ("trade_date", DateType(), False),
)
SAT_RATE_VALUES = _s(
    ("lnk_rate_currency_hk", StringType(), False),
    ("load_date", TS, False),
    ("record_source", StringType(), False),
    ("hash_diff", StringType(), False),
    ("rate", RATE, False),
    ("rate_date", DateType(), False),
)
SAT_INSTRUMENT_DETAILS = _s(
    ("hub_instrument_hk", StringType(), False),
    ("load_date", TS, False),
    ("load_end_date", TS, True),
    ("record_source", StringType(), False),
    ("hash_diff", StringType(), False),
    ("instrument_name", StringType(), False),
    ("exchange", StringType(), True),
    ("asset_type", StringType(), True),
)

# Attribute lists hashed into hash_diff, in this order (fixed values).
QUOTE_HASH_COLUMNS = ["open_price", "high_price", "low_price", "close_price", "volume"]
RATE_HASH_COLUMNS = ["rate"]
DETAILS_HASH_COLUMNS = ["instrument_name", "exchange", "asset_type"]

# ---- marts -----------------------------------------------------------------
DM_QUOTES_DAILY = _s(
    ("instrument_bk", StringType(), False),
    ("instrument_name", StringType(), True),
    ("exchange", StringType(), True),
    ("asset_type", StringType(), True),
    ("trade_date", DateType(), False),
    ("open_price", PRICE, True),
    ("high_price", PRICE, True),
    ("low_price", PRICE, True),
    ("close_price", PRICE, True),
    ("volume", LongType(), True),
    ("daily_return_pct", RETURN_PCT, True),
    ("price_range", PRICE, True),
    ("loaded_at", TS, False),
)
DM_FX_RATES = _s(
    ("base_currency", StringType(), False),
    ("target_currency", StringType(), False),
    ("rate", RATE, False),
    ("rate_date", DateType(), False),
    ("source", StringType(), True),
    ("loaded_at", TS, False),
)
DM_FX_CROSS_RATES = _s(
    ("rate_date", DateType(), False),
    ("base_currency", StringType(), False),
    ("from_currency", StringType(), False),
    ("to_currency", StringType(), False),
    ("cross_rate", RATE, True),
)
MART_REFRESH_LOG = _s(
    ("mart_name", StringType(), False),
    ("execution_date", DateType(), False),
    ("refreshed_at", TS, False),
)

# ---- landed inputs -----------------------------------------------------------
# Quote API response: a date-keyed map of string fields, or one of three error bodies.
QUOTES_RESPONSE = StructType(
    [
        StructField("Meta Data", MapType(StringType(), StringType()), True),
        StructField("Time Series (Daily)", MapType(StringType(), MapType(StringType(), StringType())), True),
        StructField("Error Message", StringType(), True),
        StructField("Note", StringType(), True),
        StructField("Information", StringType(), True),
        StructField("_corrupt_record", StringType(), True),  # text of an unreadable document
    ]
)
# FX XML (rowTag ValCurs): root attribute Date plus repeated Valute elements.
VALUTE = StructType(
    [
        StructField("_ID", StringType(), True),
        StructField("NumCode", StringType(), True),
        StructField("CharCode", StringType(), True),
        StructField("Nominal", StringType(), True),
        StructField("Name", StringType(), True),
        StructField("Value", StringType(), True),
    ]
)
RATES_XML = StructType(
    [
        StructField("_Date", StringType(), True),
        StructField("_name", StringType(), True),
        StructField("Valute", ArrayType(VALUTE), True),
        StructField("_corrupt_record", StringType(), True),  # text of an unreadable document
    ]
)
# Raw-layer messages: every field as text, decimals serialised as strings.
QUOTE_MESSAGE = _s(
    ("symbol", StringType(), True),
    ("open", StringType(), True),
    ("high", StringType(), True),
    ("low", StringType(), True),
    ("close", StringType(), True),
    ("volume", StringType(), True),
    ("trade_date", StringType(), True),
    ("source", StringType(), True),
    ("loaded_at", StringType(), True),
)
RATE_MESSAGE = _s(
    ("base_currency", StringType(), True),
    ("target_currency", StringType(), True),
    ("rate", StringType(), True),
    ("rate_date", StringType(), True),
    ("source", StringType(), True),
    ("loaded_at", StringType(), True),
)
INSTRUMENT_MESSAGE = _s(
    ("symbol", StringType(), True),
    ("name", StringType(), True),
    ("exchange", StringType(), True),
    ("asset_type", StringType(), True),
    ("source", StringType(), True),
    ("loaded_at", StringType(), True),
)


class ContractError(ValueError):
    pass


def check_contract(df: DataFrame, contract: StructType, strict_nullability: bool = False) -> DataFrame:
    """M7: names, order and types must match the declared table; returns df projected.

    Runs on the analysed schema only (no Spark job).
    """
    actual = {f.name: f for f in df.schema.fields}
    problems = []
    for field in contract.fields:
        got = actual.get(field.name)
        if got is None:
            problems.append(f"missing column {field.name}")
        elif got.dataType != field.dataType:
            problems.append(f"{field.name}: {got.dataType.simpleString()} != {field.dataType.simpleString()}")
        elif strict_nullability and got.nullable and not field.nullable:
            problems.append(f"{field.name}: nullable")
    if problems:
        raise ContractError("; ".join(problems))
    return df.select(*[f.name for f in contract.fields])
