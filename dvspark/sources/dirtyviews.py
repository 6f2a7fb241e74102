"""Defective deliveries derived from the test tables' clean views.

Beside every clean row or document stands one copy for each kind of defect, so
every status, reason and rule of the parsers and checks occurs, and the oracle
can state the outcome in plain SQL (``dvspark.plans.oracle``).  Fixed texts and
days below must equal those of the SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dvspark.schemas import PRICE, RATE
from dvspark.sources import quotes_json as QJ

DOCUMENT_DEFECTS = {
    "error": '{"Error Message": "unknown symbol"}',
    "note": '{"Note": "slow down"}',
    "info": '{"Information": "slow down"}',
    "empty": '{"Meta Data": {}, "Time Series (Daily)": {}}',
}
CUT_AT = 20  # characters left of a truncated document
DAY_DEFECTS = ("no_close", "part_volume", "bad_date", "word_price")
STRETCH_FROM = "2024-01-01"
THRICE_ON = 15  # day of month delivered three times


def defective_documents(texts: DataFrame) -> DataFrame:
    """(…, defect, json_text): every response, its error bodies, its empty and its truncated form."""
    kinds = [("clean", F.col("json_text")), ("cut", F.substring("json_text", 1, CUT_AT)), *((k, F.lit(v)) for k, v in DOCUMENT_DEFECTS.items())]
    variants = F.array(*[F.struct(F.lit(k).alias("defect"), v.alias("json_text")) for k, v in kinds])
    return texts.select("symbol", "source", "period", F.explode(variants).alias("d")).select("symbol", "source", "period", "d.defect", "d.json_text")


def defective_days(raw: DataFrame) -> DataFrame:
    """Responses in which every day has the same defect, one for each kind."""
    numbers = ("open_price", "high_price", "low_price", "close_price", "volume")
    row = F.struct(F.date_format("trade_date", "yyyy-MM-dd").alias("day"), *[F.col(n).cast("string").alias(n) for n in numbers])

    def entry(kind: str, of: Column) -> Column:
        pairs = [
            (QJ.FIELD_OPEN, F.lit("n/a") if kind == "word_price" else of["open_price"]),
            (QJ.FIELD_HIGH, of["high_price"]),
            (QJ.FIELD_LOW, of["low_price"]),
            *([] if kind == "no_close" else [(QJ.FIELD_CLOSE, of["close_price"])]),
            (QJ.FIELD_VOLUME, F.concat(of["volume"], F.lit(".5")) if kind == "part_volume" else of["volume"]),
        ]
        fields = F.create_map(*[x for k, v in pairs for x in (F.lit(k), v)])
        return F.struct((F.concat(F.lit("day "), of["day"]) if kind == "bad_date" else of["day"]).alias("k"), fields.alias("v"))

    # A response holds the days of one month; they are grouped once and then broken in each way.
    docs = raw.groupBy("symbol", "source", F.date_format("trade_date", "yyyy-MM").alias("period")).agg(F.collect_list(row).alias("days"))
    series = lambda kind: F.map_from_entries(F.transform("days", lambda d: entry(kind, d)))
    broken = docs.select("symbol", "source", "period", F.explode(F.array(*[F.struct(F.lit(k).alias("defect"), series(k).alias("series")) for k in DAY_DEFECTS])).alias("d"))
    return broken.select("symbol", "source", "period", "d.defect", F.to_json(F.struct(F.col("d.series").alias(QJ.SERIES))).alias("json_text"))


def _variants(df: DataFrame, defects: dict[str, dict[str, Column]]) -> DataFrame:
    """Every row as it is (``clean``) and once for each defect, with the given columns changed."""
    types = {f.name: f.dataType for f in df.schema.fields}
    row = lambda name, changes: F.struct(F.lit(name).alias("defect"), *[changes.get(c, F.col(c)).cast(types[c]).alias(c) for c in df.columns])
    return df.select(F.explode(F.array(row("clean", {}), *[row(k, v) for k, v in defects.items()])).alias("r")).select("r.*")


def defective_quotes(raw: DataFrame) -> DataFrame:
    return _variants(
        raw,
        {
            "negative": {"low_price": F.lit(-1).cast(PRICE)},
            "above_high": {"open_price": F.col("high_price") + 1},
            "no_volume": {"volume": F.lit(None)},
            "lost_volume": {"volume": F.lit(-5)},
            "no_date": {"trade_date": F.lit(None)},
            "no_close": {"close_price": F.lit(None)},
            "no_source": {"source": F.lit(None)},
            "long_symbol": {"symbol": F.repeat("symbol", F.lit(25))},
            "no_symbol": {"symbol": F.lit(" ")},
        },
    )


def defective_rates(raw: DataFrame) -> DataFrame:
    return _variants(
        raw,
        {
            "zero": {"rate": F.lit(0).cast(RATE)},
            "same": {"target_currency": F.col("base_currency")},
            "no_code": {"target_currency": F.lit(None)},
            "long_code": {"target_currency": F.repeat("base_currency", F.lit(5))},
            "no_date": {"rate_date": F.lit(None)},
            "no_source": {"source": F.lit(None)},
        },
    )


def defective_valutes(quotes: DataFrame) -> DataFrame:
    """Rate quotes with nominal and value as text, once clean and once for each defect."""
    text = quotes.select("target_currency", "rate_date", "source", F.col("nominal").cast("string").alias("nominal"), F.col("value").cast("string").alias("value"))
    return _variants(text, {"zero": {"nominal": F.lit("0")}, "blank": {"nominal": F.lit("")}, "word": {"value": F.lit("n/a")}})


def defective_messages(messages: DataFrame, number: str) -> DataFrame:
    """Messages cut off, without the field ``number``, and with text in it."""
    value = F.col("message_value")
    found = rf'"{number}":"?([0-9.]+)"?'
    kinds = [value, F.substring(value, 1, CUT_AT), F.regexp_replace(value, f'"{number}"', '"other"'), F.regexp_replace(value, found, f'"{number}":"x$1"')]
    return messages.select(F.explode(F.array(*kinds)).alias("message_value"))


def stretched(raw: DataFrame) -> DataFrame:
    """Every second day without a delivery: dates twice as far from the first of the year."""
    days = F.datediff("trade_date", F.lit(STRETCH_FROM).cast("date"))
    return raw.withColumns({"trade_date": F.date_add("trade_date", days), "loaded_at": F.col("loaded_at") + F.make_dt_interval(days=days)})


def thrice_on_a_day(raw: DataFrame) -> DataFrame:
    """The deliveries of one day of the month came three times."""
    copies = F.when(F.dayofmonth("trade_date") == THRICE_ON, 3).otherwise(1)
    return raw.select("*", F.explode(F.sequence(F.lit(1), copies)).alias("copy")).drop("copy")
