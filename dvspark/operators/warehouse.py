"""The concrete hubs, links and satellites of the quote and rate warehouse.

A few lines each over the generic loads of :mod:`dvspark.operators.vault`; jobs
and the query catalog share them.  ``existing`` is the stored table without the
load being written: only new keys come back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dvspark import schemas as S
from dvspark.functions.hashing import hash_key, hash_key_composite
from dvspark.operators import vault as V

SAT_QUOTE_COLS = [f.name for f in S.SAT_QUOTE_PRICES.fields]
SAT_RATE_COLS = [f.name for f in S.SAT_RATE_VALUES.fields]
QUOTE_GRAIN = ["hub_instrument_hk", "trade_date"]
RATE_GRAIN = ["lnk_rate_currency_hk", "rate_date"]


def hub_instrument(raw: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return V.load_hub(raw, "symbol", "hub_instrument_hk", "instrument_bk", existing=existing)


def hub_market(instruments: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return V.load_hub(instruments, "exchange", "hub_market_hk", "market_code", existing=existing)


def hub_currency(rates: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    codes = rates.select(F.col("base_currency").alias("currency_code"), "loaded_at", "source").unionByName(
        rates.select(F.col("target_currency").alias("currency_code"), "loaded_at", "source")
    )
    return V.load_hub(codes, "currency_code", "hub_currency_hk", "currency_code", existing=existing)


def lnk_quote_instrument(instruments: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    links, _ = V.load_link(
        instruments,
        [("hub_instrument_hk", "symbol"), ("hub_market_hk", "exchange")],
        "lnk_quote_instrument_hk",
        existing=existing,
    )
    return links


def rejected_links(rows: DataFrame) -> DataFrame:
    """Rows of instruments or rates that lack a part of their link's key, with the ``reason`` (see :func:`V.load_link`)."""
    parts = [("hub_instrument_hk", "symbol"), ("hub_market_hk", "exchange")] if "symbol" in rows.columns else [("base", "base_currency"), ("target", "target_currency")]
    return V.load_link(rows, parts, "link")[1]


def lnk_rate_currency(rates: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    links, _ = V.load_link(
        rates,
        [("hub_currency_hk_base", "base_currency"), ("hub_currency_hk_target", "target_currency")],
        "lnk_rate_currency_hk",
        existing=existing,
    )
    return links


def quote_versions(raw: DataFrame) -> DataFrame:
    return V.prepare_satellite(raw, "hub_instrument_hk", "symbol", S.QUOTE_HASH_COLUMNS)


def rate_versions(rates: DataFrame) -> DataFrame:
    lnk = hash_key_composite(hash_key("base_currency"), hash_key("target_currency"))
    return V.prepare_satellite(rates, "lnk_rate_currency_hk", None, S.RATE_HASH_COLUMNS, parent_key=lnk)


def details_versions(instruments: DataFrame, *keep: str) -> DataFrame:
    versions = V.prepare_satellite(instruments, "hub_instrument_hk", "symbol", S.DETAILS_HASH_COLUMNS)
    return versions.select("hub_instrument_hk", "load_date", "record_source", "hash_diff", *S.DETAILS_HASH_COLUMNS, *keep)


def sat_quotes(raw: DataFrame) -> DataFrame:
    return V.satellite_history(quote_versions(raw), QUOTE_GRAIN).select(*SAT_QUOTE_COLS)


def sat_rates(rates: DataFrame) -> DataFrame:
    return V.satellite_history(rate_versions(rates), RATE_GRAIN).select(*SAT_RATE_COLS)


def sat_details(instruments: DataFrame) -> DataFrame:
    hist = V.satellite_history(details_versions(instruments), ["hub_instrument_hk"])
    return V.scd2(hist, ["hub_instrument_hk"]).select(*[f.name for f in S.SAT_INSTRUMENT_DETAILS.fields])


def normalize_rate_direction(rates: DataFrame, quoted_base_per_target: bool) -> DataFrame:
    """§1.5: ``rate`` = units of base per one unit of target.

    A feed quoting the opposite way (units of *target* per base: USD->RUB =
    90.5) is swapped on ingestion - base and target exchange places, the
    number is kept.  Never on read.
    """
    if quoted_base_per_target:
        return rates
    return rates.select(
        F.col("target_currency").alias("base_currency"),
        F.col("base_currency").alias("target_currency"),
        *[c for c in rates.columns if c not in ("base_currency", "target_currency")],
    )
