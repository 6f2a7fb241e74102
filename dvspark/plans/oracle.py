"""DuckDB SQL twins of the catalog queries (the correctness oracle).

The oracle runs on the bare test tables, so each statement carries the
adapter views and vault steps it needs as CTEs.  ``sql(name)`` assembles
``WITH <dependencies> <body>``; CTEs are listed once, dependencies first.
The SQL states each result in its own way (aggregates, QUALIFY, left join +
null filter), so it checks our window/anti-join formulation.
"""

from __future__ import annotations

# ---------------------------------------------------------------- adapter views
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


cte(
    "bars",
    (),
    """
    SELECT user_id, CAST(ts AS DATE) AS trade_date,
           arg_min(CASE WHEN hour(ts) < 12 THEN CAST(value AS DECIMAL(18,6)) END,
                   CASE WHEN hour(ts) < 12 THEN event_id END) AS am_open,
           max(CASE WHEN hour(ts) < 12 THEN CAST(value AS DECIMAL(18,6)) END) AS am_high,
           min(CASE WHEN hour(ts) < 12 THEN CAST(value AS DECIMAL(18,6)) END) AS am_low,
           arg_max(CASE WHEN hour(ts) < 12 THEN CAST(value AS DECIMAL(18,6)) END,
                   CASE WHEN hour(ts) < 12 THEN event_id END) AS am_close,
           count(CASE WHEN hour(ts) < 12 THEN event_id END) AS am_volume,
           arg_min(CAST(value AS DECIMAL(18,6)), event_id) AS open,
           max(CAST(value AS DECIMAL(18,6))) AS high,
           min(CAST(value AS DECIMAL(18,6))) AS low,
           arg_max(CAST(value AS DECIMAL(18,6)), event_id) AS close,
           count(*) AS volume
    FROM events GROUP BY 1, 2""",
)
cte(
    "raw_quotes",
    ("bars",),
    """
    SELECT CAST(user_id AS VARCHAR) AS symbol, am_open AS open_price, am_high AS high_price,
           am_low AS low_price, am_close AS close_price, CAST(am_volume AS BIGINT) AS volume,
           trade_date, 'intraday' AS source, CAST(trade_date AS TIMESTAMP) + INTERVAL 12 HOUR AS loaded_at
    FROM bars WHERE am_volume > 0
    UNION ALL
    SELECT CAST(user_id AS VARCHAR), open, high, low, close, CAST(volume AS BIGINT),
           trade_date, 'eod', CAST(trade_date AS TIMESTAMP) + INTERVAL 24 HOUR
    FROM bars""",
)
cte(
    "rate_quotes",
    (),
    """
    SELECT n.n_name AS target_currency,
           CASE n.n_nationkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 10 ELSE 100 END AS nominal,
           CAST(o.o_orderdate AS DATE) AS rate_date,
           CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'exchange_rate_api' ELSE 'cbr' END AS source,
           max(CAST(o.o_totalprice AS DECIMAL(18,2))) AS value
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                  JOIN nation n ON c.c_nationkey = n.n_nationkey
    GROUP BY 1, 2, 3, 4""",
)
cte(
    "raw_rates",
    ("rate_quotes",),
    """
    SELECT 'RUB' AS base_currency, target_currency,
           CAST(value / nominal AS DECIMAL(18,8)) AS rate, rate_date, source,
           CAST(rate_date AS TIMESTAMP)
             + CASE WHEN source = 'exchange_rate_api' THEN INTERVAL 20 HOUR ELSE INTERVAL 18 HOUR END AS loaded_at
    FROM rate_quotes""",
)
cte(
    "raw_instruments",
    (),
    """
    SELECT CAST(c.c_custkey AS VARCHAR) AS symbol, c.c_name AS instrument_name,
           nullif(c.c_mktsegment, 'HOUSEHOLD') AS exchange, n.n_name AS asset_type, 'refdata' AS source,
           TIMESTAMP '2024-01-01 00:00:00' AS loaded_at
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
)


def sql(body: str, *deps: str) -> str:
    """``WITH`` the transitive dependencies of ``deps`` (in order) + ``body``."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for d in CTES[name][0]:
            visit(d)
        ordered.append(name)

    for d in deps:
        visit(d)
    body = body.strip()
    if not ordered:
        return body
    withs = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in ordered)
    if body[:4].upper() == "WITH":  # the body's own CTEs follow ours
        return f"WITH {withs},\n{body[4:].lstrip()}"
    return f"WITH {withs}\n{body}"


# ----------------------------------------------------------------- vault CTEs
def _hd(*cols: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in cols)
    return f"upper(md5(concat_ws('||', {parts})))"


def _first_per(key: str, cols: str, src: str) -> str:
    return f"""
    SELECT {cols} FROM (
      SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY loaded_at, source) AS rn FROM {src}
    ) WHERE rn = 1"""


def _t7(src: str, grain: str) -> str:
    return f"""
    SELECT * EXCLUDE (prev_hd) FROM (
      SELECT *, lag(hash_diff) OVER (PARTITION BY {grain} ORDER BY load_date) AS prev_hd
      FROM (SELECT * FROM {src}
            QUALIFY row_number() OVER (PARTITION BY {grain}, load_date ORDER BY record_source) = 1)
    ) WHERE prev_hd IS NULL OR prev_hd <> hash_diff"""


QUOTE_ATTRS = ("open_price", "high_price", "low_price", "close_price", "volume")

cte(
    "hub_instrument",
    ("raw_quotes",),
    _first_per(
        "symbol",
        "upper(md5(symbol)) AS hub_instrument_hk, symbol AS instrument_bk, loaded_at AS load_date, source AS record_source",
        "raw_quotes",
    ),
)
cte(
    "sat_quote_versions",
    ("raw_quotes",),
    f"""
    SELECT upper(md5(symbol)) AS hub_instrument_hk, loaded_at AS load_date, source AS record_source,
           {_hd(*QUOTE_ATTRS)} AS hash_diff,
           open_price, high_price, low_price, close_price, volume, trade_date
    FROM raw_quotes""",
)
cte("sat_quote_prices", ("sat_quote_versions",), _t7("sat_quote_versions", "hub_instrument_hk, trade_date"))
cte(
    "sat_details_versions",
    ("raw_instruments",),
    f"""
    SELECT upper(md5(symbol)) AS hub_instrument_hk, loaded_at AS load_date, source AS record_source,
           {_hd('instrument_name', 'exchange', 'asset_type')} AS hash_diff,
           instrument_name, exchange, asset_type
    FROM raw_instruments""",
)
cte(
    "sat_instrument_details",
    ("sat_details_versions",),
    f"""
    SELECT *, lead(load_date) OVER (PARTITION BY hub_instrument_hk ORDER BY load_date) AS load_end_date
    FROM ({_t7('sat_details_versions', 'hub_instrument_hk')})""",
)
cte(
    "currency_codes",
    ("raw_rates",),
    """
    SELECT base_currency AS currency_code, loaded_at, source FROM raw_rates
    UNION ALL
    SELECT target_currency, loaded_at, source FROM raw_rates""",
)
cte(
    "hub_currency",
    ("currency_codes",),
    _first_per(
        "currency_code",
        "upper(md5(currency_code)) AS hub_currency_hk, currency_code, loaded_at AS load_date, source AS record_source",
        "currency_codes",
    ),
)
cte(
    "lnk_rate_currency",
    ("raw_rates",),
    _first_per(
        "base_currency, target_currency",
        "upper(md5(concat_ws('||', upper(md5(base_currency)), upper(md5(target_currency))))) AS lnk_rate_currency_hk, "
        "upper(md5(base_currency)) AS hub_currency_hk_base, upper(md5(target_currency)) AS hub_currency_hk_target, "
        "loaded_at AS load_date, source AS record_source",
        "raw_rates",
    ),
)
cte(
    "sat_rate_versions",
    ("raw_rates",),
    f"""
    SELECT upper(md5(concat_ws('||', upper(md5(base_currency)), upper(md5(target_currency))))) AS lnk_rate_currency_hk,
           loaded_at AS load_date, source AS record_source, {_hd('rate')} AS hash_diff, rate, rate_date
    FROM raw_rates""",
)
cte("sat_rate_values", ("sat_rate_versions",), _t7("sat_rate_versions", "lnk_rate_currency_hk, rate_date"))

# One run timestamp for all mart rows of the catalog (a parameter of the build).
MART_LOADED_AT = "2024-02-01 20:00:00"

cte(
    "newest_quotes",
    ("sat_quote_prices",),
    """
    SELECT hub_instrument_hk, trade_date,
           arg_max(struct_pack(o := open_price, h := high_price, l := low_price, c := close_price, v := volume), load_date) AS bar
    FROM sat_quote_prices GROUP BY ALL""",
)
cte(
    "mart_quotes_all",
    ("newest_quotes", "hub_instrument", "sat_instrument_details"),
    f"""
    WITH known AS (
      SELECT hub_instrument_hk, instrument_name, exchange, asset_type FROM sat_instrument_details WHERE load_end_date IS NULL
    ), named AS (
      SELECT i.instrument_bk, k.*, q.trade_date, q.bar
      FROM newest_quotes q JOIN hub_instrument i USING (hub_instrument_hk) LEFT JOIN known k USING (hub_instrument_hk)
    )
    SELECT instrument_bk, ifnull(instrument_name, 'Unknown') AS instrument_name, ifnull(exchange, 'Unknown') AS exchange,
           ifnull(asset_type, 'Unknown') AS asset_type, trade_date,
           bar.o AS open_price, bar.h AS high_price, bar.l AS low_price, bar.c AS close_price, bar.v AS volume,
           CAST(ifnull(round(100 * (bar.c - bar.o) / nullif(bar.o, 0), 4), 0) AS DECIMAL(18,4)) AS daily_return_pct,
           CAST(bar.h - bar.l AS DECIMAL(18,6)) AS price_range, TIMESTAMP '{MART_LOADED_AT}' AS loaded_at
    FROM named""",
)
cte(
    "mart_fx_rates",
    ("sat_rate_values", "raw_rates"),
    f"""
    WITH pairs AS (
      SELECT DISTINCT base_currency, target_currency,
             upper(md5(concat_ws('||', upper(md5(base_currency)), upper(md5(target_currency))))) AS pair_hk
      FROM raw_rates
    ), newest AS (
      SELECT * FROM sat_rate_values
      QUALIFY row_number() OVER (PARTITION BY lnk_rate_currency_hk, rate_date ORDER BY load_date DESC, hash_diff DESC) = 1
    )
    SELECT base_currency, target_currency, newest.rate, newest.rate_date, newest.record_source AS source,
           TIMESTAMP '{MART_LOADED_AT}' AS loaded_at
    FROM newest JOIN pairs ON pair_hk = lnk_rate_currency_hk""",
)
