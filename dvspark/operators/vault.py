"""Generic Data Vault loads: hubs, links, satellites.

Loads are lazy ``DataFrame -> DataFrame`` functions returning the rows to
append.  Keys come from :mod:`dvspark.functions.hashing`; MD5 keys hash
uniformly, so shuffles on them are balanced.  Satellite work is always
partitioned by the full grain (parent key *and* business date), so one
instrument with a huge history still spreads over many tasks.

Satellite rows carry ``load_date`` = the load that produced them and
``record_source`` = the row's own source (not a constant).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dvspark.functions.cols import as_col
from dvspark.functions.hashing import hash_diff, hash_key, hash_key_composite, schema_types

# ----------------------------------------------------------------------- hubs


def load_hub(
    batch: DataFrame,
    business_key,
    hk_name: str,
    bk_name: str,
    existing: DataFrame | None = None,
    load_date="loaded_at",
    record_source="source",
) -> DataFrame:
    """H5-H7: one row per business key not yet in the hub.

    A key seen several times (or from several sources) becomes one row whose
    ``load_date``/``record_source`` are those of its earliest arrival (tie:
    smallest source).  NULL keys never enter a hub.  The grouping is a
    partial + final aggregate on the hash key itself: repeated keys collapse
    before the shuffle, and the anti join with the stored hub reuses it.
    """
    bk = as_col(business_key)
    first = (
        batch.where(bk.isNotNull())
        .groupBy(hash_key(bk).alias(hk_name))
        .agg(
            F.min(bk).alias(bk_name),
            F.min(
                F.struct(
                    as_col(load_date).alias("load_date"),
                    as_col(record_source).alias("record_source"),
                )
            ).alias("_first"),
        )
    )
    hub = first.select(
        hk_name,
        F.col(bk_name),
        F.col("_first.load_date").alias("load_date"),
        F.col("_first.record_source").alias("record_source"),
    )
    if existing is not None:
        hub = hub.join(existing.select(hk_name), hk_name, "left_anti")
    return hub


# ---------------------------------------------------------------------- links


def load_link(
    batch: DataFrame,
    parts: Sequence[tuple[str, object]],
    lnk_name: str,
    existing: DataFrame | None = None,
    load_date="loaded_at",
    record_source="source",
) -> tuple[DataFrame, DataFrame]:
    """L1-L2: one row per new ordered combination of hub keys.

    ``parts`` is ``[(hub_hk_column_name, business_key_column), ...]`` in link
    order (base before target: (RUB, USD) != (USD, RUB)).  Rows with a NULL
    part are returned separately as quarantine (concat_ws would silently skip
    the NULL and produce a wrong key).  Returns ``(links, rejected)``.
    """
    names = [n for n, _ in parts]
    cols = [as_col(c) for _, c in parts]
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | c.isNull()
    rejected = batch.where(any_null).withColumn("reason", F.lit("null_link_part"))
    keyed = batch.where(~any_null).select(
        *[hash_key(c).alias(n) for n, c in zip(names, cols)],
        as_col(load_date).alias("_ld"),
        as_col(record_source).alias("_rs"),
    )
    # Grouped by the link key itself, so the anti join with the stored link reuses the shuffle.
    first = keyed.groupBy(hash_key_composite(*names).alias(lnk_name)).agg(
        *[F.min(n).alias(n) for n in names], F.min(F.struct(F.col("_ld").alias("ld"), F.col("_rs").alias("rs"))).alias("_f")
    )
    links = first.select(
        lnk_name,
        *names,
        F.col("_f.ld").alias("load_date"),
        F.col("_f.rs").alias("record_source"),
    )
    if existing is not None:
        links = links.join(existing.select(lnk_name), lnk_name, "left_anti")
    return links, rejected


# ----------------------------------------------------------------- satellites


def enrich_with_hub(batch: DataFrame, hub: DataFrame, hk_name: str) -> DataFrame:
    """Keep rows whose hub key exists (left semi join; the hub is unique per key)."""
    return batch.join(hub.select(hk_name), hk_name, "left_semi")


def prepare_satellite(
    batch: DataFrame,
    parent_hk: str,
    parent_bk,
    attributes: Sequence[str],
    load_date="loaded_at",
    record_source="source",
    parent_key: Column | None = None,
) -> DataFrame:
    """Add parent hash key, hash_diff, load_date and record_source to raw rows.

    The parent key is ``hash_key(parent_bk)`` for a hub parent, or the given
    ``parent_key`` expression (e.g. a link key over two hub keys).
    """
    return batch.select(
        "*",
        (hash_key(parent_bk) if parent_key is None else parent_key).alias(parent_hk),
        hash_diff(*attributes, types=schema_types(batch)).alias("hash_diff"),
        as_col(load_date).alias("_load_date"),
        as_col(record_source).alias("_record_source"),
    ).select(
        *[c for c in batch.columns if c not in ("load_date", "record_source")],
        parent_hk,
        "hash_diff",
        F.col("_load_date").alias("load_date"),
        F.col("_record_source").alias("record_source"),
    )


def satellite_history(versions: DataFrame, grain: Sequence[str], prefer: Sequence[Column] = ()) -> DataFrame:
    """Keep a version iff its hash_diff differs from the previous version of its grain.

    Equivalent to loading the batches one by one in ``load_date`` order with
    the delta rule (T3).  Two versions with the same (grain, load_date) -
    two sources in one load - are reduced to one first: ``prefer`` orderings,
    then the smallest ``record_source`` and ``hash_diff``.  Both windows partition by ``grain``
    only, so the plan has a single exchange and a single sort.
    """
    grain = list(grain)
    by_load = Window.partitionBy(*grain).orderBy("load_date", *prefer, "record_source", "hash_diff")
    w = Window.partitionBy(*grain).orderBy("load_date")
    one_per_load = versions.withColumn("_prev_ld", F.lag("load_date").over(by_load)).where(
        F.col("_prev_ld").isNull() | (F.col("_prev_ld") != F.col("load_date"))
    )
    return (
        one_per_load.withColumn("_prev_hd", F.lag("hash_diff").over(w))
        .where(F.col("_prev_hd").isNull() | (F.col("_prev_hd") != F.col("hash_diff")))
        .drop("_prev_ld", "_prev_hd")
    )


def latest_version(
    sat: DataFrame, grain: Sequence[str], keep_ties: bool = False, as_of: Column | None = None
) -> DataFrame:
    """The newest version per grain.

    ``keep_ties=False``: ``row_number`` with tie-break (load_date desc,
    hash_diff desc) - one row per grain, as a mart primary key needs.
    ``keep_ties=True``: ``rank`` - every row sharing ``MAX(load_date)``, the
    reference SQL semantics.  Spark plans either as a partial
    ``WindowGroupLimit`` before the shuffle, then the final one.
    ``as_of``: only versions with ``load_date <= as_of`` (point in time).
    """
    if as_of is not None:
        sat = sat.where(F.col("load_date") <= as_of)
    if keep_ties:
        w = Window.partitionBy(*grain).orderBy(F.col("load_date").desc())
        return sat.withColumn("_rk", F.rank().over(w)).where(F.col("_rk") == 1).drop("_rk")
    w = Window.partitionBy(*grain).orderBy(F.col("load_date").desc(), F.col("hash_diff").desc())
    return sat.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def within_dates(stored: DataFrame, batch: DataFrame, date_col: str) -> DataFrame:
    """``stored`` between the first and last business date of ``batch``, and its rows without a date.

    The bounds are scalar subqueries of one plan, so a scan of a table
    partitioned by ``date_col`` reads the batch's days only.
    """
    lo, hi = batch.select(F.min(date_col)).scalar(), batch.select(F.max(date_col)).scalar()
    return stored.where(((F.col(date_col) >= lo) & (F.col(date_col) <= hi)) | F.col(date_col).isNull())


def satellite_delta(
    batch: DataFrame,
    existing: DataFrame | None,
    grain: Sequence[str],
    arrivals: DataFrame | None = None,
    date_col: str | None = None,
) -> DataFrame:
    """T3 generalised: rows that the satellite lacks once ``batch`` (already prepared) has arrived.

    ``arrivals``: the versions of all earlier loads as they arrived (from the
    stored raw zone).  The touched grains are then recomputed from all that
    arrived, so a load that comes late is put in its place: it is compared
    with its true predecessor, and a version that an earlier load had dropped
    as unchanged is appended if the late one made it a change again.  The
    table is append-only, so a stored version may become redundant;
    :func:`satellite_history` over the stored rows is the exact view.

    Without ``arrivals`` the stored versions stand for them, which is the same
    as long as loads arrive in ``load_date`` order.  On equal ``load_date``
    what came first wins, so re-sending a load adds nothing.

    ``date_col``: business date by which the stored sides are partitioned;
    they are read between the batch's first and last date only.
    """
    grain = list(grain)
    cols = batch.columns
    if date_col is not None:
        existing = within_dates(existing, batch, date_col) if existing is not None else None
        arrivals = within_dates(arrivals, batch, date_col) if arrivals is not None else None
    earlier = arrivals if arrivals is not None else existing
    if earlier is None:
        history = satellite_history(batch, grain)
    else:
        touched = batch.select(*grain).distinct()
        before = earlier.join(touched, grain, "left_semi").select(*cols).withColumn("_new", F.lit(False))
        merged = before.unionByName(batch.select(*cols).withColumn("_new", F.lit(True)))
        history = satellite_history(merged, grain, prefer=[F.col("_new").asc()])
        if arrivals is None:
            return history.where(F.col("_new")).drop("_new")
        history = history.drop("_new")
    if existing is None:
        return history
    version = [*grain, "load_date", "hash_diff"]
    return history.join(existing.select(*version), version, "left_anti").select(*cols)


def load_satellite(
    batch: DataFrame,
    existing: DataFrame | None,
    grain: Sequence[str],
    columns: Sequence[str],
    hub: DataFrame | None = None,
    parent_hk: str | None = None,
    arrivals: DataFrame | None = None,
    date_col: str | None = None,
) -> DataFrame:
    """T4/T5: rows to append = T1 (optional) -> T3 delta, projected to the table contract."""
    if hub is not None:
        batch = enrich_with_hub(batch, hub, parent_hk or grain[0])
    return satellite_delta(batch, existing, grain, arrivals, date_col).select(*columns)


def scd2(history: DataFrame, key: Sequence[str]) -> DataFrame:
    """End-date each version with the next version's load_date (NULL = current)."""
    w = Window.partitionBy(*key).orderBy("load_date")
    return history.withColumn("load_end_date", F.lead("load_date").over(w))
