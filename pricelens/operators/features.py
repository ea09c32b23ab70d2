"""Derived features (F1-F7): row means, group comparison, change since last."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..functions.sizing import broadcast_if_small, materialize


def _present(df, products):
    return [p for p in products if p in df.columns]


def row_mean(df: DataFrame, products: Sequence[str], *, out: str = "prix_moyen_station",
             digits: int = 3) -> DataFrame:
    """``round(sum(products) / k, 3)``; NULL as soon as one product is NULL."""
    ps = _present(df, products)
    if not ps:
        return df
    total = reduce(lambda a, b: a + b, [F.col(p) for p in ps])
    return df.withColumn(out, F.round(total / F.lit(len(ps)), digits))


def row_mean_available(df: DataFrame, products: Sequence[str], *,
                       out: str = "prix_moyen_disponible", digits: int = 3) -> DataFrame:
    """F1 variant: mean over the products the row has (NULL when it has none)."""
    ps = _present(df, products)
    if not ps:
        return df
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(p), F.lit(0.0)) for p in ps])
    n = reduce(lambda a, b: a + b, [F.col(p).isNotNull().cast("int") for p in ps])
    return df.withColumn(out, F.round(F.try_divide(total, F.when(n > 0, n)), digits))


def group_compare(df: DataFrame, products: Sequence[str], *,
                  group: Sequence[str] = ("region_code",), suffix: str = "region",
                  digits: int = 3, once: bool = True,
                  means_from: DataFrame | None = None) -> DataFrame:
    """Group mean on every row, difference and percent difference.

    ``{p}_moy_{suffix}`` = round(avg(p) over the group, 3) (all dates),
    ``{p}_diff_{suffix}`` = round(p - mean, 3) (from the rounded mean),
    ``{p}_pct_vs_{suffix}`` = round((p - mean) / mean * 100, 2).

    Written as an aggregate joined back on the group keys rather than a
    window partitioned by the group: the aggregate is combined map-side, so
    a region holding a third of the rows never lands in one task.  The
    aggregate (one row per group) is broadcast after a row-count check
    (``broadcast_if_small``), so the big side is not shuffled at all;
    beyond the bound it is a planner-chosen join with AQE skew splitting.
    NULL group keys form their own group (null-safe join), as in a window.
    The rows are read twice, so they are first written once (``once=False``
    for a table that lies in files already, or where ``means_from`` is one with the
    same rows, from which the means are taken).
    """
    ps = _present(df, products)
    keys = list(group)
    if not ps:
        return df
    df = materialize(df, "compared-rows") if once and means_from is None else df
    means = (df if means_from is None else means_from).groupBy(*keys).agg(
        *[F.round(F.avg(p), digits).alias(f"{p}_moy_{suffix}") for p in ps])
    means = broadcast_if_small(means.select(*[F.col(k).alias(f"__g_{k}") for k in keys],
                                            *[f"{p}_moy_{suffix}" for p in ps]))
    cond = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"__g_{k}")) for k in keys])
    out = df.join(means, on=cond, how="left").drop(*[f"__g_{k}" for k in keys])
    mean = {p: F.col(f"{p}_moy_{suffix}") for p in ps}
    diffs = rounded([F.col(p) - mean[p] for p in ps], digits)
    parts = rounded([F.try_divide(F.col(p) - mean[p], mean[p]) * 100 for p in ps], 2)
    cols = [c for i, p in enumerate(ps) for c in (F.col("__diff")[i].alias(f"{p}_diff_{suffix}"),
                                                  F.col("__pct")[i].alias(f"{p}_pct_vs_{suffix}"))]
    return (out.select("*", diffs.alias("__diff"), parts.alias("__pct"))
            .select(*[F.col(f"`{c}`") for c in out.columns], *cols))


def competitive_flags(df: DataFrame, products: Sequence[str], *,
                      suffix: str = "region") -> DataFrame:
    """``competitive_{p}`` = below the group mean (NULL counts as false)."""
    cols = [F.coalesce(F.col(f"{p}_diff_{suffix}") < 0, F.lit(False)).alias(f"competitive_{p}")
            for p in products if f"{p}_diff_{suffix}" in df.columns]
    return df.select("*", *cols) if cols else df


def competitive_score(df: DataFrame, products: Sequence[str], *, suffix: str = "region",
                      out: str = "competitivity_score") -> DataFrame:
    """number of products priced below the group mean."""
    terms = [F.when(F.col(f"{p}_diff_{suffix}") < 0, 1).otherwise(0)
             for p in products if f"{p}_diff_{suffix}" in df.columns]
    if not terms:
        return df
    return df.withColumn(out, reduce(lambda a, b: a + b, terms))


#: Days of an entity's rows in one task of ``lag_change``.
RANGE_DAYS = 31


def date_range(column: str, kind: str, days: int = RANGE_DAYS) -> Column | None:
    """Number of the ``days`` long range that a date or moment lies in, ascending
    with it; None for other types."""
    if kind == "date":
        return F.floor(F.unix_date(column) / days)
    if kind == "timestamp":
        return F.floor(F.unix_seconds(column) / (86_400 * days))
    return None


def range_key(entity: str, date: str, kind: str, days: int = RANGE_DAYS) -> Column | None:
    """Entity and range of days as one struct: never NULL, so that a window and a join
    by it share one exchange, and equal where both fields are equal or NULL."""
    part = date_range(date, kind, days)
    return None if part is None else F.struct(F.col(entity).alias(entity), part.alias("__range"))


def lag_change(df: DataFrame, value: str = "gazole", *, entity: str = "id",
               order: Sequence[str] = ("prix_maj_date",), tiebreak: Sequence[str] = (),
               out: str | None = None, days: int = RANGE_DAYS, dealt: str | None = None) -> DataFrame:
    """value minus the entity's previous value in date order (unrounded).

    Where the first order column is a date or a moment, rows are split by entity
    and range of ``days`` days, so an entity with a third of all rows is as many
    tasks as it has ranges.  A range's first row takes the last value of the range
    before from a carry table: one row for each entity and range that it has rows
    in, an aggregate of the key, order and value columns that is combined before
    its shuffle.  The rows themselves go through one shuffle, or none where
    ``dealt`` names a column with their ``range_key`` by which they are dealt out
    already (it is dropped).
    """
    ordered = [F.col(c).asc_nulls_first() for c in list(order) + list(tiebreak)]
    name = out or f"{value}_evolution"
    key = F.col(dealt) if dealt else range_key(entity, order[0], dict(df.dtypes)[order[0]], days)
    if key is None:
        w = Window.partitionBy(entity).orderBy(*ordered)
        return df.withColumn(name, F.col(value) - F.lag(value, 1).over(w))
    at = dealt or "__key"
    w = Window.partitionBy(at).orderBy(*ordered)
    cell = F.struct(F.col(value).alias("v"))       # a NULL value is a previous value too
    rows = df if dealt else df.withColumn(at, key)
    last = rows.groupBy(at).agg(F.max_by(cell, F.struct(*order, *tiebreak)).alias("__last"))
    rows = rows.withColumn("__before", F.lag(cell).over(w))
    by_range = Window.partitionBy(F.col(at)[entity]).orderBy(F.col(at)["__range"].asc_nulls_first())
    carry = last.select(F.col(at).alias("__at"), F.lag("__last").over(by_range).alias("__carry"))
    got = rows.join(carry, F.col(at) == F.col("__at"), "left")
    before = F.coalesce("__before", "__carry")["v"]
    return got.select(*[F.col(f"`{c}`") for c in df.columns if c not in (name, at)],
                      (F.col(value) - before).alias(name))


def add_features(df: DataFrame, products: Sequence[str], *,
                 flagged: Sequence[str] = ("gazole", "sp95"),
                 group: Sequence[str] = ("region_code",), entity: str = "id",
                 date: str = "prix_maj_date", tiebreak: Sequence[str] = (),
                 lag_product: str | None = None, once: bool = True,
                 means_from: DataFrame | None = None, changed: bool = False) -> DataFrame:
    """F1-F7 in the published column order (``once`` and ``means_from`` as in
    ``group_compare``).  ``changed``: the rows have their change since last (F7) already."""
    ps = _present(df, products)
    lag_product = lag_product or (flagged[0] if flagged else None)
    change, compared = [], means_from
    if changed:
        change = [f"{lag_product}_evolution"]
    elif date in df.columns and lag_product in ps:
        # first: its shuffle carries the narrow rows, what follows needs none
        if once:
            df, once = materialize(df, "compared-rows"), False
        change = [f"{lag_product}_evolution"]
        compared = df if means_from is None else means_from
        df = lag_change(df, lag_product, entity=entity, order=(date,), tiebreak=tiebreak)
    out = row_mean(df, ps)
    out = group_compare(out, ps, group=group, once=once, means_from=compared)
    out = competitive_flags(out, [p for p in flagged if p in ps])
    out = competitive_score(out, ps)
    return out.select(*[F.col(f"`{c}`") for c in out.columns if c not in change], *change)
