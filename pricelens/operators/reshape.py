"""Long <-> wide reshaping and set operations."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions.columns import normalized, normalized_name, tidy_label


#: The column that a dealt wide table's rows were dealt out by.
DEALT = "__dealt"


def product_names(df: DataFrame, name: str = "prix_nom", limit: int = 1000) -> list[str]:
    """The normalised product names that occur, sorted: one distinct.  A table
    with more than ``limit`` of them is no product column and raises."""
    found = (df.select(normalized(name).alias("n")).filter("n IS NOT NULL").distinct()
               .limit(limit + 1).collect())
    if len(found) > limit:
        raise ValueError(f"more than {limit} product names in {name!r}")
    return sorted(r["n"] for r in found)


def unlisted_products(df: DataFrame, values: Sequence[str], name: str = "prix_nom") -> DataFrame:
    """(name, rows) of the product names that a pivot on ``values`` leaves out."""
    listed = [normalized_name(v) for v in values]
    return (df.filter(F.col(name).isNotNull() & ~normalized(name).isin(listed))
              .groupBy(F.col(name).alias("name")).agg(F.count(F.lit(1)).alias("rows")))


def latest_order(df: DataFrame, order: Sequence[str]) -> list:
    """Ordering expressions of the latest observation: text columns compare as
    numbers where they are numbers ("10" after "9"), then as text."""
    kinds = dict(df.dtypes)
    out = []
    for c in order:
        out += [F.col(c).try_cast("bigint"), F.col(c)] if kinds[c] == "string" else [F.col(c)]
    return out


def wide_keys(df: DataFrame, *, name: str = "prix_nom", value: str = "prix_valeur",
              order: Sequence[str] | None = None, keys: Sequence[str] | None = None,
              exclude: Iterable[str] = ()) -> tuple[list, list]:
    """(key columns, order columns) of the wide table, with their defaults; see
    ``pivot_wide``."""
    if order is None:
        order = [("prix_maj_ts" if "prix_maj_ts" in df.columns else "prix_maj"), "prix_id"]
        order = [c for c in order if c in df.columns]
    skip = set(schema.OBSERVATION_COLUMNS) | {name, value} | set(order) | set(exclude)
    return list(keys if keys is not None else [c for c in df.columns if c not in skip]), list(order)


def pivot_wide(
    df: DataFrame,
    values: Sequence[str] | None = None,
    *,
    name: str = "prix_nom",
    value: str = "prix_valeur",
    order: Sequence[str] | None = None,
    keys: Sequence[str] | None = None,
    exclude: Iterable[str] = (),
    dealt: Column | None = None,
) -> DataFrame:
    """One row per key tuple, one column per product.

    Each cell holds the *latest valid* value: among rows of that product
    with a non-NULL value, the one with the greatest ``order`` tuple
    (``max_by``).  The default order is the parsed moment ``prix_maj_ts`` (the
    text ``prix_maj`` where the clean step did not run), then ``prix_id`` as a
    number.  Keys default to every column that is not part of the observation
    (name, value, timestamps, ids, source file) nor of ``order``.

    Product names match in their normal form, which is the output column.  With
    an explicit list no job runs to discover it (``unlisted_products`` counts
    what it leaves out); with None every name that occurs becomes a column.
    The pivot is written as one conditional aggregate per product: a single
    aggregation with map-side partial aggregation, so an entity with a huge
    number of observations collapses before the shuffle.

    With ``dealt``, a struct over key columns (``features.range_key``), the rows are
    dealt out by it ahead of the aggregate, and it stays as the first column
    ``DEALT``: what follows by it needs no shuffle of its own.  Keys that are fields
    of it travel in it alone.  As several readers of that shuffle may each run the
    aggregate, the greatest value counts among rows of the same order.
    """
    if values is None:
        values = product_names(df, name)
    keys, order = wide_keys(df, name=name, value=value, order=order, keys=keys, exclude=exclude)
    # a single ordering column is used bare: for a fixed-width type (a
    # timestamp, a number) the aggregate then runs as a hash aggregate; a
    # struct ordering needs the sort-based aggregate
    by = latest_order(df, order)
    if dealt is not None:
        return _pivot_dealt(df, values, name, value, by, keys, dealt)
    order_struct = by[0] if len(by) == 1 else F.struct(*by)
    # name and order are worked out once for a row, not once for each product
    rows = df.select(*keys, normalized(name).alias("__name"), order_struct.alias("__order"),
                     F.col(value).alias("__value"))
    aggs = []
    for out in dict.fromkeys(normalized_name(v) for v in values):
        hit = (F.col("__name") == F.lit(out)) & F.col("__value").isNotNull()
        aggs.append(F.max_by(F.when(hit, F.col("__value")), F.when(hit, F.col("__order"))).alias(out))
    return rows.groupBy(*keys).agg(*aggs)


def _pivot_dealt(df: DataFrame, values: Sequence[str], name: str, value: str, by: Sequence[Column],
                 keys: Sequence[str], dealt: Column) -> DataFrame:
    held = df.select(dealt).schema[0].dataType.fieldNames()
    own = [c for c in keys if c not in held]
    cell = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(by)], F.col(value).alias("v"))
    rows = df.select(dealt.alias(DEALT), *own, normalized(name).alias("__name"),
                     F.when(F.col(value).isNotNull(), cell).alias("__cell")).repartition(DEALT)
    names = list(dict.fromkeys(normalized_name(v) for v in values))
    wide = rows.groupBy(DEALT, *own).agg(*[
        F.max(F.when(F.col("__name") == F.lit(out), F.col("__cell"))).alias(out) for out in names])
    return wide.select(DEALT, *[F.col(DEALT)[c].alias(c) if c in held else F.col(c) for c in keys],
                       *[F.col(out)["v"].alias(out) for out in names])


def unpivot_long(
    df: DataFrame,
    columns: dict,
    *,
    ids: Sequence[str],
    variable: str = "fuel_type",
    value: str = "mean_price",
    drop_nulls: bool = True,
) -> DataFrame:
    """Wide -> long.

    ``columns`` maps each measure column to its label in ``variable``;
    absent columns are skipped, and with none present the result is empty
    (same schema).  ``drop_nulls`` removes rows whose value is NULL.
    """
    present = {c: lab for c, lab in columns.items() if c in df.columns}
    ids = [c for c in ids if c in df.columns]
    if not present:
        return df.select(*ids, F.lit(None).cast("string").alias(variable),
                         F.lit(None).cast("double").alias(value)).limit(0)
    renamed = df.select(*ids, *[F.col(c).cast("double").alias(lab)
                                for c, lab in present.items()])
    out = renamed.unpivot(ids, list(present.values()), variable, value)
    if drop_nulls:
        out = out.filter(F.col(value).isNotNull())
    return out


def melt_region(
    df: DataFrame,
    measure_cols: Sequence[str],
    *,
    id_col: str = "region_name",
    variable: str = "carburant",
    value: str = "prix",
) -> DataFrame:
    """Region x product long table, NULL values kept, tidy labels."""
    present = [c for c in measure_cols if c in df.columns]
    out = unpivot_long(df, {c: c for c in present}, ids=[id_col],
                       variable=variable, value=value, drop_nulls=False)
    return out.withColumn(variable, tidy_label(variable))


def region_matrix(df: DataFrame, products: Sequence[str], *,
                  id_col: str = "region_name") -> DataFrame:
    """One row per region with the mean column of each product the table
    has, in the order of ``products``; without any of them the region column
    alone and no rows."""
    present = [schema.mean_col(p) for p in products if schema.mean_col(p) in df.columns]
    out = df.select(id_col, *present)
    return out if present else out.limit(0)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_sorted(df: DataFrame, column: str, *, drop_nulls: bool = False) -> DataFrame:
    """The sorted distinct values of one column."""
    out = df.select(column).distinct()
    if drop_nulls:
        out = out.filter(F.col(column).isNotNull())
    return out.orderBy(F.col(column).asc_nulls_first())
