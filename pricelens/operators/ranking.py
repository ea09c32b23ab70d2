"""Ranking, sort, limit and sampling."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import sample_hash
from ..functions.sizing import materialize


def _ranked(df: DataFrame, group: str | Sequence[str], order: list, n: int,
            rank_col: str) -> DataFrame:
    groups = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*groups).orderBy(*order)
    # row_number <= n over a partition is planned as WindowGroupLimit: each
    # map task keeps only its n best rows per group before the shuffle, so a
    # group holding a third of all rows ships n rows per task, not millions.
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def top_n_per_group(df: DataFrame, *, group="region_code", value: str = "gazole",
                    n: int = 10, columns: Sequence[str] | None = None,
                    tiebreak: Sequence[str] = (), rank_col: str = "rank") -> DataFrame:
    """The ``n`` highest values per group, rank 1..n (NULLs rank last)."""
    order = [F.col(value).desc_nulls_last()] + [F.col(t).asc_nulls_first() for t in tiebreak]
    out = _ranked(df, group, order, n, rank_col)
    return out.select(*(columns or df.columns), rank_col) if columns else out


def bottom_n_per_group(df: DataFrame, *, group="region_code", value: str = "gazole",
                       n: int = 10, columns: Sequence[str] | None = None,
                       tiebreak: Sequence[str] = (), rank_col: str = "rank") -> DataFrame:
    """The ``n`` lowest non-NULL values per group, rank 1..n.

    Rows without a value are excluded: an ascending order would otherwise
    rank them first and fill the list with entities that lack the product.
    """
    order = [F.col(value).asc_nulls_last()] + [F.col(t).asc_nulls_first() for t in tiebreak]
    out = _ranked(df.filter(F.col(value).isNotNull()), group, order, n, rank_col)
    return out.select(*(columns or df.columns), rank_col) if columns else out


def global_top_k(df: DataFrame, *, value: str, k: int = 15, largest: bool = True,
                 tiebreak: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """The ``k`` largest (or smallest) rows overall.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: a per-task
    top-k heap and a k-row merge, no full sort.  NULL values never qualify.
    """
    v = F.col(value)
    order = [v.desc() if largest else v.asc()] + [F.col(t).asc_nulls_first() for t in tiebreak]
    out = df.filter(v.isNotNull()).orderBy(*order).limit(k)
    return out.select(*columns) if columns else out


def sort_by(df: DataFrame, *cols, ascending: bool = True) -> DataFrame:
    """Display ordering (NULLs last)."""
    order = [F.col(c).asc_nulls_last() if ascending else F.col(c).desc_nulls_last()
             for c in cols]
    return df.orderBy(*order)


def head(df: DataFrame, n: int = 10) -> DataFrame:
    """Preview of ``n`` rows."""
    return df.limit(n)


def bounded_sample(df: DataFrame, *, n: int = 5000, seed: int = 42,
                   key: Sequence[str], prefilter: bool = True) -> DataFrame:
    """At most ``n`` rows, chosen by a seeded hash of the key.

    Exactly ``n`` rows when there are more: the rows with the smallest
    ``sample_hash(key, seed)`` (MD5 hex of the key text; ties by key).  The
    choice depends only on the data, not on partitioning or task order, and
    runs as a top-k (TakeOrderedAndProject), never a full sort.  The key has to
    be unique, e.g. entity and date of a wide table: a key that many rows share
    would pick whole entities.  Integer, string or date columns.

    A top-k alone ends in one task merging ``n`` rows from every task.
    With ``prefilter`` (eager) the rows are counted, and the hash, uniform over
    the 128-bit range, is cut at a threshold that about ``4 n`` rows pass; the n
    smallest hashes are all below it, so the result is the same, and the merge
    sees thousands of rows.  If fewer than ``n`` pass (vanishingly unlikely), the
    threshold goes.  Count and choice read the key columns alone; the chosen keys
    (``n`` rows) are broadcast to fetch the rows, and nothing else is written.
    """
    keys = [F.col(k) for k in key]
    h = sample_hash(keys, seed)
    if not prefilter:
        return df.orderBy(h, *keys).limit(n)
    total = df.count()

    def chosen(rows: DataFrame) -> DataFrame:
        least = rows.select(*keys).orderBy(h, *keys).limit(n)
        return materialize(least.toDF(*[f"__k{i}" for i in range(len(key))]), "sample-keys")
    threshold = (4 * n * 2 ** 128) // max(total, 1)
    if threshold >= 2 ** 128:                      # hardly more rows than asked for
        return df.orderBy(h, *keys).limit(n)
    found = chosen(df.filter(h <= F.lit(format(threshold, "032x"))))
    if found.count() < n:
        found = chosen(df)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(key)])
    return df.join(F.broadcast(found), same, "left_semi").orderBy(h, *keys).limit(n)
