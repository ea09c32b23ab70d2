"""IQR outlier detection (A1-A5)."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sizing import materialize, scalar_struct
from .quantiles import exact_quantiles


def iqr_bounds(df: DataFrame, columns: Sequence[str], *, lower_quantile: float = 0.25,
               upper_quantile: float = 0.75, iqr_multiplier: float = 1.5,
               method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """A1: one row with ``{c}_q1, {c}_q3, {c}_lower, {c}_upper`` per column.

    ``method="exact"``: linear-interpolation quantiles of all columns in one
    distributed pass (the columns are stacked to ``(column, value)`` and the
    column name becomes the group; see ``quantiles.exact_quantiles``).
    ``"approx"``: one aggregate of ``percentile_approx`` sketches, relative
    rank error ``1/accuracy`` (the published job used a sketch with error
    0.01, i.e. ``accuracy=100``).  NULLs are ignored; an all-NULL column
    gives NULL bounds, hence no flags.
    """
    cols = list(columns)
    probs = [lower_quantile, upper_quantile]
    if method == "exact":
        stacked = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_val"))
            for c in cols])).alias("_s")).select("_s.*")
        q = exact_quantiles(stacked, "_val", probs, groups=["_col"], names=["_q1", "_q3"])
        # at most len(columns) rows -> one row (a global aggregate always
        # returns one row, NULLs for columns without values)
        row = q.agg(*[F.max(F.when(F.col("_col") == c, F.col(n))).alias(f"{c}_{n[1:]}")
                      for c in cols for n in ("_q1", "_q3")])
    else:
        sk = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(f"_{i}")
                      for i, c in enumerate(cols)])
        row = sk.select(*[F.col(f"_{i}")[j].alias(f"{c}_{n}")
                          for i, c in enumerate(cols) for j, n in enumerate(("q1", "q3"))])
    out = []
    for c in cols:
        iqr = F.col(f"{c}_q3") - F.col(f"{c}_q1")
        out += [F.col(f"{c}_q1"), F.col(f"{c}_q3"),
                (F.col(f"{c}_q1") - iqr_multiplier * iqr).alias(f"{c}_lower"),
                (F.col(f"{c}_q3") + iqr_multiplier * iqr).alias(f"{c}_upper")]
    return row.select(*out)


def outlier_flags(df: DataFrame, bounds: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A2: ``is_outlier_{c}`` = strictly outside [lower, upper]; NULL -> false.

    ``bounds`` has exactly one row (A1): it is read as a scalar subquery,
    so the observation table is neither joined nor shuffled.
    """
    b = scalar_struct(bounds.select(*[f"{c}_{s}" for c in columns for s in ("lower", "upper")]))
    flags = [F.coalesce((F.col(c) < b[f"{c}_lower"]) | (F.col(c) > b[f"{c}_upper"]),
                        F.lit(False)).alias(f"is_outlier_{c}") for c in columns]
    return df.select(*df.columns, *flags)


def any_anomaly(df: DataFrame, *, out: str = "has_any_anomaly",
                prefix: str = "is_outlier_") -> DataFrame:
    """A3: true when any ``is_outlier_*`` flag is true (flags are never NULL)."""
    flags = [c for c in df.columns if c.startswith(prefix)]
    if not flags:
        return df
    return df.withColumn(out, reduce(lambda a, b: a | b, [F.col(c) for c in flags]))


def detect_anomalies(df: DataFrame, products: Sequence[str], *, method: str = "exact",
                     accuracy: int = 10000, iqr_multiplier: float = 1.5,
                     bounds_from: DataFrame | None = None, once: bool = True) -> DataFrame:
    """A1-A3 for every product column present.

    ``bounds_from`` (default ``df``) is the table the quantiles are taken
    from - pass the narrow wide table rather than a feature-laden one so
    the quantile pass reads only the product columns.  Without it the rows are
    read twice and first written once (``once=False`` for a table that lies in
    files already).
    """
    ps = [p for p in products if p in df.columns]
    if not ps:
        return df
    if bounds_from is None and once:
        df = materialize(df, "flagged-rows")
    src = bounds_from if bounds_from is not None else df
    bounds = iqr_bounds(src.select(*ps), ps, method=method, accuracy=accuracy,
                        iqr_multiplier=iqr_multiplier)
    return any_anomaly(outlier_flags(df, bounds, ps))


def outlier_metrics(df: DataFrame, *, prefix: str = "is_outlier_",
                    anomaly: str = "has_any_anomaly") -> dict[str, Column]:
    """A4 as aggregates: number of flagged rows by product, and ``any``."""
    flags = {c[len(prefix):]: c for c in df.columns if c.startswith(prefix)}
    if anomaly in df.columns:
        flags["any"] = anomaly
    return {name: F.count_if(F.col(c)) for name, c in flags.items()}


def outlier_rate(df: DataFrame, *, prefix: str = "is_outlier_",
                 anomaly: str = "has_any_anomaly") -> DataFrame:
    """A4: outlier count and percent per flag and overall, from one aggregate."""
    counts = outlier_metrics(df, prefix=prefix, anomaly=anomaly)
    names = list(counts)
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [c.alias(f"_n{i}") for i, c in enumerate(counts.values())]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(n).alias("product"), F.col(f"_n{i}").alias("n_outliers"),
                 F.col("_total").alias("n_rows"))
        for i, n in enumerate(names)]))
    return (wide.select(rows.alias("r")).select("r.*")
            .withColumn("pct_outliers",
                        F.when(F.col("n_rows") > 0,
                               F.col("n_outliers") * 100.0 / F.col("n_rows"))
                        .otherwise(F.lit(0.0))))


def anomalies_by_region(df: DataFrame, *, region_name: str = "region_name",
                        anomaly: str = "has_any_anomaly") -> DataFrame:
    """A5: number of flagged rows per region name."""
    return df.groupBy(region_name).agg(
        F.count_if(F.col(anomaly)).alias("n_anomalies"))
