"""Dashboard re-aggregations over the marts.

Inputs are marts (a few rows per geography and date) or the detailed
table; every function stays a DataFrame so the same code serves a
100-row mart and a billion-row detailed table.  Scalar statistics are
one-row aggregates attached with a broadcast of that single row.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import format_date_dmy, price_bin
from ..functions.sizing import materialize, scalar_struct
from ..schema import PRODUCT_LABELS, mean_col
from .lookups import map_dept_region
from .quantiles import _join_ns, exact_quantiles
from .reshape import unpivot_long


def mart_long(df: DataFrame, products: Sequence[str], *, ids: Sequence[str],
              labels: dict | None = None, variable: str = "fuel_type",
              value: str = "mean_price") -> DataFrame:
    """R2 over a mart: ``{p}_moyen`` columns to (ids..., fuel_type, mean_price)."""
    labels = labels or PRODUCT_LABELS
    cols = {mean_col(p): labels.get(p, p) for p in products}
    return unpivot_long(df, cols, ids=ids, variable=variable, value=value)


def rollup_region(df: DataFrame, *, department: str = "departement", region: str = "region",
                  value: str = "mean_price", count: str = "nombre_stations",
                  keys: Sequence[str] = ("date", "fuel_type"),
                  mapping: DataFrame | None = None) -> DataFrame:
    """Department rows -> region rows; unweighted mean of the department
    means and sum of their counts.  Unmapped departments are dropped."""
    mapped = map_dept_region(df, mapping, code=department, out=region)
    group = [region] + [k for k in keys if k in df.columns]
    aggs = [F.avg(value).alias(value)]
    if count in df.columns:
        aggs.append(F.sum(count).alias(count))
    return mapped.groupBy(*group).agg(*aggs)


def national_evolution(df: DataFrame, *, date: str = "date",
                       value: str = "mean_price") -> DataFrame:
    """Unweighted mean per date, in date order."""
    return df.groupBy(date).agg(F.avg(value).alias(value)).orderBy(F.col(date).asc_nulls_first())


def kpi_cards(df: DataFrame, *, value: str = "mean_price",
              area: str | None = None) -> DataFrame:
    """Mean, min and max of the slice and its number of areas: its rows, or
    the distinct values of ``area`` where a slice has several rows for one."""
    n = F.count(F.lit(1)) if area is None else F.count_distinct(area)
    return df.agg(F.avg(value).alias("avg_price"), F.min(value).alias("min_price"),
                  F.max(value).alias("max_price"), n.alias("n_areas"))


def overview_means(df: DataFrame, products: Sequence[str]) -> DataFrame:
    """Unweighted mean over the regions of each product's mean."""
    cols = [mean_col(p) for p in products if mean_col(p) in df.columns]
    return df.agg(*[F.avg(c).alias(c) for c in cols])


def product_summary(df: DataFrame, products: Sequence[str], *,
                    labels: dict | None = None) -> DataFrame:
    """Min / max / mean / sample stddev of each product's regional means,
    one row per product (label upper-cased)."""
    labels = {p: p.upper() for p in products} if labels is None else labels
    long = mart_long(df, products, ids=[], labels=labels, variable="carburant",
                     value="prix")
    return long.groupBy("carburant").agg(
        F.min("prix").alias("prix_min"), F.max("prix").alias("prix_max"),
        F.avg("prix").alias("prix_moyen"), F.stddev_samp("prix").alias("ecart_type"))


def national_deviation(df: DataFrame, product: str, *, code: str = "region_code",
                       other: str = "99") -> DataFrame:
    """Each region's gap to the unweighted national mean of ``{p}_moyen``.

    The mean spans every region (the catch-all one included); the catch-all
    region is hidden afterwards; sorted by the gap.
    """
    c = mean_col(product)
    nat = scalar_struct(df.agg(F.avg(c).alias("moyenne_nationale")))
    out = df.select("*", nat["moyenne_nationale"].alias("moyenne_nationale"))
    out = out.select("*", (F.col(c) - F.col("moyenne_nationale")).alias("ecart"))
    out = out.withColumn("ecart_pct", F.try_divide(F.col("ecart"), F.col("moyenne_nationale")) * 100)
    return (out.filter(~F.col(code).eqNullSafe(F.lit(other)))
               .orderBy(F.col("ecart").asc_nulls_first(), F.col(code)))


def period_span(df: DataFrame, *, date: str = "prix_maj_date") -> DataFrame:
    """First and last date, and the dd/mm/yyyy text of each."""
    out = df.agg(F.min(date).alias("date_min"), F.max(date).alias("date_max"))
    return out.select("*", format_date_dmy("date_min").alias("date_min_text"),
                      format_date_dmy("date_max").alias("date_max_text"))


def first_last_change(df: DataFrame, products: Sequence[str], *,
                      date: str = "prix_maj_date") -> DataFrame:
    """Per product, value on the last date minus value on the first.

    First/last are by date (``min_by``/``max_by``), not by row order; the
    NULL-date group is ignored.
    """
    cols = [mean_col(p) for p in products if mean_col(p) in df.columns]
    long = df.select(date, F.explode(F.array(*[
        F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("v")) for c in cols
    ])).alias("m")).select(date, "m.*")
    d = F.col(date)
    out = long.filter(d.isNotNull()).groupBy("measure").agg(
        F.min(d).alias("first_date"), F.max(d).alias("last_date"),
        F.min_by("v", d).alias("first_value"), F.max_by("v", d).alias("last_value"))
    return out.withColumn("variation", F.col("last_value") - F.col("first_value"))


def histogram(df: DataFrame, value: str, *, bins: int = 20) -> DataFrame:
    """``bins`` equal-width bins over [min, max] (the maximum falls in the
    last bin), every bin listed (empty ones with 0), plus the overall mean.
    """
    v = F.col(value)
    st = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.avg(v).alias("mean"))
    st = scalar_struct(st.withColumn("width", (F.col("hi") - F.col("lo")) / bins))
    binned = (df.select(v.alias("_v")).filter(F.col("_v").isNotNull())
              .select(price_bin("_v", st["lo"], st["width"], bins).alias("bin")))
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (all_bins.join(counts, "bin", "left")
            .select("bin",
                    (st["lo"] + F.col("bin") * st["width"]).alias("bin_start"),
                    (st["lo"] + (F.col("bin") + 1) * st["width"]).alias("bin_end"),
                    F.coalesce(F.col("n"), F.lit(0)).alias("n"),
                    st["mean"].alias("mean")))


def box_stats(df: DataFrame, value: str, *, group: str = "region_name") -> DataFrame:
    """Min, quartiles, median and max per group (exact, distributed).  The
    two columns are written once; all statistics read them there."""
    df = materialize(df.select(group, value).filter(F.col(value).isNotNull()), "box-values")
    q = exact_quantiles(df, value, [0.25, 0.5, 0.75], groups=[group],
                        names=["q1", "median", "q3"])
    mm = df.groupBy(group).agg(
        F.min(value).alias("min"), F.max(value).alias("max"),
        F.count(F.lit(1)).alias("n"))
    return _join_ns(mm, q, [group], how="left").select(group, "min", "q1", "median", "q3",
                                                       "max", "n")


def price_scale(df: DataFrame, value: str = "mean_price", *, low: float = 0.05,
                high: float = 0.95) -> DataFrame:
    """Colour scale from the 5th to the 95th percentile (linear
    interpolation), five ticks, the range, the mean and the row count."""
    q = exact_quantiles(df, value, [low, high], names=["vmin", "vmax"])
    st = scalar_struct(df.agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n")))
    out = q.select("*", st["mean"].alias("mean"), st["n"].alias("n"))
    rng = F.col("vmax") - F.col("vmin")
    ticks = [(F.col("vmin") + rng * (k / 4.0)).alias(f"tick_{k + 1}") for k in range(5)]
    return out.select("vmin", "vmax", rng.alias("price_range"), *ticks, "mean", "n")


def distinct_areas(df: DataFrame, area: str = "departement") -> DataFrame:
    """Number of distinct non-NULL areas."""
    return df.agg(F.count_distinct(area).alias("n_distinct"))
