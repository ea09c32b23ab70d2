"""Aggregate marts (G1-G6) and run-level statistics."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import mean_col

COUNT_COL = "nombre_stations"


def present(df: DataFrame, products: Sequence[str]) -> list:
    return [p for p in products if p in df.columns]


def price_stats(products: Sequence[str], full: bool = True) -> list:
    """avg (+ min, max, sample stddev) per product, then ``count(*)``.

    ``count(*)`` counts wide rows (entity x date x attributes), not distinct
    entities, as in the published marts.
    """
    aggs = []
    for p in products:
        aggs.append(F.avg(p).alias(mean_col(p)))
        if full:
            aggs += [F.min(p).alias(f"{p}_min"), F.max(p).alias(f"{p}_max"),
                     F.stddev_samp(p).alias(f"{p}_stddev")]
    aggs.append(F.count(F.lit(1)).alias(COUNT_COL))
    return aggs


def agg_by_region(df: DataFrame, products: Sequence[str], *,
                  region: str = "region_code") -> DataFrame:
    """G1: full price statistics per region."""
    return df.groupBy(region).agg(*price_stats(present(df, products)))


def agg_by_department(df: DataFrame, products: Sequence[str], *,
                      department: str = "departement",
                      region: str = "region_code") -> DataFrame:
    """Full price statistics per (department, region)."""
    return df.groupBy(department, region).agg(*price_stats(present(df, products)))


def agg_by_date(df: DataFrame, products: Sequence[str], *,
                date: str = "prix_maj_date") -> DataFrame:
    """Mean price per product and row count per date (NULL date is a group)."""
    return df.groupBy(date).agg(*price_stats(present(df, products), full=False))


def agg_by_department_date(df: DataFrame, products: Sequence[str], *,
                           department: str = "departement",
                           region: str = "region_code",
                           date: str = "prix_maj_date",
                           date_out: str = "date") -> DataFrame:
    """Mean price per (department, region, date); date column renamed."""
    out = df.groupBy(department, region, date).agg(
        *price_stats(present(df, products), full=False))
    return out.withColumnRenamed(date, date_out)


def agg_by_year(df: DataFrame, products: Sequence[str], *,
                year: str = "annee") -> DataFrame:
    """Mean price per year, sorted by year."""
    return (df.groupBy(year).agg(*price_stats(present(df, products), full=False))
            .orderBy(F.col(year).asc_nulls_first()))


def agg_by_department_year(df: DataFrame, products: Sequence[str], *,
                           department: str = "departement",
                           region: str = "region_code",
                           year: str = "annee") -> DataFrame:
    """Mean price per (department, region, year), sorted."""
    return (df.groupBy(department, region, year)
            .agg(*price_stats(present(df, products), full=False))
            .orderBy(F.col(department).asc_nulls_first(), F.col(year).asc_nulls_first()))


def _rolled_up(products: Sequence[str], full: bool) -> list:
    """Statistics of a coarser group from those of its parts: squared deviations
    add up with those of the parts' means from the common mean."""
    out = []
    for p in products:
        n, total = F.sum(f"{p}_n"), F.sum(f"{p}_sum")
        out.append(F.try_divide(total, n).alias(mean_col(p)))
        if full:
            part = F.try_divide(F.col(f"{p}_sum") * F.col(f"{p}_sum"), F.col(f"{p}_n"))
            between = F.sum(part) - F.try_divide(total * total, n)
            dev = F.sum(f"{p}_dev") + F.greatest(between, F.lit(0.0))
            out += [F.min(f"{p}_min").alias(f"{p}_min"), F.max(f"{p}_max").alias(f"{p}_max"),
                    F.when(n > 1, F.sqrt(dev / (n - 1))).alias(f"{p}_stddev")]
    return out


def fine_state(df: DataFrame, products: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The state that G1-G6 roll up from, at the finest grain ``keys``: rows, and for
    each product count, sum, minimum, maximum and squared deviations.  States of
    disjoint sets of rows add up (``marts_of`` takes them united)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(COUNT_COL), *[
        a for p in products for a in (
            F.count(p).alias(f"{p}_n"), F.sum(p).alias(f"{p}_sum"), F.min(p).alias(f"{p}_min"),
            F.max(p).alias(f"{p}_max"), (F.var_pop(p) * F.count(p)).alias(f"{p}_dev"))])


def marts_of(fine: DataFrame, products: Sequence[str], *, department: str = "departement",
             region: str = "region_code", date: str = "prix_maj_date", year: str = "annee") -> dict:
    """G1-G6 from ``fine_state`` rows, any number for each of its keys."""
    sets = {"by_region": [region], "by_departement": [department, region]}
    if date in fine.columns:
        sets["by_date"] = [date]
        sets["by_departement_date"] = [department, region, date]
    if year in fine.columns:
        sets["by_year"] = [year]
        sets["by_departement_year"] = [department, region, year]
    out = {}
    for name, keys in sets.items():
        full = name in ("by_region", "by_departement")
        m = fine.groupBy(*keys).agg(*_rolled_up(products, full), F.sum(COUNT_COL).alias(COUNT_COL))
        if name == "by_departement_date":
            m = m.withColumnRenamed(date, "date")
        elif name == "by_year":
            m = m.orderBy(F.col(year).asc_nulls_first())
        elif name == "by_departement_year":
            m = m.orderBy(F.col(department).asc_nulls_first(), F.col(year).asc_nulls_first())
        out[name] = m
    return out


def grouped_marts(df: DataFrame, products: Sequence[str], *,
                  department: str = "departement", region: str = "region_code",
                  date: str = "prix_maj_date", year: str = "annee",
                  materialized: bool = True) -> dict:
    """G1-G6 in one pass over the detailed table.

    One aggregate at the finest grain (department, region, date, year) keeps
    count, sum, minimum, maximum and the squared deviations of each product; it
    is combined map-side, as small as the largest mart, and written once.  All
    six marts are rolled up from it, so the detailed rows are read and
    aggregated once and not copied for every grouping.
    """
    ps = present(df, products)
    fine = fine_state(df, ps, [c for c in (department, region, date, year) if c in df.columns])
    if materialized:
        from ..functions.sizing import materialize
        fine = materialize(fine, "marts")
    return marts_of(fine, ps, department=department, region=region, date=date, year=year)


def build_marts(df: DataFrame, products: Sequence[str], *,
                entity: str = "id", department: str = "departement",
                region: str = "region_code", date: str = "prix_maj_date",
                year: str = "annee", headline: str | None = None,
                extra_cols: Sequence[str] = (), top_n: int = 10,
                tiebreak: Sequence[str] = (), single_pass: bool = True) -> dict:
    """E2 core: the eight marts as a name -> DataFrame dict.

    ``single_pass`` rolls G1-G6 up from one fine aggregate (written once);
    otherwise six lazy ``groupBy``s.
    """
    from .ranking import bottom_n_per_group, top_n_per_group

    if single_pass:
        marts = grouped_marts(df, products, department=department, region=region,
                              date=date, year=year)
    else:
        marts = {
            "by_region": agg_by_region(df, products, region=region),
            "by_departement": agg_by_department(df, products, department=department,
                                                region=region),
        }
        if date in df.columns:
            marts["by_date"] = agg_by_date(df, products, date=date)
            marts["by_departement_date"] = agg_by_department_date(
                df, products, department=department, region=region, date=date)
        if year in df.columns:
            marts["by_year"] = agg_by_year(df, products, year=year)
            marts["by_departement_year"] = agg_by_department_year(
                df, products, department=department, region=region, year=year)
    headline = headline or (present(df, products) or [None])[0]
    if headline and headline in df.columns:
        cols = [entity, *extra_cols, department, region, headline]
        marts["most_expensive"] = top_n_per_group(
            df, group=region, value=headline, n=top_n, columns=cols, tiebreak=tiebreak)
        marts["least_expensive"] = bottom_n_per_group(
            df, group=region, value=headline, n=top_n, columns=cols, tiebreak=tiebreak)
    return marts


def run_summary(df: DataFrame, *, region: str = "region_code",
                department: str = "departement", year: str = "annee",
                anomaly: str = "has_any_anomaly") -> DataFrame:
    """One-row run summary in a single aggregate.

    Distinct counts treat NULL as one more value (as ``distinct().count()``
    does); years are counted without NULL.
    """
    def distinct_with_null(c):
        return (F.count_distinct(c)
                + F.max(F.when(F.col(c).isNull(), 1).otherwise(0))).cast("long")

    aggs = [F.count(F.lit(1)).alias("total_rows"),
            distinct_with_null(region).alias("n_regions"),
            distinct_with_null(department).alias("n_departements")]
    if year in df.columns:
        aggs += [F.min(year).alias("first_year"), F.max(year).alias("last_year"),
                 F.count_distinct(year).alias("n_years")]
    if anomaly in df.columns:
        aggs.append(F.count_if(F.col(anomaly)).alias("n_anomalies"))
    return df.agg(*aggs)


def summary_metrics(df: DataFrame, *, region: str = "region_code", department: str = "departement",
                    year: str = "annee", anomaly: str = "has_any_anomaly") -> list[Column]:
    """G7 as aggregates without distinct counts, for the write that passes the rows
    on: the codes of regions and departments and the years are fixed domains, so
    their sets are small."""
    def values(c):
        return F.size(F.collect_set(F.coalesce(F.col(c).cast("string"), F.lit("-")))).cast("long")

    out = [F.count(F.lit(1)).alias("total_rows"), values(region).alias("n_regions"),
           values(department).alias("n_departements")]
    if year in df.columns:
        out += [F.min(year).alias("first_year"), F.max(year).alias("last_year"),
                F.size(F.collect_set(year)).cast("long").alias("n_years")]
    if anomaly in df.columns:
        out.append(F.count_if(F.col(anomaly)).alias("n_anomalies"))
    return out


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count/mean/stddev/min/max per column, one row per column.

    One aggregate over all columns (a single scan), then ``stack`` to long.
    """
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"),
                 F.col(f"{c}__count").alias("count"),
                 F.col(f"{c}__mean").alias("mean"),
                 F.col(f"{c}__stddev").alias("stddev"),
                 F.col(f"{c}__min").alias("min"),
                 F.col(f"{c}__max").alias("max"))
        for c in columns]))
    return wide.select(rows.alias("s")).select("s.*")


def table_profile(df: DataFrame, name: str = "table") -> DataFrame:
    """Row count, column count, column names and schema as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"),
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(", ".join(df.columns)).alias("columns"),
        F.lit(df.schema.simpleString()).alias("schema"))
