"""Dashboard filters, projections and display formats."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions.columns import format_date_dmy, format_price, tidy_label
from ..functions.sizing import broadcast_if_small, materialize


def filter_year(df: DataFrame, year: int, *, date: str = "date") -> DataFrame:
    """Non-NULL dates of one year, as a date range so Parquet row-group
    statistics (and date partitions) prune the scan."""
    lo = F.make_date(F.lit(year), F.lit(1), F.lit(1))
    hi = F.make_date(F.lit(year + 1), F.lit(1), F.lit(1))
    return df.filter((F.col(date) >= lo) & (F.col(date) < hi))


def filter_product(df: DataFrame, product: str, *, column: str = "fuel_type") -> DataFrame:
    """Rows of one product."""
    return df.filter(F.col(column) == F.lit(product))


def latest_slice(df: DataFrame, *, product: str = "fuel_type", date: str = "date",
                 once: bool = True) -> DataFrame:
    """For every product, the rows on that product's latest date.

    An aggregate (one row per product) joined back - combined map-side,
    then broadcast after a row-count check, so the rows are not shuffled.
    The rows are read twice, so they are first written once (``once=False``
    for a table that lies in files already).
    """
    df = materialize(df, "latest-rows") if once else df
    latest = df.groupBy(product).agg(F.max(date).alias("__latest"))
    latest = broadcast_if_small(latest.select(F.col(product).alias("__p"), "__latest"))
    return (df.join(latest, (F.col(product) == F.col("__p")) & (F.col(date) == F.col("__latest")))
              .drop("__p", "__latest"))


def exclude_other(df: DataFrame, *, code: str = "region_code",
                  other: str = schema.OTHER_REGION) -> DataFrame:
    """Drop the catch-all region (NULL codes are kept)."""
    return df.filter(~F.col(code).eqNullSafe(F.lit(other)))


def filter_regions(df: DataFrame, codes: Iterable[str], *, code: str = "region_code") -> DataFrame:
    """Region IN-list (an empty or missing list keeps everything)."""
    codes = list(codes or [])
    return df.filter(F.col(code).isin(codes)) if codes else df


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows lacking any of ``columns`` (coordinates, weight)."""
    cond = None
    for c in columns:
        e = F.col(c).isNotNull()
        cond = e if cond is None else cond & e
    return df.filter(cond)


def filter_anomalies(df: DataFrame, *, flag: str = "has_any_anomaly") -> DataFrame:
    """P20: flagged rows only."""
    return df.filter(F.col(flag))


def tidy_labels(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """``gazole_moyen`` (or ``avg_gazole``) -> ``GAZOLE``."""
    return df.withColumn(out or column, tidy_label(column))


def project_rename(df: DataFrame, columns: dict | Sequence) -> DataFrame:
    """Select, rename and reorder in one projection.

    ``columns`` is ``{old: new}`` (insertion order = output order) or a list
    of names."""
    if isinstance(columns, dict):
        return df.select(*[F.col(o).alias(n) for o, n in columns.items()])
    return df.select(*columns)


def format_prices(df: DataFrame, columns: Sequence[str], *, decimals: int = 3,
                  unit: str = "€", dates: Sequence[str] = ()) -> DataFrame:
    """Prices as ``1.234 €`` (``-`` when missing), dates as dd/MM/yyyy."""
    out = df
    for c in columns:
        if c in out.columns:
            out = out.withColumn(c, format_price(c, decimals, unit))
    for d in dates:
        if d in out.columns:
            out = out.withColumn(d, format_date_dmy(d))
    return out
