"""Cleaning of landed observations.

Each step is a projection or filter; the composite ``clean_observations``
is one narrow stage (no shuffle) apart from the tiny broadcast join that
maps departments to regions.
"""

from __future__ import annotations

import logging
from datetime import datetime
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions.columns import normalized_name, pad_code
from ..functions.dims import department_region_df

log = logging.getLogger(__name__)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trim, spaces/hyphens -> ``_``, lower case; raise on a collision."""
    names = [normalized_name(c) for c in df.columns]
    seen = {}
    for old, new in zip(df.columns, names):
        if new in seen:
            raise ValueError(f"columns {seen[new]!r} and {old!r} both normalise to {new!r}")
        seen[new] = old
    return df.toDF(*names)


def require_keys(df: DataFrame, keys: Sequence[str] = ("id", "cp", "ville")) -> DataFrame:
    """Keep rows whose key columns are all non-NULL."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond) if cond is not None else df


def pad_column(df: DataFrame, column: str, width: int, out: str | None = None) -> DataFrame:
    """Zero-pad a code column to ``width`` (longer codes stay whole)."""
    return df.withColumn(out or column, pad_code(column, width))


def department_from_postal(postal) -> "F.Column":
    """Department of a 5-digit postal code: its first two characters, except
    Corsica ("20xxx"), whose department comes from the first three."""
    cp = F.col(postal) if isinstance(postal, str) else postal
    corsica = None
    for prefix, dept in schema.CORSICA_POSTAL_PREFIX.items():
        cond = F.substring(cp, 1, 3) == prefix
        corsica = F.when(cond, dept) if corsica is None else corsica.when(cond, dept)
    return corsica.otherwise(F.substring(cp, 1, 2))


def derive_department(df: DataFrame, *, postal: str = "cp", dep_code: str = "dep_code",
                      out: str = "departement") -> DataFrame:
    """Department from ``dep_code`` (padded to two characters,
    three-digit overseas codes kept) where the row has one, else from the
    postal code.  With an explicit read schema the optional column always
    exists, so the fallback is per row."""
    from_postal = department_from_postal(postal) if postal in df.columns else F.lit(None)
    if dep_code in df.columns:
        return df.withColumn(out, F.coalesce(pad_code(dep_code, 2), from_postal))
    return df.withColumn(out, from_postal.cast("string"))


def derive_region(df: DataFrame, *, department: str = "departement",
                  reg_code: str = "reg_code", out: str = "region_code",
                  default: str = schema.OTHER_REGION,
                  mapping: DataFrame | None = None) -> DataFrame:
    """P5: region from ``reg_code`` where the row has one, else from the
    department through the department -> region dimension (unknown ->
    ``default``).

    The dimension is a fixed 96-row table (or a caller-supplied one), so the
    lookup is a broadcast hash join: no shuffle of the observations.
    """
    m = mapping if mapping is not None else department_region_df(df.sparkSession)
    c0, c1 = m.columns[:2]
    m = m.select(F.col(c0).cast("string").alias("__dept"), F.col(c1).cast("string").alias("__reg"))
    joined = df.join(m, F.col(department) == F.col("__dept"), "left")
    given = F.col(reg_code).cast("string") if reg_code in df.columns else F.lit(None)
    return joined.withColumn(out, F.coalesce(given, F.col("__reg"), F.lit(default))) \
        .drop("__dept", "__reg")


def extract_geo(df: DataFrame, *, geom: str = "geom", lat: str = "lat", lon: str = "lon",
                lat_out: str = "latitude", lon_out: str = "longitude") -> DataFrame:
    """Struct fields to double columns (malformed -> NULL); a warning and
    no change when the struct column is absent."""
    if geom not in df.columns:
        log.warning("column %r not found: coordinates not extracted", geom)
        return df
    return (df.withColumn(lat_out, F.col(f"{geom}.{lat}").try_cast("double"))
              .withColumn(lon_out, F.col(f"{geom}.{lon}").try_cast("double")))


def validate_range(df: DataFrame, column: str = "prix_valeur", *, low: float = 0.0,
                   high: float = 5.0) -> DataFrame:
    """Keep the value iff ``low < v < high`` (after a tolerant cast to
    double), else NULL.  The row itself is kept."""
    if column not in df.columns:
        return df
    v = F.col(column).try_cast("double")
    return df.withColumn(column, F.when((v > low) & (v < high), v))


def parse_date_year(df: DataFrame, *, ts: str = "prix_maj", date_out: str = "prix_maj_date",
                    year_out: str = "annee", time_out: str = "prix_maj_ts") -> DataFrame:
    """Observation date (date part of an ISO timestamp text, malformed ->
    NULL), its year, and the moment itself (offsets applied), by which the
    pivot finds the latest observation."""
    if ts not in df.columns:
        return df
    d = F.col(ts).try_cast("date")
    return (df.withColumn(date_out, d).withColumn(year_out, F.year(F.col(date_out)))
              .withColumn(time_out, F.col(ts).try_cast("timestamp")))


def clean_metrics(df: DataFrame, keys: Sequence[str] = ("id", "cp", "ville")) -> list[Column]:
    """P9 as aggregates, for a scan or for the write that passes the rows on."""
    keep = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    corrupt = [F.count(schema.CORRUPT).alias("rows_corrupt")] if schema.CORRUPT in df.columns else []
    return [F.count(F.lit(1)).alias("rows_in"), F.count_if(keep).alias("rows_out"), *corrupt]


def removed(rows_in, rows_out) -> tuple:
    """(rows removed, percent) of the metrics, as numbers."""
    return rows_in - rows_out, ((rows_in - rows_out) * 100.0 / rows_in if rows_in else 0.0)


def clean_report(df: DataFrame, keys: Sequence[str] = ("id", "cp", "ville")) -> DataFrame:
    """Rows in, rows kept by P2, rows removed and removed percent - one
    aggregate over the input (no second scan of the cleaned table).  For a scan
    with the corrupt column ``rows_corrupt`` counts corrupt records; they are
    among the rows in and, having no keys, among the rows removed."""
    metrics = clean_metrics(df, keys)
    return df.agg(*metrics).select(
        "rows_in", "rows_out", *(["rows_corrupt"] if len(metrics) > 2 else []),
        (F.col("rows_in") - F.col("rows_out")).alias("rows_removed"),
        F.when(F.col("rows_in") > 0,
               (F.col("rows_in") - F.col("rows_out")) * 100.0 / F.col("rows_in"))
        .otherwise(F.lit(0.0)).alias("removed_pct"))


def stamp_processing(df: DataFrame, run_ts: str | None = None,
                     run_date: str | None = None) -> DataFrame:
    """P10: ``processing_timestamp`` (ISO text of the run) and
    ``processing_date``.  Both are fixed once per run, so every task and
    every retry writes the same values."""
    run_ts = run_ts or datetime.now().isoformat()
    date_col = F.lit(run_date).cast("date") if run_date else F.current_date()
    return (df.withColumn("processing_timestamp", F.lit(run_ts))
              .withColumn("processing_date", date_col))


def clean_observations(df: DataFrame, *, keys: Sequence[str] = ("id", "cp", "ville"),
                       postal: str = "cp", postal_width: int = 5,
                       price: str = "prix_valeur", low: float = 0.0, high: float = 5.0,
                       ts: str = "prix_maj") -> DataFrame:
    """P1-P8 in order: the long, cleaned observation table."""
    out = normalize_columns(df)
    out = require_keys(out, keys)
    if postal in out.columns:
        out = pad_column(out, postal, postal_width)
        out = derive_department(out, postal=postal)
    out = derive_region(out)
    out = extract_geo(out)
    out = validate_range(out, price, low=low, high=high)
    out = parse_date_year(out, ts=ts)
    return out
