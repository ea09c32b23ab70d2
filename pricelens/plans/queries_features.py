"""Queries for derived features (F1-F7) and anomaly detection (A1-A5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import anomaly, features
from ..operators.lookups import lookup_region_name
from . import bindings as B
from .catalog import register
from .sqltext import csv, rnd

P = B.PRODUCTS
KEYS = list(B.WIDE_KEYS)
KEYS_SQL = csv(KEYS)

FEAT_PART = """,
means AS (
  SELECT region_code, """ + csv(f"{rnd(f'avg({p})', 3)} AS {p}_moy_region" for p in P) + """
  FROM obs_wide GROUP BY region_code),
feat AS (
  SELECT w.*, """ + csv(f"m.{p}_moy_region" for p in P) + ", " + csv(
    f"{rnd(f'w.{p} - m.{p}_moy_region', 3)} AS {p}_diff_region, "
    f"{rnd(f'((w.{p} - m.{p}_moy_region) / NULLIF(m.{p}_moy_region, 0)) * 100', 2)} "
    f"AS {p}_pct_vs_region" for p in P) + """
  FROM obs_wide w LEFT JOIN means m ON w.region_code IS NOT DISTINCT FROM m.region_code)"""
FEAT_SQL = B.OBS_WIDE_SQL + FEAT_PART

BOUNDS_SQL = """,
quart AS (
  SELECT """ + csv(f"quantile_cont({p}, 0.25) AS {p}_q1, quantile_cont({p}, 0.75) AS {p}_q3"
                   for p in P) + """
  FROM obs_wide),
bounds AS (
  SELECT *, """ + csv(f"{p}_q1 - 1.5 * ({p}_q3 - {p}_q1) AS {p}_lower, "
                      f"{p}_q3 + 1.5 * ({p}_q3 - {p}_q1) AS {p}_upper" for p in P) + """
  FROM quart)"""

FLAGS_SQL = B.OBS_WIDE_SQL + BOUNDS_SQL + """,
flags AS (
  SELECT w.*, """ + csv(f"coalesce(w.{p} < b.{p}_lower OR w.{p} > b.{p}_upper, false) "
                        f"AS is_outlier_{p}" for p in P) + """
  FROM obs_wide w CROSS JOIN bounds b),
anom AS (
  SELECT *, (""" + " OR ".join(f"is_outlier_{p}" for p in P) + """) AS has_any_anomaly
  FROM flags)"""


def wide(spark, sf):
    return B.obs_wide(spark, sf)


@register("row_mean",
          f"WITH {B.OBS_WIDE_SQL} SELECT {KEYS_SQL}, "
          f"{rnd('(' + ' + '.join(P) + f') / {len(P)}', 3)} AS prix_moyen_station FROM obs_wide",
          doubles=["prix_moyen_station"])
def q_row_mean(spark, sf):
    return features.row_mean(wide(spark, sf), P).select(*KEYS, "prix_moyen_station")


_AVAIL_N = " + ".join(f"CAST({p} IS NOT NULL AS INTEGER)" for p in P)
_AVAIL_S = " + ".join(f"coalesce({p}, 0.0)" for p in P)


@register("row_mean_available",
          f"WITH {B.OBS_WIDE_SQL} SELECT {KEYS_SQL}, "
          f"{rnd(f'({_AVAIL_S}) / NULLIF({_AVAIL_N}, 0)', 3)} AS prix_moyen_disponible "
          "FROM obs_wide",
          doubles=["prix_moyen_disponible"])
def q_row_mean_available(spark, sf):
    return features.row_mean_available(wide(spark, sf), P).select(*KEYS, "prix_moyen_disponible")


def _grouped(spark, sf):
    return features.group_compare(wide(spark, sf), P, group=["region_code"])


@register("group_mean",
          f"WITH {FEAT_SQL} SELECT {KEYS_SQL}, " + csv(f"{p}_moy_region" for p in P) + " FROM feat",
          doubles=[f"{p}_moy_region" for p in P])
def q_group_mean(spark, sf):
    return _grouped(spark, sf).select(*KEYS, *[f"{p}_moy_region" for p in P])


@register("group_diff",
          f"WITH {FEAT_SQL} SELECT {KEYS_SQL}, " + csv(f"{p}_diff_region" for p in P) + " FROM feat",
          doubles=[f"{p}_diff_region" for p in P])
def q_group_diff(spark, sf):
    return _grouped(spark, sf).select(*KEYS, *[f"{p}_diff_region" for p in P])


@register("group_pct",
          f"WITH {FEAT_SQL} SELECT {KEYS_SQL}, " + csv(f"{p}_pct_vs_region" for p in P) + " FROM feat",
          doubles=[f"{p}_pct_vs_region" for p in P])
def q_group_pct(spark, sf):
    return _grouped(spark, sf).select(*KEYS, *[f"{p}_pct_vs_region" for p in P])


@register("competitive_flag",
          f"WITH {FEAT_SQL} SELECT {KEYS_SQL}, "
          + csv(f"coalesce({p}_diff_region < 0, false) AS competitive_{p}" for p in B.FLAGGED)
          + " FROM feat")
def q_competitive_flag(spark, sf):
    out = features.competitive_flags(_grouped(spark, sf), B.FLAGGED)
    return out.select(*KEYS, *[f"competitive_{p}" for p in B.FLAGGED])


@register("competitive_score",
          f"WITH {FEAT_SQL} SELECT {KEYS_SQL}, ("
          + " + ".join(f"CASE WHEN {p}_diff_region < 0 THEN 1 ELSE 0 END" for p in P)
          + ") AS competitivity_score FROM feat")
def q_competitive_score(spark, sf):
    return features.competitive_score(_grouped(spark, sf), P).select(*KEYS, "competitivity_score")


@register("lag_change",
          f"WITH {B.OBS_WIDE_SQL} SELECT {KEYS_SQL}, {B.HEADLINE} - lag({B.HEADLINE}) OVER "
          "(PARTITION BY id ORDER BY prix_maj_date, departement, region_code) AS economy_evolution "
          "FROM obs_wide",
          doubles=["economy_evolution"])
def q_lag_change(spark, sf):
    out = features.lag_change(wide(spark, sf), B.HEADLINE, entity="id",
                              order=["prix_maj_date"], tiebreak=["departement", "region_code"])
    return out.select(*KEYS, "economy_evolution")


@register("iqr_bounds",
          f"WITH {B.OBS_WIDE_SQL}{BOUNDS_SQL} SELECT * FROM bounds",
          doubles=[f"{p}_{s}" for p in P for s in ("q1", "q3", "lower", "upper")])
def q_iqr_bounds(spark, sf):
    return anomaly.iqr_bounds(wide(spark, sf), P, method="exact")


_DISC = csv(f"quantile_disc({p}, {q}) AS {p}_q{n}" for p in P for q, n in ((0.25, 1), (0.75, 3)))


@register("iqr_bounds_approx",
          f"WITH {B.OBS_WIDE_SQL}, q AS (SELECT {_DISC} FROM obs_wide) SELECT "
          + csv(f"{p}_q1, {p}_q3, {p}_q1 - 1.5 * ({p}_q3 - {p}_q1) AS {p}_lower, "
                f"{p}_q3 + 1.5 * ({p}_q3 - {p}_q1) AS {p}_upper" for p in P) + " FROM q",
          doubles=[f"{p}_{s}" for p in P for s in ("q1", "q3", "lower", "upper")])
def q_iqr_bounds_approx(spark, sf):
    # at this accuracy the sketch holds every value of a table this size, so it
    # is the discrete quantile; its error at lower accuracy is tested by rank
    return anomaly.iqr_bounds(wide(spark, sf), P, method="approx", accuracy=1_000_000)


@register("outlier_flag",
          f"WITH {FLAGS_SQL} SELECT {KEYS_SQL}, " + csv(f"is_outlier_{p}" for p in P) + " FROM flags")
def q_outlier_flag(spark, sf):
    w = wide(spark, sf)
    out = anomaly.outlier_flags(w, anomaly.iqr_bounds(w, P), P)
    return out.select(*KEYS, *[f"is_outlier_{p}" for p in P])


@register("any_anomaly",
          f"WITH {FLAGS_SQL} SELECT {KEYS_SQL}, has_any_anomaly FROM anom")
def q_any_anomaly(spark, sf):
    return anomaly.detect_anomalies(wide(spark, sf), P).select(*KEYS, "has_any_anomaly")


_RATE_ROWS = " UNION ALL ".join(
    [f"SELECT '{p}' AS product, count(*) FILTER (WHERE is_outlier_{p}) AS n_outliers, count(*) AS n_rows FROM anom"
     for p in P]
    + ["SELECT 'any' AS product, count(*) FILTER (WHERE has_any_anomaly) AS n_outliers, count(*) AS n_rows FROM anom"])


@register("outlier_rate",
          f"WITH {FLAGS_SQL} SELECT product, n_outliers, n_rows, "
          "CASE WHEN n_rows > 0 THEN n_outliers * 100.0 / n_rows ELSE 0.0 END AS pct_outliers "
          f"FROM ({_RATE_ROWS}) r",
          doubles=["pct_outliers"])
def q_outlier_rate(spark, sf):
    return anomaly.outlier_rate(anomaly.detect_anomalies(wide(spark, sf), P))


def region_dim(spark, sf):
    """Region names of the driver tables, keyed like ``region_code``."""
    r = B.table(spark, sf, "region")
    return r.select(F.col("r_regionkey").cast("string").alias("region_code"),
                    F.col("r_name").alias("region_name"))


REGION_DIM_SQL = "SELECT CAST(r_regionkey AS VARCHAR) AS region_code, r_name AS region_name FROM region"


@register("anomalies_by_region",
          f"WITH {FLAGS_SQL} SELECT coalesce(d.region_name, 'Inconnu') AS region_name, "
          "count(*) FILTER (WHERE a.has_any_anomaly) AS n_anomalies "
          f"FROM anom a LEFT JOIN ({REGION_DIM_SQL}) d ON a.region_code = d.region_code "
          "GROUP BY coalesce(d.region_name, 'Inconnu')")
def q_anomalies_by_region(spark, sf):
    flagged = anomaly.detect_anomalies(wide(spark, sf), P)
    named = lookup_region_name(flagged, region_dim(spark, sf))
    return anomaly.anomalies_by_region(named)
