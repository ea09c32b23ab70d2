"""End-to-end queries (E1-E3) over the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import clean, marts
from ..session import scratch_path
from ..sources import files
from . import bindings as B
from . import pipeline
from .catalog import register
from .queries_core import FULL_DOUBLES, _full_stats_sql
from .queries_dashboard import LABELS, PRODUCT, YEAR, _areas, nation_dim
from .queries_features import BOUNDS_SQL, FEAT_PART
from .sqltext import csv, rnd

P = B.PRODUCTS
RUN_TS = "2025-06-30T08:00:00"
RUN_DATE = "2025-06-30"
LO, HI = B.VALID_RANGE

VALID_WIDE_SQL = B.OBS_LONG_SQL + f""",
obs_valid AS (
  SELECT * REPLACE (CASE WHEN prix_valeur > {LO} AND prix_valeur < {HI} THEN prix_valeur END
                    AS prix_valeur)
  FROM obs_long)""" + B.wide_sql("obs_valid", "obs_wide")

DETAILED_COLS = (list(B.WIDE_KEYS) + list(P) + ["prix_moyen_station"]
                 + [f"{p}_moy_region" for p in P]
                 + [c for p in P for c in (f"{p}_diff_region", f"{p}_pct_vs_region")]
                 + [f"competitive_{p}" for p in B.FLAGGED]
                 + ["competitivity_score", f"{B.HEADLINE}_evolution"]
                 + [f"is_outlier_{p}" for p in P]
                 + ["has_any_anomaly", "processing_timestamp", "processing_date"])
DETAILED_DOUBLES = (list(P) + ["prix_moyen_station"] + [f"{p}_moy_region" for p in P]
                    + [c for p in P for c in (f"{p}_diff_region", f"{p}_pct_vs_region")]
                    + [f"{B.HEADLINE}_evolution"])

DETAILED_SQL = (VALID_WIDE_SQL + FEAT_PART + BOUNDS_SQL + """,
det AS (
  SELECT f.*,
    """ + rnd("(" + " + ".join(f"f.{p}" for p in P) + f") / {len(P)}", 3) + """ AS prix_moyen_station,
    """ + csv(f"coalesce(f.{p}_diff_region < 0, false) AS competitive_{p}" for p in B.FLAGGED) + """,
    (""" + " + ".join(f"CASE WHEN f.{p}_diff_region < 0 THEN 1 ELSE 0 END" for p in P) + """)
      AS competitivity_score,
    f.""" + B.HEADLINE + " - lag(f." + B.HEADLINE + """) OVER (PARTITION BY f.id
      ORDER BY f.prix_maj_date, f.departement, f.region_code, f.annee) AS """
    + B.HEADLINE + """_evolution,
    """ + csv(f"coalesce(f.{p} < b.{p}_lower OR f.{p} > b.{p}_upper, false) AS is_outlier_{p}"
              for p in P) + """,
    (""" + " OR ".join(f"coalesce(f.{p} < b.{p}_lower OR f.{p} > b.{p}_upper, false)"
                       for p in P) + f""") AS has_any_anomaly,
    '{RUN_TS}' AS processing_timestamp, DATE '{RUN_DATE}' AS processing_date
  FROM feat f CROSS JOIN bounds b)""")


def detailed(spark, sf):
    long = clean.validate_range(B.obs_long(spark, sf), "prix_valeur", low=LO, high=HI)
    return pipeline.detailed_table(long, raw_products=B.RAW_PRODUCTS, products=P,
                                   flagged=B.FLAGGED, order=B.ORDER, keys=B.WIDE_KEYS,
                                   run_ts=RUN_TS, run_date=RUN_DATE)


@register("pipeline_detailed",
          f"WITH {DETAILED_SQL} SELECT {csv(DETAILED_COLS)} FROM det",
          doubles=DETAILED_DOUBLES)
def q_pipeline_detailed(spark, sf):
    return detailed(spark, sf).select(*DETAILED_COLS)


@register("pipeline_marts",
          f"WITH {VALID_WIDE_SQL} SELECT region_code, {_full_stats_sql()} FROM obs_wide "
          "GROUP BY region_code",
          doubles=FULL_DOUBLES)
def q_pipeline_marts(spark, sf):
    # Write the detailed table partitioned, re-read it, build the marts
    base = scratch_path(spark, f"roundtrip/pipeline-{uuid.uuid4().hex}")
    files.write_table(detailed(spark, sf), f"{base}/detailed",
                      partition_by=list(pipeline.DETAILED_PARTITIONS))
    back = files.scan_parquet(spark, f"{base}/detailed",
                              string_partitions=pipeline.DETAILED_PARTITIONS)
    m = marts.build_marts(back, P, headline=B.HEADLINE, tiebreak=["id", "prix_maj_date"])
    paths = files.write_marts(m, f"{base}/aggregations")
    return files.scan_parquet(spark, paths["by_region"])


_MAP_SQL = (B.OBS_WIDE_SQL + """,
by_dd AS (SELECT departement, region_code, prix_maj_date AS date, """
            + csv([f"avg({p}) AS {p}_moyen" for p in P] + ["count(*) AS nombre_stations"])
            + f""" FROM obs_wide GROUP BY departement, region_code, prix_maj_date),
yr AS (SELECT * FROM by_dd WHERE date >= DATE '{YEAR}-01-01' AND date < DATE '{YEAR + 1}-01-01'),
sl0 AS (SELECT departement, nombre_stations, date, economy_moyen AS mean_price FROM yr
        WHERE economy_moyen IS NOT NULL),
sl AS (SELECT * FROM sl0 WHERE date = (SELECT max(date) FROM sl0)),
sc AS (SELECT quantile_cont(mean_price, 0.05) AS vmin, quantile_cont(mean_price, 0.95) AS vmax
       FROM sl),
areas AS (SELECT n_name AS departement FROM nation)""")


@register("pipeline_map",
          f"WITH {_MAP_SQL} SELECT a.departement, s.mean_price, s.nombre_stations, "
          "s.mean_price IS NOT NULL AS has_data, CASE WHEN s.mean_price IS NULL OR "
          "sc.vmax <= sc.vmin THEN NULL ELSE greatest(0.0, least(1.0, (s.mean_price - sc.vmin) "
          "/ (sc.vmax - sc.vmin))) END AS band "
          "FROM areas a LEFT JOIN sl s ON a.departement = s.departement CROSS JOIN sc",
          doubles=["mean_price", "band"])
def q_pipeline_map(spark, sf):
    dd = marts.agg_by_department_date(B.obs_wide(spark, sf), P)
    out = pipeline.map_slice(dd, P, year=YEAR, product_label=PRODUCT, labels=LABELS,
                             areas=_areas(spark, sf))
    return out["table"]


@register("pipeline_map_kpi",
          f"WITH {_MAP_SQL} SELECT avg(mean_price) AS avg_price, min(mean_price) AS min_price, "
          "max(mean_price) AS max_price, count(*) AS n_areas FROM sl",
          doubles=["avg_price", "min_price", "max_price"])
def q_pipeline_map_kpi(spark, sf):
    dd = marts.agg_by_department_date(B.obs_wide(spark, sf), P)
    return pipeline.map_slice(dd, P, year=YEAR, product_label=PRODUCT, labels=LABELS)["kpi"]


@register("pipeline_map_region",
          f"WITH {_MAP_SQL}, ndim AS (SELECT n_name AS departement, "
          "CAST(n_regionkey AS VARCHAR) AS region FROM nation), "
          "rl AS (SELECT n.region, y.date, avg(y.economy_moyen) AS mean_price, "
          "CAST(sum(y.nombre_stations) AS BIGINT) AS nombre_stations FROM yr y JOIN ndim n "
          "ON y.departement = n.departement WHERE y.economy_moyen IS NOT NULL "
          "GROUP BY n.region, y.date) "
          "SELECT region, date, 'ECONOMY' AS fuel_type, mean_price, nombre_stations FROM rl "
          "WHERE date = (SELECT max(date) FROM rl)",
          doubles=["mean_price"])
def q_pipeline_map_region(spark, sf):
    dd = marts.agg_by_department_date(B.obs_wide(spark, sf), P)
    out = pipeline.map_slice(dd, P, year=YEAR, product_label=PRODUCT, labels=LABELS,
                             level="region", mapping=nation_dim(spark, sf))
    return out["slice"].select("region", "date", "fuel_type", "mean_price", "nombre_stations")
