"""Round-trip queries for scans and sinks.

Each writes the *whole* table to a fresh folder under the shared
checkpoint directory (``spark.checkpoint.dir``), reads it back with the
scan under test and returns the result; the oracle is the table itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import marts
from ..session import scratch_path
from ..sources import files, landing
from . import bindings as B
from .catalog import register
from .queries_core import FULL_DOUBLES, MEAN_DOUBLES, _full_stats_sql, _mean_sql

L = B.OBS_LONG_SQL
LONG_COLS = ["id", "departement", "region_code", "prix_nom", "prix_valeur",
             "prix_maj_date", "annee", "l_orderkey", "l_linenumber", "l_partkey"]
LONG_SCHEMA = ("id long, departement string, region_code string, prix_nom string, "
               "prix_valeur double, prix_maj_date date, annee int, l_orderkey long, "
               "l_linenumber int, l_partkey long")
LONG_SQL = f"WITH {L} SELECT {', '.join(LONG_COLS)} FROM obs_long"


def _fresh(spark, name: str) -> str:
    return scratch_path(spark, f"roundtrip/{name}-{uuid.uuid4().hex}")


def _long(spark, sf):
    return B.obs_long(spark, sf).select(*LONG_COLS)


@register("scan_json", LONG_SQL, doubles=["prix_valeur"])
def q_scan_json(spark, sf):
    path = _fresh(spark, "json")
    landing.write_json_array(_long(spark, sf), path)
    return files.scan_json(spark, path, LONG_SCHEMA, glob="part-*.txt")


@register("scan_jsonl", LONG_SQL, doubles=["prix_valeur"])
def q_scan_jsonl(spark, sf):
    path = _fresh(spark, "jsonl")
    files.write_table(_long(spark, sf), path, fmt="jsonl")
    return files.scan_jsonl(spark, path, LONG_SCHEMA)


@register("scan_csv", LONG_SQL, doubles=["prix_valeur"])
def q_scan_csv(spark, sf):
    path = _fresh(spark, "csv")
    files.write_table(_long(spark, sf), path, fmt="csv")
    return files.scan_csv(spark, path, LONG_SCHEMA)


@register("scan_parquet", LONG_SQL, doubles=["prix_valeur"])
def q_scan_parquet(spark, sf):
    path = _fresh(spark, "parquet")
    files.write_table(_long(spark, sf), path)
    return files.scan_parquet(spark, path)


@register("sink_parquet_partitioned", f"WITH {B.OBS_WIDE_SQL} SELECT * FROM obs_wide",
          doubles=list(B.PRODUCTS))
def q_sink_parquet_partitioned(spark, sf):
    path = _fresh(spark, "detailed")
    files.write_table(B.obs_wide(spark, sf), path, partition_by=["region_code", "departement"])
    # partition columns come back last, as strings whatever the session says
    return files.scan_parquet(spark, path, string_partitions=["region_code", "departement"])


def _by_region(spark, sf):
    return marts.agg_by_region(B.obs_wide(spark, sf), B.PRODUCTS)


BY_REGION_SQL = (f"WITH {B.OBS_WIDE_SQL} SELECT region_code, {_full_stats_sql()} "
                 "FROM obs_wide GROUP BY region_code")
BY_DEPT_SQL = (f"WITH {B.OBS_WIDE_SQL} SELECT departement, region_code, {_full_stats_sql()} "
               "FROM obs_wide GROUP BY departement, region_code")
BY_REGION_DDL = "region_code string, " + ", ".join(
    [f"{c} double" for c in FULL_DOUBLES] + ["nombre_stations long"])


@register("sink_json", BY_REGION_SQL, doubles=FULL_DOUBLES)
def q_sink_json(spark, sf):
    path = _fresh(spark, "by_region_json")
    files.write_table(_by_region(spark, sf), path, fmt="json")
    return files.scan_jsonl(spark, path, BY_REGION_DDL)


@register("sink_csv", BY_REGION_SQL, doubles=FULL_DOUBLES)
def q_sink_csv(spark, sf):
    path = _fresh(spark, "by_region_csv")
    files.write_table(_by_region(spark, sf), path, fmt="csv")
    return files.scan_csv(spark, path, BY_REGION_DDL)


@register("export_region_csv", BY_REGION_SQL, doubles=FULL_DOUBLES)
def q_export_region_csv(spark, sf):
    path = _fresh(spark, "carburants_regions_csv")
    files.export_csv(_by_region(spark, sf), path)
    return files.scan_csv(spark, path, BY_REGION_DDL)


@register("mart_fanout", BY_DEPT_SQL, doubles=FULL_DOUBLES)
def q_mart_fanout(spark, sf):
    base = _fresh(spark, "aggregations")
    wide = B.obs_wide(spark, sf)
    mdict = marts.build_marts(wide, B.PRODUCTS, headline=B.HEADLINE,
                              tiebreak=["id", "prix_maj_date"])
    files.write_marts(mdict, base)
    # exact folder: by_departement must not pick up by_departement_date/_year
    return files.load_mart(spark, base, "by_departement")


@register("load_mart",
          f"WITH {B.OBS_WIDE_SQL} SELECT departement, region_code, prix_maj_date AS date, "
          f"{_mean_sql()} FROM obs_wide GROUP BY departement, region_code, prix_maj_date",
          doubles=MEAN_DOUBLES)
def q_load_mart(spark, sf):
    base = _fresh(spark, "aggregations")
    wide = B.obs_wide(spark, sf)
    files.write_marts({"by_departement": marts.agg_by_department(wide, B.PRODUCTS),
                       "by_departement_date": marts.agg_by_department_date(wide, B.PRODUCTS)},
                      base)
    return files.load_all_marts(spark, base, ["by_departement", "by_departement_date"])[
        "by_departement_date"]


INGEST_TS = "2025-06-30T06:00:00"


@register("landing_enrich",
          f"WITH {L} SELECT l_orderkey, l_linenumber, l_partkey, "
          "CASE WHEN length(CAST(id AS VARCHAR)) < 5 THEN lpad(CAST(id AS VARCHAR), 5, '0') "
          f"ELSE CAST(id AS VARCHAR) END AS cp, '{INGEST_TS}' AS ingestion_timestamp FROM obs_long")
def q_landing_enrich(spark, sf):
    long = B.obs_long(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey",
                                        F.col("id").alias("cp"))
    return landing.landing_enrich(long, INGEST_TS, postal="cp")


@register("ingest_audit",
          f"WITH {L} SELECT 'obs_long' AS dataset_name, '{INGEST_TS}' AS ingestion_timestamp, "
          f"'{INGEST_TS[:10]}' AS ingestion_date, 'driver-tables' AS source_url, "
          "count(*) AS record_count, sum("
          + " + ".join(f"length({c})" for c in ("departement", "region_code", "prix_nom"))
          + " + length(CAST(l_orderkey AS VARCHAR))) / (1024.0 * 1024.0) AS file_size_mb "
          "FROM obs_long", doubles=["file_size_mb"])
def q_ingest_audit(spark, sf):
    # the size is that of these fields' texts, which every engine writes alike
    text = F.concat("departement", "region_code", "prix_nom", F.col("l_orderkey").cast("string"))
    return landing.ingest_audit(_long(spark, sf), dataset_name="obs_long",
                                source_url="driver-tables", ingestion_ts=INGEST_TS,
                                size_of=F.length(text))


# Files written by ``write_json_array`` end in .txt, the sidecar written next
# to them in .json.
SNAPSHOT_PARTS = "part-*.txt"


@register("scan_snapshots", LONG_SQL, doubles=["prix_valeur"])
def q_scan_snapshots(spark, sf):
    path = _fresh(spark, "landing")
    long = _long(spark, sf)
    landing.write_json_array(long, path)
    audit = landing.ingest_audit(long, dataset_name="obs_long", source_url="driver-tables",
                                 ingestion_ts=INGEST_TS)
    audit.coalesce(1).write.mode("append").json(path)   # sidecar in the same folder
    return files.scan_snapshots(spark, path, LONG_SCHEMA, glob=SNAPSHOT_PARTS,
                                source_col=None)
