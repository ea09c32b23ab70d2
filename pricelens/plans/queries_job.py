"""The batch job over landed files: damaged input, the detailed table as
``run_detailed`` writes it, and all eight marts in one long table."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from ..functions.sizing import brief_shuffles
from ..operators import clean, marts, reshape
from ..session import scratch_path
from ..sources import files
from . import bindings as B
from . import pipeline
from .catalog import register
from .queries_pipeline import DETAILED_DOUBLES, LO, HI, RUN_DATE, RUN_TS, VALID_WIDE_SQL
from .queries_features import BOUNDS_SQL, FEAT_PART
from .queries_stream import _CORSICA, _DEPT_REGION_VALUES
from .sqltext import csv, rnd

P = B.PRODUCTS


def _land(spark, sf, name, df=None):
    """The landed records as JSON Lines snapshots (compressed, in files that one task reads)."""
    base = scratch_path(spark, f"roundtrip/{name}-{uuid.uuid4().hex}")
    with brief_shuffles(spark):
        files.write_table(B.raw_snapshot(spark, sf) if df is None else df, f"{base}/raw", fmt="jsonl",
                          compression="gzip", max_records_per_file=500_000)
    return base


# --- damaged records: every 97th order's lines are cut short, every 101st lack keys

@register("clean_report_corrupt",
          "WITH r AS (SELECT l_orderkey % 97 = 0 AS cut, l_orderkey % 101 = 0 AS keyless FROM lineitem l "
          "JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey "
          "JOIN nation n ON s.s_nationkey = n.n_nationkey) "
          "SELECT count(*) AS rows_in, count(*) FILTER (WHERE NOT cut AND NOT keyless) AS rows_out, "
          "count(*) FILTER (WHERE cut) AS rows_corrupt, "
          "count(*) FILTER (WHERE cut OR keyless) AS rows_removed, "
          "count(*) FILTER (WHERE cut OR keyless) * 100.0 / count(*) AS removed_pct FROM r",
          doubles=["removed_pct"])
def q_clean_report_corrupt(spark, sf):
    raw = B.raw_snapshot(spark, sf)
    order = F.split("prix_id", "-")[0].cast("long")
    raw = raw.withColumn("ville", F.when(order % 101 != 0, F.col("ville")))
    line = F.to_json(F.struct(*[F.col(c) for c in raw.columns]))
    line = F.when(order % 97 == 0, F.substring(line, 1, 40)).otherwise(line)
    base = scratch_path(spark, f"roundtrip/damaged-{uuid.uuid4().hex}")
    raw.select(line.alias("value")).write.text(f"{base}/raw")
    back = files.scan_snapshots(spark, f"{base}/raw", fmt="jsonl", glob="part-*",
                                on_corrupt="report")
    return clean.clean_report(back)


# --- the landed job ---------------------------------------------------------------

_COLS = ["id", "cp", "ville", "adresse", "departement", "region_code", "latitude", "longitude",
         "prix_maj_date", "annee"]
_LANDED_SQL = f"""
raw AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS id,
         lpad(CAST((n.n_nationkey + 1) * 1000 + s.s_suppkey % 1000 AS VARCHAR), 5, '0') AS cp,
         n.n_name AS ville, s.s_name AS adresse,
         42.0 + (s.s_suppkey % 90) / 10.0 AS latitude, -4.5 + (s.s_suppkey % 120) / 10.0 AS longitude,
         p.p_type AS prix_nom, l.l_extendedprice / NULLIF(l.l_quantity, 0) AS v, l.l_shipdate AS prix_maj,
         CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) || '-'
           || CAST(l.l_partkey AS VARCHAR) AS prix_id
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey),
dept AS (SELECT *, CASE {_CORSICA} ELSE substr(cp, 1, 2) END AS departement FROM raw),
dr(d, r) AS (VALUES {_DEPT_REGION_VALUES}),
cleaned AS (
  SELECT id, cp, ville, adresse, departement, coalesce(dr.r, '99') AS region_code, latitude, longitude,
         prix_nom, CASE WHEN v > {LO} AND v < {HI} THEN v END AS prix_valeur, prix_maj, prix_id,
         CAST(prix_maj AS DATE) AS prix_maj_date, CAST(year(prix_maj) AS INTEGER) AS annee
  FROM dept LEFT JOIN dr ON dept.departement = dr.d),
obs_wide AS (
  SELECT {csv(_COLS)}, {csv(
    f"arg_max(prix_valeur, (prix_maj, prix_id)) FILTER (WHERE prix_nom = '{r}' AND prix_valeur IS NOT NULL) AS {r.lower()}"
    for r in B.RAW_PRODUCTS)}
  FROM cleaned GROUP BY {csv(_COLS)})"""
_JOB_COLS = (_COLS + list(P) + ["prix_moyen_station"] + [f"{p}_moy_region" for p in P]
             + [c for p in P for c in (f"{p}_diff_region", f"{p}_pct_vs_region")]
             + [f"competitive_{p}" for p in B.FLAGGED]
             + ["competitivity_score", f"{B.HEADLINE}_evolution"]
             + [f"is_outlier_{p}" for p in P]
             + ["has_any_anomaly", "processing_timestamp", "processing_date"])
_FLAGS = [f"coalesce(f.{p} < b.{p}_lower OR f.{p} > b.{p}_upper, false)" for p in P]
_JOB_SQL = f"""WITH {_LANDED_SQL}{FEAT_PART}{BOUNDS_SQL}
SELECT {csv(f"f.{c}" for c in _COLS + list(P))},
  {rnd("(" + " + ".join(f"f.{p}" for p in P) + f") / {len(P)}", 3)} AS prix_moyen_station,
  {csv([f"f.{p}_moy_region" for p in P] + [f"f.{p}_{x}" for p in P for x in ("diff_region", "pct_vs_region")])},
  {csv(f"coalesce(f.{p}_diff_region < 0, false) AS competitive_{p}" for p in B.FLAGGED)},
  ({" + ".join(f"CASE WHEN f.{p}_diff_region < 0 THEN 1 ELSE 0 END" for p in P)}) AS competitivity_score,
  f.{B.HEADLINE} - lag(f.{B.HEADLINE}) OVER (PARTITION BY f.id ORDER BY f.prix_maj_date, f.cp, f.ville,
    f.adresse, f.departement, f.region_code, f.latitude, f.longitude, f.annee) AS {B.HEADLINE}_evolution,
  {csv(f"{x} AS is_outlier_{p}" for p, x in zip(P, _FLAGS))}, ({" OR ".join(_FLAGS)}) AS has_any_anomaly,
  '{RUN_TS}' AS processing_timestamp, DATE '{RUN_DATE}' AS processing_date
FROM feat f CROSS JOIN bounds b"""


@register("job_detailed", _JOB_SQL, doubles=["latitude", "longitude", *DETAILED_DOUBLES])
def q_job_detailed(spark, sf):
    base = _land(spark, sf, "job")
    path = pipeline.run_detailed(
        spark, f"{base}/raw", f"{base}/out", fmt="jsonl", glob="part-*", products=P,
        flagged=B.FLAGGED, price_range=(LO, HI), run_ts=RUN_TS, run_date=RUN_DATE)
    back = files.load_detailed(spark, f"{base}/out")
    assert path == f"{base}/out/detailed"
    return back.select(*_JOB_COLS)


# --- the eight marts as (mart, key, measure, value) --------------------------------

MART_KEYS = {
    "by_region": ["region_code"], "by_departement": ["departement", "region_code"],
    "by_date": ["prix_maj_date"], "by_departement_date": ["departement", "region_code", "date"],
    "by_year": ["annee"], "by_departement_year": ["departement", "region_code", "annee"],
    "most_expensive": ["region_code", "rank", "id"], "least_expensive": ["region_code", "rank", "id"],
}
_FULL = ("moyen", "min", "max", "stddev")
_AGG = {"moyen": "avg", "min": "min", "max": "max", "stddev": "stddev_samp"}


def _measures(mart: str) -> list[str]:
    if mart.endswith("expensive"):
        return [B.HEADLINE]
    kinds = _FULL if mart in ("by_region", "by_departement") else _FULL[:1]
    return [f"{p}_{k}" for p in P for k in kinds] + ["nombre_stations"]


def marts_long(mart_tables: dict):
    """Every mart's cells: (mart, key, measure, value)."""
    parts = []
    for mart, keys in MART_KEYS.items():
        t = mart_tables[mart]
        text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys])
        cells = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value"))
                                    for m in _measures(mart)]))
        parts.append(t.select(F.lit(mart).alias("mart"), text.alias("key"), cells.alias("c"))
                      .select("mart", "key", "c.measure", "c.value"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _key_sql(keys, names=None) -> str:
    cols = csv(f"coalesce(CAST({(names or {}).get(k, k)} AS VARCHAR), '-')" for k in keys)
    return f"concat_ws('|', {cols})"


def marts_long_sql(wide: str = "obs_wide") -> str:
    parts = []
    for mart, keys in MART_KEYS.items():
        if mart.endswith("expensive"):
            order = "DESC NULLS LAST" if mart.startswith("most") else "ASC"
            where = "" if mart.startswith("most") else f"WHERE {B.HEADLINE} IS NOT NULL"
            parts.append(
                f"SELECT '{mart}' AS mart, {_key_sql(keys)} AS key, '{B.HEADLINE}' AS measure, "
                f"{B.HEADLINE} AS value FROM (SELECT *, row_number() OVER (PARTITION BY region_code ORDER BY "
                f"{B.HEADLINE} {order}, id, prix_maj_date) AS rank FROM {wide} {where}) t WHERE rank <= 10")
            continue
        group = [{"date": "prix_maj_date"}.get(k, k) for k in keys]
        for m in _measures(mart):
            p, _, kind = m.rpartition("_")
            agg = "count(*)" if m == "nombre_stations" else f"{_AGG[kind]}({p})"
            parts.append(f"SELECT '{mart}' AS mart, {_key_sql(keys, {'date': 'prix_maj_date'})} AS key, "
                         f"'{m}' AS measure, CAST({agg} AS DOUBLE) AS value FROM {wide} GROUP BY {csv(group)}")
    return " UNION ALL ".join(parts)


@register("mart_fanout_all", f"WITH {B.OBS_WIDE_SQL} {marts_long_sql()}", doubles=["value"])
def q_mart_fanout_all(spark, sf):
    base = scratch_path(spark, f"roundtrip/marts-{uuid.uuid4().hex}")
    paths = files.write_marts(marts.build_marts(B.obs_wide(spark, sf), P, headline=B.HEADLINE,
                                                tiebreak=["id", "prix_maj_date"]), base)
    return marts_long({m: files.load_mart(spark, base, m) for m in paths})


@register("pipeline_marts_all", f"WITH {VALID_WIDE_SQL} {marts_long_sql()}", doubles=["value"])
def q_pipeline_marts_all(spark, sf):
    from .queries_pipeline import detailed

    base = scratch_path(spark, f"roundtrip/pipeline-{uuid.uuid4().hex}")
    files.write_table(detailed(spark, sf), f"{base}/detailed",
                      partition_by=list(pipeline.DETAILED_PARTITIONS))
    pipeline.run_marts(spark, f"{base}/detailed", base, products=P, headline=B.HEADLINE)
    return marts_long({m: files.load_mart(spark, f"{base}/aggregations", m) for m in MART_KEYS})


# --- latest value by moment and number --------------------------------------------


@register("pivot_latest_moment",
          f"WITH {B.OBS_LONG_SQL}, t AS (SELECT *, prix_maj + to_minutes(CAST(l_partkey % 1440 AS INTEGER)) AS "
          "moment FROM obs_long) SELECT id, prix_maj_date, "
          + csv(f"arg_max(prix_valeur, (moment, l_orderkey, l_linenumber, l_partkey)) FILTER (WHERE prix_nom = "
                f"'{r}' AND prix_valeur IS NOT NULL) AS {r.lower()}" for r in B.RAW_PRODUCTS)
          + " FROM t GROUP BY id, prix_maj_date", doubles=list(P))
def q_pivot_latest_moment(spark, sf):
    """Observation times as texts in offsets from +00:00 to +02:00, ids as text
    numbers, every observation in two files: the same wide rows as from one."""
    long = B.obs_long(spark, sf)
    moment = F.to_timestamp_ntz(F.date_format("prix_maj", "yyyy-MM-dd HH:mm:ss"))
    minutes = (F.col("l_orderkey") % 5) * 30
    local = moment + F.make_dt_interval(mins=(F.col("l_partkey") % 1440 + minutes).cast("int"))
    offset = F.format_string("+%02d:%02d", F.floor(minutes / 60), minutes % 60)
    number = (F.col("l_orderkey") * 1_000_000_000 + F.col("l_linenumber") * 100_000_000 + F.col("l_partkey"))
    rows = long.select("id", "prix_maj_date", "prix_nom", "prix_valeur",
                       F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), offset).alias("prix_maj"),
                       number.cast("string").alias("prix_id"))
    rows = rows.withColumn("prix_maj_ts", F.col("prix_maj").try_cast("timestamp"))
    both = reduce(lambda a, b: a.unionByName(b),
                  [rows.withColumn("source_file", F.lit(f)) for f in ("day-1", "day-2")])
    return reshape.pivot_wide(both, B.RAW_PRODUCTS)
