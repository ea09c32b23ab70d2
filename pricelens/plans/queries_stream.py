"""Query for the incremental (streaming) clean of landed snapshots."""

from __future__ import annotations

import uuid

from .. import schema as S
from ..session import scratch_path
from ..sources import landing
from ..streaming import start_incremental_clean
from . import bindings as B
from .catalog import register

LO, HI = B.VALID_RANGE
OUT_COLS = ["id", "cp", "departement", "region_code", "latitude", "longitude", "prix_nom",
            "prix_valeur", "prix_maj_date", "annee", "prix_id"]

_DEPT_REGION_VALUES = ", ".join(f"('{d}', '{r}')" for d, r in S.DEPARTMENT_REGION.items())
_CORSICA = " ".join(f"WHEN substr(cp, 1, 3) = '{p}' THEN '{d}'"
                    for p, d in S.CORSICA_POSTAL_PREFIX.items())

STREAM_SQL = f"""
WITH raw AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS id,
         lpad(CAST((n.n_nationkey + 1) * 1000 + s.s_suppkey % 1000 AS VARCHAR), 5, '0') AS cp,
         42.0 + (s.s_suppkey % 90) / 10.0 AS latitude,
         -4.5 + (s.s_suppkey % 120) / 10.0 AS longitude,
         p.p_type AS prix_nom,
         l.l_extendedprice / NULLIF(l.l_quantity, 0) AS v,
         CAST(l.l_shipdate AS DATE) AS prix_maj_date,
         CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) || '-'
           || CAST(l.l_partkey AS VARCHAR) AS prix_id
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey),
dept AS (SELECT *, CASE {_CORSICA} ELSE substr(cp, 1, 2) END AS departement FROM raw),
dr(d, r) AS (VALUES {_DEPT_REGION_VALUES})
SELECT id, cp, departement, coalesce(dr.r, '99') AS region_code, latitude, longitude, prix_nom,
       CASE WHEN v > {LO} AND v < {HI} THEN v END AS prix_valeur, prix_maj_date,
       CAST(year(prix_maj_date) AS INTEGER) AS annee, prix_id
FROM dept LEFT JOIN dr ON dept.departement = dr.d"""


@register("incremental_clean", STREAM_SQL,
          doubles=["latitude", "longitude", "prix_valeur"])
def q_incremental_clean(spark, sf):
    base = scratch_path(spark, f"roundtrip/stream-{uuid.uuid4().hex}")
    landing.write_json_array(B.raw_snapshot(spark, sf), f"{base}/raw", compression="gzip")
    q = start_incremental_clean(spark, f"{base}/raw", f"{base}/long",
                                checkpoint_location=f"{base}/checkpoint", low=LO, high=HI,
                                glob="part-*.txt.gz")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/long").select(*OUT_COLS)
