"""Queries for the clean layer (P1-P10) over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import clean, lookups
from . import bindings as B
from .catalog import register
from .sqltext import csv as _csv

L = B.OBS_LONG_SQL
LONG_COLS = ["id", "departement", "region_code", "prix_nom", "prix_valeur",
             "prix_maj_date", "annee", "l_orderkey", "l_linenumber", "l_partkey"]
LONG_SQL_COLS = ", ".join(LONG_COLS)

ORDERS_MESSY = {"o_orderkey": " O-Orderkey", "o_custkey": "o custkey ",
                "o_orderstatus": "O_ORDERSTATUS", "o_totalprice": "o-TotalPrice",
                "o_orderdate": " o orderdate", "o_orderpriority": "O Order-Priority"}


@register("normalize_columns",
          "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice AS o_totalprice, "
          "o_orderdate, o_orderpriority AS o_order_priority FROM orders",
          doubles=["o_totalprice"])
def q_normalize_columns(spark, sf):
    orders = B.table(spark, sf, "orders")
    messy = orders.select(*[F.col(c).alias(ORDERS_MESSY[c]) for c in orders.columns])
    return clean.normalize_columns(messy)


@register("require_keys",
          f"WITH {L} SELECT {LONG_SQL_COLS} FROM obs_long "
          "WHERE id IS NOT NULL AND departement IS NOT NULL AND region_code IS NOT NULL",
          doubles=["prix_valeur"])
def q_require_keys(spark, sf):
    out = clean.require_keys(B.obs_long(spark, sf), ["id", "departement", "region_code"])
    return out.select(*LONG_COLS)


_PAD = ("CASE WHEN length(CAST({c} AS VARCHAR)) < {w} THEN lpad(CAST({c} AS VARCHAR), {w}, '0') "
        "ELSE CAST({c} AS VARCHAR) END")


@register("pad_code",
          f"WITH {L} SELECT l_orderkey, l_linenumber, l_partkey, "
          f"{_PAD.format(c='id', w=5)} AS id_code FROM obs_long")
def q_pad_code(spark, sf):
    out = clean.pad_column(B.obs_long(spark, sf), "id", 5, out="id_code")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "id_code")


def _supplier_postal(spark, sf):
    s = B.table(spark, sf, "supplier")
    return s.select("s_suppkey", clean.pad_code("s_suppkey", 5).alias("cp"))


_CP = _PAD.format(c="s_suppkey", w=5)


@register("derive_department",
          f"SELECT s_suppkey, cp, CASE WHEN substr(cp, 1, 3) IN ('200', '201') THEN '2A' "
          "WHEN substr(cp, 1, 3) IN ('202', '206') THEN '2B' ELSE substr(cp, 1, 2) END "
          f"AS departement FROM (SELECT s_suppkey, {_CP} AS cp FROM supplier) s")
def q_derive_department(spark, sf):
    return clean.derive_department(_supplier_postal(spark, sf), postal="cp")


@register("derive_region",
          f"WITH {L} SELECT l_orderkey, l_linenumber, l_partkey, o.departement, "
          "coalesce(CAST(n.n_regionkey AS VARCHAR), '99') AS region_code "
          "FROM obs_long o LEFT JOIN nation n ON o.departement = n.n_name")
def q_derive_region(spark, sf):
    nation = B.table(spark, sf, "nation").select("n_name", "n_regionkey")
    long = B.obs_long(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "departement")
    return clean.derive_region(long, mapping=nation)


@register("extract_geo",
          "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS latitude, "
          "TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS longitude FROM events",
          doubles=["latitude", "longitude"])
def q_extract_geo(spark, sf):
    ev = B.table(spark, sf, "events").select(
        "event_id", F.from_json("props", "k string").alias("g"))
    return clean.extract_geo(ev, geom="g", lat="k", lon="k").select("event_id", "latitude",
                                                                     "longitude")


@register("validate_range",
          f"WITH {L} SELECT l_orderkey, l_linenumber, l_partkey, "
          "CASE WHEN prix_valeur > 0.0 AND prix_valeur < 50000.0 THEN prix_valeur END AS prix_valeur "
          "FROM obs_long",
          doubles=["prix_valeur"])
def q_validate_range(spark, sf):
    out = clean.validate_range(B.obs_long(spark, sf), "prix_valeur", low=B.VALID_RANGE[0],
                               high=B.VALID_RANGE[1])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "prix_valeur")


@register("parse_date_year",
          "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS prix_maj_date, "
          "CAST(year(o_orderdate) AS INTEGER) AS annee FROM orders")
def q_parse_date_year(spark, sf):
    o = B.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("string").alias("prix_maj"))
    return clean.parse_date_year(o, ts="prix_maj").select("o_orderkey", "prix_maj_date", "annee")


@register("clean_report",
          f"WITH {L} SELECT count(*) AS rows_in, "
          "count(*) FILTER (WHERE id IS NOT NULL AND departement IS NOT NULL "
          "AND prix_valeur IS NOT NULL) AS rows_out, "
          "count(*) - count(*) FILTER (WHERE id IS NOT NULL AND departement IS NOT NULL "
          "AND prix_valeur IS NOT NULL) AS rows_removed, "
          "CASE WHEN count(*) > 0 THEN (count(*) - count(*) FILTER (WHERE id IS NOT NULL "
          "AND departement IS NOT NULL AND prix_valeur IS NOT NULL)) * 100.0 / count(*) "
          "ELSE 0.0 END AS removed_pct FROM obs_long",
          doubles=["removed_pct"])
def q_clean_report(spark, sf):
    return clean.clean_report(B.obs_long(spark, sf), ["id", "departement", "prix_valeur"])


RUN_TS = "2025-06-30T08:00:00"


@register("stamp_processing",
          f"WITH {B.OBS_WIDE_SQL} SELECT id, prix_maj_date, '{RUN_TS}' AS processing_timestamp, "
          "DATE '2025-06-30' AS processing_date FROM obs_wide")
def q_stamp_processing(spark, sf):
    out = clean.stamp_processing(B.obs_wide(spark, sf), run_ts=RUN_TS, run_date="2025-06-30")
    return out.select("id", "prix_maj_date", "processing_timestamp", "processing_date")


# --- rows that reach every branch, derived from keys over whole tables -----------------

def _values(mapping: dict) -> str:
    return "(VALUES " + ", ".join("('%s', '%s')" % (k, v.replace("'", "''")) for k, v in mapping.items()) + ")"


_NULL_KEYS_SQL = ("k AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS id, "
                  "CASE WHEN o_custkey % 11 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS cp, "
                  "CASE WHEN o_orderkey % 13 <> 0 THEN o_orderstatus END AS ville FROM orders)")


def _null_keys(spark, sf):
    """Orders as observations; each key is NULL for some."""
    o = B.table(spark, sf, "orders")
    return o.select("o_orderkey",
                    F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey").cast("string")).alias("id"),
                    F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey").cast("string")).alias("cp"),
                    F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderstatus")).alias("ville"))


@register("require_keys_nulls", f"WITH {_NULL_KEYS_SQL} SELECT * FROM k WHERE id IS NOT NULL AND cp IS NOT NULL "
                                "AND ville IS NOT NULL")
def q_require_keys_nulls(spark, sf):
    return clean.require_keys(_null_keys(spark, sf))


@register("clean_report_nulls",
          f"WITH {_NULL_KEYS_SQL}, n AS (SELECT count(*) AS a, count(*) FILTER (WHERE id IS NOT NULL AND cp IS NOT "
          "NULL AND ville IS NOT NULL) AS b FROM k) SELECT a AS rows_in, b AS rows_out, a - b AS rows_removed, "
          "CASE WHEN a > 0 THEN (a - b) * 100.0 / a ELSE 0.0 END AS removed_pct FROM n", doubles=["removed_pct"])
def q_clean_report_nulls(spark, sf):
    return clean.clean_report(_null_keys(spark, sf))


# postal codes from 00000 to 99999 in steps of 89 and department codes for every 5th
# customer: Corsica, overseas, unknown and NULL ones occur
_POSTAL_SQL = ("c AS (SELECT c_custkey, CASE WHEN c_custkey % 17 <> 0 THEN lpad(CAST(c_custkey * 89 % 100000 AS "
               "VARCHAR), 5, '0') END AS cp, CASE WHEN c_custkey % 5 = 0 THEN CAST(CASE WHEN c_custkey % 10 = 0 THEN "
               "970 + c_custkey % 7 ELSE c_custkey % 100 END AS VARCHAR) END AS dep_code FROM customer), "
               "d AS (SELECT c_custkey, cp, coalesce(CASE WHEN length(dep_code) < 2 THEN lpad(dep_code, 2, '0') ELSE "
               "dep_code END, CASE WHEN substr(cp, 1, 3) IN ('200', '201') THEN '2A' WHEN substr(cp, 1, 3) IN ('202', "
               "'206') THEN '2B' ELSE substr(cp, 1, 2) END) AS departement FROM c)")


def _departments(spark, sf):
    k = F.col("c_custkey")
    c = B.table(spark, sf, "customer").select(
        k, F.when(k % 17 != 0, F.lpad((k * 89 % 100000).cast("string"), 5, "0")).alias("cp"),
        F.when(k % 5 == 0, F.when(k % 10 == 0, 970 + k % 7).otherwise(k % 100).cast("string")).alias("dep_code"))
    return clean.derive_department(c).drop("dep_code")


@register("derive_department_codes", f"WITH {_POSTAL_SQL} SELECT * FROM d")
def q_derive_department_codes(spark, sf):
    return _departments(spark, sf)


@register("derive_region_codes",
          f"WITH {_POSTAL_SQL} SELECT c_custkey, cp, departement, coalesce(r.v, '99') AS region_code FROM d "
          f"LEFT JOIN {_values(S.DEPARTMENT_REGION)} r(k, v) ON d.departement = r.k")
def q_derive_region_codes(spark, sf):
    return clean.derive_region(_departments(spark, sf))


_REGION_CODES = [*S.REGION_NAMES, "00", "x"]


@register("lookup_region_builtin",
          "SELECT c_custkey, code AS region_code, coalesce(n.v, 'Inconnu') AS region_name FROM (SELECT c_custkey, "
          f"CASE WHEN c_custkey % 19 <> 0 THEN [{_csv(repr(c) for c in _REGION_CODES)}][c_custkey % "
          f"{len(_REGION_CODES)} + 1] END AS code FROM customer) c LEFT JOIN {_values(S.REGION_NAMES)} n(k, v) "
          "ON c.code = n.k")
def q_lookup_region_builtin(spark, sf):
    k = F.col("c_custkey")
    codes = F.array(*[F.lit(c) for c in _REGION_CODES])
    c = B.table(spark, sf, "customer").select(
        k, F.when(k % 19 != 0, codes[(k % len(_REGION_CODES)).cast("int")]).alias("region_code"))
    return lookups.lookup_region_name(c)


@register("lookup_department_builtin",
          f"WITH {_POSTAL_SQL} SELECT c_custkey, departement, n.v AS departement_name FROM d "
          f"LEFT JOIN {_values(S.DEPARTMENT_NAMES)} n(k, v) ON d.departement = n.k")
def q_lookup_department_builtin(spark, sf):
    return lookups.lookup_department_name(_departments(spark, sf).drop("cp"))
