"""Bind the driver's TPC-H-style tables to the observation model.

The driver tables carry no station prices, so roles are mapped as follows
(entity = supplier, department = nation name, region = nation region key,
product = part type, value = extended price / quantity, observation month =
ship month).  The same mapping is written once in Spark and once as SQL
text (``OBS_LONG_SQL``/``OBS_WIDE_SQL``) for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reshape import pivot_wide

# Raw product names (part types) and their wide-column names.
RAW_PRODUCTS = ("ECONOMY", "SMALL", "MEDIUM", "PROMO", "STANDARD", "LARGE")
PRODUCTS = tuple(p.lower() for p in RAW_PRODUCTS)
# Roles of the two flagged products and of the ranked product.
FLAGGED = ("economy", "small")
HEADLINE = "economy"
# Observation order: latest ship timestamp, then the line identity.
ORDER = ("prix_maj", "l_orderkey", "l_linenumber", "l_partkey")
WIDE_KEYS = ("id", "departement", "region_code", "prix_maj_date", "annee")
# Validation bounds for the bound value (the published bounds are (0, 5)
# for fuel prices; the bound value ranges over about 19 .. 105,000).
VALID_RANGE = (0.0, 50000.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier -> (department, region).  nation is tiny: Catalyst broadcasts
    it from its file statistics; supplier grows with the data and is joined
    by the planner's choice (broadcast only under the size threshold)."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey"),
        F.col("n_name").alias("departement"),
        F.col("n_regionkey").cast("string").alias("region_code"))


def obs_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long observation table: one row per line item."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    geo = geography(spark, sf_dir)
    joined = (li.join(part, li.l_partkey == part.p_partkey)
                .join(geo, li.l_suppkey == geo.s_suppkey))
    # date first, then the month: no time-zone conversion on the way
    month = F.trunc(F.col("l_shipdate").cast("date"), "month")
    return joined.select(
        F.col("s_suppkey").alias("id"),
        "departement",
        "region_code",
        F.col("p_type").alias("prix_nom"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("prix_valeur"),
        F.col("l_shipdate").alias("prix_maj"),
        month.alias("prix_maj_date"),
        F.year(month).alias("annee"),
        "l_orderkey", "l_linenumber", "l_partkey")


def obs_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide table: latest value per (entity, geography, month) and product."""
    return pivot_wide(obs_long(spark, sf_dir), RAW_PRODUCTS, order=ORDER,
                      keys=WIDE_KEYS)


# --- the same binding as SQL text (DuckDB dialect) -------------------------

OBS_LONG_SQL = """
obs_long AS (
  SELECT s.s_suppkey AS id, n.n_name AS departement,
         CAST(n.n_regionkey AS VARCHAR) AS region_code,
         p.p_type AS prix_nom,
         l.l_extendedprice / NULLIF(l.l_quantity, 0) AS prix_valeur,
         l.l_shipdate AS prix_maj,
         CAST(date_trunc('month', l.l_shipdate) AS DATE) AS prix_maj_date,
         CAST(year(l.l_shipdate) AS INTEGER) AS annee,
         l.l_orderkey, l.l_linenumber, l.l_partkey
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey)"""


def _latest(raw: str) -> str:
    return (f"arg_max(prix_valeur, (prix_maj, l_orderkey, l_linenumber, l_partkey)) "
            f"FILTER (WHERE prix_nom = '{raw}' AND prix_valeur IS NOT NULL) AS {raw.lower()}")


def wide_sql(src: str = "obs_long", name: str = "obs_wide") -> str:
    """CTE text of the pivot (R1) over the long CTE ``src``."""
    return f""",
{name} AS (
  SELECT id, departement, region_code, prix_maj_date, annee,
         """ + ",\n         ".join(_latest(r) for r in RAW_PRODUCTS) + f"""
  FROM {src}
  GROUP BY id, departement, region_code, prix_maj_date, annee)"""


OBS_WIDE_SQL = OBS_LONG_SQL + wide_sql()

# Coordinates for the map operators: the driver tables have none, so they
# are derived from the entity key by fixed arithmetic (every 7th missing).
LAT_SQL = "CASE WHEN id % 7 = 0 THEN NULL ELSE 42.0 + (id % 90) / 10.0 END"
LON_SQL = "CASE WHEN id % 7 = 0 THEN NULL ELSE -4.5 + (id % 120) / 10.0 END"


def with_coordinates(df: DataFrame) -> DataFrame:
    missing = F.col("id") % 7 == 0
    return df.select(
        "*",
        F.when(~missing, 42.0 + (F.col("id") % 90) / 10.0).alias("latitude"),
        F.when(~missing, -4.5 + (F.col("id") % 120) / 10.0).alias("longitude"))


def raw_snapshot(spark: SparkSession, sf_dir: str,
                 ingestion_ts: str = "2025-06-30T06:00:00") -> DataFrame:
    """The driver tables in the *landed* record shape (strings, nested
    geometry), one record per line item - input for the full clean layer.

    Postal codes are built so their first two digits are a real department
    code (01-25, from the nation key), which the clean layer maps to a
    region.
    """
    # the value first: one number instead of two on the way through the joins
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("value"), "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    geo = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    joined = (li.join(part, li.l_partkey == part.p_partkey)
                .join(geo, li.l_suppkey == geo.s_suppkey))
    cp = F.lpad(((F.col("n_nationkey") + 1) * 1000 + F.col("s_suppkey") % 1000).cast("string"),
                5, "0")
    return joined.select(
        F.col("s_suppkey").cast("string").alias("id"),
        cp.alias("cp"),
        F.col("n_name").alias("ville"),
        F.col("s_name").alias("adresse"),
        F.struct((42.0 + (F.col("s_suppkey") % 90) / 10.0).alias("lat"),
                 (-4.5 + (F.col("s_suppkey") % 120) / 10.0).alias("lon")).alias("geom"),
        F.col("p_type").alias("prix_nom"),
        F.col("value").cast("string").alias("prix_valeur"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("prix_maj"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("prix_id"),
        F.lit(ingestion_ts).alias("ingestion_timestamp"))
