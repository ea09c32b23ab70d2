"""Queries for the dashboard layer: reshapes (R2-R6), roll-ups and
statistics (G7-G21), lookups and filters (P11-P23), ranking (W3-W6) and
map tables (J3, V1-V4) - all over marts derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dashboard, lookups, marts, ranking, reshape, select
from ..operators.mapdata import (choropleth_bands, choropleth_table, heat_points,
                                 station_points)
from . import bindings as B
from .catalog import register
from .queries_core import FULL_DOUBLES, MEAN_DOUBLES, _full_stats_sql, _mean_sql
from .queries_features import BOUNDS_SQL, FEAT_PART, FLAGS_SQL, region_dim, REGION_DIM_SQL
from .sqltext import csv, rnd

P = B.PRODUCTS
LABELS = {p: p.upper() for p in P}
OTHER = "4"          # region code playing the catch-all role
YEAR = 1998
PRODUCT = "ECONOMY"
NO_DATA_AREA = "NOWHERE"          # one more area, without any price

MARTS_SQL = B.OBS_WIDE_SQL + f""",
by_region AS (SELECT region_code, {_full_stats_sql()} FROM obs_wide GROUP BY region_code),
by_departement AS (SELECT departement, region_code, {_full_stats_sql()} FROM obs_wide
                   GROUP BY departement, region_code),
by_dd AS (SELECT departement, region_code, prix_maj_date AS date, {_mean_sql()} FROM obs_wide
          GROUP BY departement, region_code, prix_maj_date),
by_date AS (SELECT prix_maj_date, {_mean_sql()} FROM obs_wide GROUP BY prix_maj_date),
dd_long AS (""" + " UNION ALL ".join(
    f"SELECT departement, nombre_stations, date, '{LABELS[p]}' AS fuel_type, "
    f"{p}_moyen AS mean_price FROM by_dd WHERE {p}_moyen IS NOT NULL" for p in P) + f"""),
rdim AS ({REGION_DIM_SQL}),
ndim AS (SELECT n_name AS departement, CAST(n_regionkey AS VARCHAR) AS region FROM nation),
latest AS (
  SELECT l.* FROM dd_long l
  JOIN (SELECT fuel_type, max(date) AS d FROM dd_long GROUP BY fuel_type) m
    ON l.fuel_type = m.fuel_type AND l.date = m.d)"""


def W(spark, sf):
    return B.obs_wide(spark, sf)


def by_region(spark, sf):
    return marts.agg_by_region(W(spark, sf), P)


def by_dd(spark, sf):
    return marts.agg_by_department_date(W(spark, sf), P)


def by_date(spark, sf):
    return marts.agg_by_date(W(spark, sf), P)


def dd_long(spark, sf):
    return dashboard.mart_long(by_dd(spark, sf), P, ids=["departement", "nombre_stations", "date"],
                               labels=LABELS)


def nation_dim(spark, sf):
    n = B.table(spark, sf, "nation")
    return n.select(F.col("n_name").alias("departement"),
                    F.col("n_regionkey").cast("string").alias("region"))


def latest(spark, sf):
    return select.latest_slice(dd_long(spark, sf), product="fuel_type", date="date")


# ---------------------------------------------------------------- reshapes

@register("unpivot_long", f"WITH {MARTS_SQL} SELECT * FROM dd_long", doubles=["mean_price"])
def q_unpivot_long(spark, sf):
    return dd_long(spark, sf)


_MELT = " UNION ALL ".join(
    f"SELECT d.region_name, '{p.upper()}' AS carburant, r.{p}_moyen AS prix "
    f"FROM by_region r LEFT JOIN rdim d ON r.region_code = d.region_code "
    f"WHERE r.region_code IS DISTINCT FROM '{OTHER}'" for p in P)


@register("melt_region", f"WITH {MARTS_SQL} {_MELT}", doubles=["prix"])
def q_melt_region(spark, sf):
    named = lookups.lookup_region_name(by_region(spark, sf), region_dim(spark, sf))
    named = select.exclude_other(named, other=OTHER)
    return reshape.melt_region(named, [f"{p}_moyen" for p in P])


@register("region_matrix",
          f"WITH {MARTS_SQL} SELECT coalesce(d.region_name, 'Inconnu') AS region_name, "
          + csv(f"r.{p}_moyen" for p in P)
          + f" FROM by_region r LEFT JOIN rdim d ON r.region_code = d.region_code "
            f"WHERE r.region_code IS DISTINCT FROM '{OTHER}'",
          doubles=MEAN_DOUBLES)
def q_region_matrix(spark, sf):
    named = lookups.lookup_region_name(by_region(spark, sf), region_dim(spark, sf))
    named = select.exclude_other(named, other=OTHER)
    return reshape.region_matrix(named, P)


_RANKED = ("SELECT id, departement, region_code, economy, CAST(rank AS INTEGER) AS rank, "
           "'{side}' AS side FROM (SELECT *, row_number() OVER (PARTITION BY region_code "
           "ORDER BY economy {order}, id, prix_maj_date) AS rank FROM obs_wide {where}) t "
           "WHERE rank <= 10")


@register("union_all",
          f"WITH {B.OBS_WIDE_SQL} "
          + _RANKED.format(side="most", order="DESC NULLS LAST", where="")
          + " UNION ALL "
          + _RANKED.format(side="least", order="ASC", where="WHERE economy IS NOT NULL"),
          doubles=["economy"])
def q_union_all(spark, sf):
    m = marts.build_marts(W(spark, sf), P, headline=B.HEADLINE, tiebreak=["id", "prix_maj_date"])
    return reshape.union_all([m["most_expensive"].withColumn("side", F.lit("most")),
                              m["least_expensive"].withColumn("side", F.lit("least"))])


@register("distinct_sorted",
          f"WITH {B.OBS_WIDE_SQL} SELECT DISTINCT prix_maj_date FROM obs_wide")
def q_distinct_sorted(spark, sf):
    return reshape.distinct_sorted(W(spark, sf), "prix_maj_date")


# ------------------------------------------------------- lookups / filters

@register("lookup_region_name",
          f"WITH {MARTS_SQL} SELECT r.region_code, coalesce(d.region_name, 'Inconnu') AS "
          "region_name, r.nombre_stations FROM by_region r LEFT JOIN rdim d "
          "ON r.region_code = d.region_code")
def q_lookup_region_name(spark, sf):
    named = lookups.lookup_region_name(by_region(spark, sf), region_dim(spark, sf))
    return named.select("region_code", "region_name", "nombre_stations")


@register("lookup_department_name",
          f"WITH {MARTS_SQL} SELECT b.departement, b.region_code, n.name AS departement_name, "
          "b.nombre_stations FROM by_departement b LEFT JOIN (SELECT n_name, "
          "'Nation ' || CAST(n_nationkey AS VARCHAR) AS name FROM nation) n "
          "ON b.departement = n.n_name")
def q_lookup_department_name(spark, sf):
    n = B.table(spark, sf, "nation").select(
        "n_name", F.concat(F.lit("Nation "), F.col("n_nationkey").cast("string")))
    named = lookups.lookup_department_name(marts.agg_by_department(W(spark, sf), P), n)
    return named.select("departement", "region_code", "departement_name", "nombre_stations")


@register("map_dept_region",
          f"WITH {MARTS_SQL} SELECT l.*, n.region FROM dd_long l JOIN ndim n "
          "ON l.departement = n.departement",
          doubles=["mean_price"])
def q_map_dept_region(spark, sf):
    return lookups.map_dept_region(dd_long(spark, sf), nation_dim(spark, sf))


@register("filter_year",
          f"WITH {MARTS_SQL} SELECT * FROM by_dd WHERE date IS NOT NULL AND year(date) = {YEAR}",
          doubles=MEAN_DOUBLES)
def q_filter_year(spark, sf):
    return select.filter_year(by_dd(spark, sf), YEAR, date="date")


@register("filter_product",
          f"WITH {MARTS_SQL} SELECT * FROM dd_long WHERE fuel_type = '{PRODUCT}'",
          doubles=["mean_price"])
def q_filter_product(spark, sf):
    return select.filter_product(dd_long(spark, sf), PRODUCT)


@register("latest_slice", f"WITH {MARTS_SQL} SELECT * FROM latest", doubles=["mean_price"])
def q_latest_slice(spark, sf):
    return latest(spark, sf)


@register("exclude_other",
          f"WITH {MARTS_SQL} SELECT * FROM by_region WHERE region_code IS DISTINCT FROM '{OTHER}'",
          doubles=FULL_DOUBLES)
def q_exclude_other(spark, sf):
    return select.exclude_other(by_region(spark, sf), other=OTHER)


@register("filter_regions",
          f"WITH {MARTS_SQL} SELECT * FROM by_region WHERE region_code IN ('0', '1')",
          doubles=FULL_DOUBLES)
def q_filter_regions(spark, sf):
    return select.filter_regions(by_region(spark, sf), ["0", "1"])


_GEO_SQL = (f"WITH {B.OBS_WIDE_SQL}, geo AS (SELECT *, {B.LAT_SQL} AS latitude, "
            f"{B.LON_SQL} AS longitude FROM obs_wide)")


@register("drop_missing_geo",
          f"{_GEO_SQL} SELECT id, prix_maj_date, latitude, longitude, economy FROM geo "
          "WHERE latitude IS NOT NULL AND longitude IS NOT NULL",
          doubles=["latitude", "longitude", "economy"])
def q_drop_missing_geo(spark, sf):
    g = B.with_coordinates(W(spark, sf))
    return select.drop_missing(g, ["latitude", "longitude"]).select(
        "id", "prix_maj_date", "latitude", "longitude", "economy")


@register("filter_anomalies",
          f"WITH {FLAGS_SQL} SELECT id, departement, region_code, prix_maj_date FROM anom "
          "WHERE has_any_anomaly")
def q_filter_anomalies(spark, sf):
    from ..operators import anomaly
    flagged = anomaly.detect_anomalies(W(spark, sf), P)
    return select.filter_anomalies(flagged).select("id", "departement", "region_code",
                                                   "prix_maj_date")


@register("tidy_labels",
          f"WITH {MARTS_SQL} SELECT departement, date, fuel_type, "
          "upper(fuel_type) AS label FROM dd_long")
def q_tidy_labels(spark, sf):
    df = dd_long(spark, sf).select("departement", "date", "fuel_type",
                                   F.concat(F.lower("fuel_type"), F.lit("_moyen")).alias("label"))
    return select.tidy_labels(df, "label")


@register("project_rename",
          f"WITH {MARTS_SQL} SELECT region_code AS code, economy_moyen AS economy, "
          "small_moyen AS small, nombre_stations AS n FROM by_region",
          doubles=["economy", "small"])
def q_project_rename(spark, sf):
    return select.project_rename(by_region(spark, sf), {
        "region_code": "code", "economy_moyen": "economy", "small_moyen": "small",
        "nombre_stations": "n"})


def _fmt(c):
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE printf('%.3f €', {rnd(c, 3)}) END"


@register("format_price",
          f"WITH {MARTS_SQL} SELECT strftime(prix_maj_date, '%d/%m/%Y') AS prix_maj_date, "
          + csv(f"{_fmt(f'{p}_moyen')} AS {p}_moyen" for p in P)
          + ", nombre_stations FROM by_date")
def q_format_price(spark, sf):
    return select.format_prices(by_date(spark, sf), [f"{p}_moyen" for p in P],
                                dates=["prix_maj_date"])


# --------------------------------------------------------------- ranking

@register("global_top_k",
          f"WITH {B.OBS_WIDE_SQL} SELECT id, departement, prix_maj_date, economy FROM obs_wide "
          "WHERE economy IS NOT NULL ORDER BY economy DESC, id, prix_maj_date LIMIT 15",
          doubles=["economy"])
def q_global_top_k(spark, sf):
    return ranking.global_top_k(W(spark, sf), value="economy", k=15, largest=True,
                                tiebreak=["id", "prix_maj_date"],
                                columns=["id", "departement", "prix_maj_date", "economy"])


@register("global_bottom_k",
          f"WITH {B.OBS_WIDE_SQL} SELECT id, departement, prix_maj_date, economy FROM obs_wide "
          "WHERE economy IS NOT NULL ORDER BY economy ASC, id, prix_maj_date LIMIT 15",
          doubles=["economy"])
def q_global_bottom_k(spark, sf):
    return ranking.global_top_k(W(spark, sf), value="economy", k=15, largest=False,
                                tiebreak=["id", "prix_maj_date"],
                                columns=["id", "departement", "prix_maj_date", "economy"])


@register("sort_by_price",
          f"WITH {MARTS_SQL} SELECT region_code, economy_moyen FROM by_region "
          "ORDER BY economy_moyen NULLS LAST",
          doubles=["economy_moyen"])
def q_sort_by_price(spark, sf):
    return ranking.sort_by(by_region(spark, sf), "economy_moyen").select("region_code",
                                                                         "economy_moyen")


@register("sort_by_date",
          f"WITH {MARTS_SQL} SELECT * FROM by_date ORDER BY prix_maj_date NULLS LAST",
          doubles=MEAN_DOUBLES)
def q_sort_by_date(spark, sf):
    return ranking.sort_by(by_date(spark, sf), "prix_maj_date")


@register("show_sample",
          f"WITH {B.OBS_WIDE_SQL} SELECT * FROM obs_wide ORDER BY id, prix_maj_date LIMIT 10",
          doubles=list(P))
def q_show_sample(spark, sf):
    return ranking.head(W(spark, sf).orderBy("id", "prix_maj_date"), 10)


def _md5_sql(keys, seed=42):
    """DuckDB twin of ``functions.columns.sample_hash``."""
    return ("md5(concat_ws('|', " + csv(f"CAST({k} AS VARCHAR)" for k in keys)
            + f", '{seed}'))")


_LONG_KEY = ["l_orderkey", "l_linenumber", "l_partkey"]


@register("bounded_sample",
          f"WITH {B.OBS_LONG_SQL} SELECT * FROM obs_long "
          f"ORDER BY {_md5_sql(_LONG_KEY)}, {csv(_LONG_KEY)} LIMIT 5000",
          doubles=["prix_valeur"])
def q_bounded_sample(spark, sf):
    return ranking.bounded_sample(B.obs_long(spark, sf), n=5000, seed=42, key=_LONG_KEY)


# ----------------------------------------------------------- statistics

@register("run_summary",
          f"WITH {FLAGS_SQL} SELECT count(*) AS total_rows, "
          "count(DISTINCT region_code) + max(CASE WHEN region_code IS NULL THEN 1 ELSE 0 END) "
          "AS n_regions, count(DISTINCT departement) + max(CASE WHEN departement IS NULL "
          "THEN 1 ELSE 0 END) AS n_departements, min(annee) AS first_year, "
          "max(annee) AS last_year, count(DISTINCT annee) AS n_years, "
          "count(*) FILTER (WHERE has_any_anomaly) AS n_anomalies FROM anom")
def q_run_summary(spark, sf):
    from ..operators import anomaly
    return marts.run_summary(anomaly.detect_anomalies(W(spark, sf), P))


@register("column_stats",
          f"WITH {B.OBS_WIDE_SQL} " + " UNION ALL ".join(
              f"SELECT '{p}' AS \"column\", count({p}) AS count, avg({p}) AS mean, "
              f"stddev_samp({p}) AS stddev, min({p}) AS min, max({p}) AS max FROM obs_wide"
              for p in P),
          doubles=["mean", "stddev", "min", "max"])
def q_column_stats(spark, sf):
    return marts.column_stats(W(spark, sf), P)


WIDE_SCHEMA = ("struct<id:bigint,departement:string,region_code:string,prix_maj_date:date,"
               "annee:int," + ",".join(f"{p}:double" for p in P) + ">")


@register("table_profile",
          f"WITH {B.OBS_WIDE_SQL} SELECT 'obs_wide' AS table_name, count(*) AS n_rows, "
          f"{5 + len(P)} AS n_columns, "
          f"'{', '.join(list(B.WIDE_KEYS) + list(P))}' AS columns, '{WIDE_SCHEMA}' AS schema "
          "FROM obs_wide")
def q_table_profile(spark, sf):
    return marts.table_profile(W(spark, sf), "obs_wide")


@register("rollup_region",
          f"WITH {MARTS_SQL} SELECT n.region, l.date, l.fuel_type, avg(l.mean_price) AS "
          "mean_price, CAST(sum(l.nombre_stations) AS BIGINT) AS nombre_stations FROM dd_long l JOIN ndim n "
          "ON l.departement = n.departement GROUP BY n.region, l.date, l.fuel_type",
          doubles=["mean_price"])
def q_rollup_region(spark, sf):
    return dashboard.rollup_region(dd_long(spark, sf), mapping=nation_dim(spark, sf))


@register("national_evolution",
          f"WITH {MARTS_SQL} SELECT date, avg(mean_price) AS mean_price FROM dd_long "
          f"WHERE fuel_type = '{PRODUCT}' GROUP BY date ORDER BY date",
          doubles=["mean_price"])
def q_national_evolution(spark, sf):
    return dashboard.national_evolution(select.filter_product(dd_long(spark, sf), PRODUCT))


@register("kpi_cards",
          f"WITH {MARTS_SQL} SELECT avg(mean_price) AS avg_price, min(mean_price) AS min_price, "
          f"max(mean_price) AS max_price, count(*) AS n_areas FROM latest "
          f"WHERE fuel_type = '{PRODUCT}'",
          doubles=["avg_price", "min_price", "max_price"])
def q_kpi_cards(spark, sf):
    return dashboard.kpi_cards(select.filter_product(latest(spark, sf), PRODUCT))


@register("overview_means",
          f"WITH {MARTS_SQL} SELECT " + csv(f"avg({p}_moyen) AS {p}_moyen" for p in P)
          + " FROM by_region",
          doubles=MEAN_DOUBLES)
def q_overview_means(spark, sf):
    return dashboard.overview_means(by_region(spark, sf), P)


@register("product_summary",
          f"WITH {MARTS_SQL} SELECT carburant, min(prix) AS prix_min, max(prix) AS prix_max, "
          "avg(prix) AS prix_moyen, stddev_samp(prix) AS ecart_type FROM ("
          + " UNION ALL ".join(f"SELECT '{p.upper()}' AS carburant, {p}_moyen AS prix "
                               f"FROM by_region WHERE {p}_moyen IS NOT NULL" for p in P)
          + ") t GROUP BY carburant",
          doubles=["prix_min", "prix_max", "prix_moyen", "ecart_type"])
def q_product_summary(spark, sf):
    return dashboard.product_summary(by_region(spark, sf), P)


@register("national_deviation",
          f"WITH {MARTS_SQL}, nat AS (SELECT avg(economy_moyen) AS moyenne_nationale "
          "FROM by_region) SELECT r.*, n.moyenne_nationale, "
          "r.economy_moyen - n.moyenne_nationale AS ecart, "
          "((r.economy_moyen - n.moyenne_nationale) / NULLIF(n.moyenne_nationale, 0)) * 100 "
          f"AS ecart_pct FROM by_region r CROSS JOIN nat n "
          f"WHERE r.region_code IS DISTINCT FROM '{OTHER}' ORDER BY ecart",
          doubles=FULL_DOUBLES + ["moyenne_nationale", "ecart", "ecart_pct"])
def q_national_deviation(spark, sf):
    return dashboard.national_deviation(by_region(spark, sf), "economy", other=OTHER)


@register("period_span",
          f"WITH {MARTS_SQL} SELECT min(prix_maj_date) AS date_min, max(prix_maj_date) AS "
          "date_max, strftime(min(prix_maj_date), '%d/%m/%Y') AS date_min_text, "
          "strftime(max(prix_maj_date), '%d/%m/%Y') AS date_max_text FROM by_date")
def q_period_span(spark, sf):
    return dashboard.period_span(by_date(spark, sf))


@register("first_last_change",
          f"WITH {MARTS_SQL} SELECT measure, min(prix_maj_date) AS first_date, "
          "max(prix_maj_date) AS last_date, arg_min_null(v, prix_maj_date) AS first_value, "
          "arg_max_null(v, prix_maj_date) AS last_value, "
          "arg_max_null(v, prix_maj_date) - arg_min_null(v, prix_maj_date) AS variation FROM ("
          + " UNION ALL ".join(f"SELECT '{p}_moyen' AS measure, prix_maj_date, {p}_moyen AS v "
                               "FROM by_date WHERE prix_maj_date IS NOT NULL" for p in P)
          + ") t GROUP BY measure",
          doubles=["first_value", "last_value", "variation"])
def q_first_last_change(spark, sf):
    return dashboard.first_last_change(by_date(spark, sf), P)


@register("histogram",
          f"WITH {B.OBS_WIDE_SQL}, st AS (SELECT min(economy) AS lo, max(economy) AS hi, "
          "avg(economy) AS mean, (max(economy) - min(economy)) / 20 AS width FROM obs_wide), "
          "b AS (SELECT CAST(least(19, coalesce(CAST(floor((economy - lo) / "
          "CASE WHEN width > 0 THEN width END) AS INTEGER), 0)) AS INTEGER) AS bin "
          "FROM obs_wide, st WHERE economy IS NOT NULL), "
          "c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin) "
          "SELECT CAST(g.bin AS INTEGER) AS bin, st.lo + g.bin * st.width AS bin_start, "
          "st.lo + (g.bin + 1) * st.width AS bin_end, coalesce(c.n, 0) AS n, st.mean "
          "FROM (SELECT range AS bin FROM range(20)) g CROSS JOIN st "
          "LEFT JOIN c ON c.bin = g.bin",
          doubles=["bin_start", "bin_end", "mean"])
def q_histogram(spark, sf):
    return dashboard.histogram(W(spark, sf), "economy", bins=20)


@register("box_stats",
          f"WITH {B.OBS_WIDE_SQL}, rdim AS ({REGION_DIM_SQL}) "
          "SELECT coalesce(d.region_name, 'Inconnu') AS region_name, min(economy) AS min, "
          "quantile_cont(economy, 0.25) AS q1, quantile_cont(economy, 0.5) AS median, "
          "quantile_cont(economy, 0.75) AS q3, max(economy) AS max, count(*) AS n "
          "FROM obs_wide w LEFT JOIN rdim d ON w.region_code = d.region_code "
          "WHERE economy IS NOT NULL GROUP BY coalesce(d.region_name, 'Inconnu')",
          doubles=["min", "q1", "median", "q3", "max"])
def q_box_stats(spark, sf):
    named = lookups.lookup_region_name(W(spark, sf), region_dim(spark, sf))
    return dashboard.box_stats(named, "economy", group="region_name")


_SCALE_SQL = (f", sl AS (SELECT * FROM latest WHERE fuel_type = '{PRODUCT}'), "
              "sc AS (SELECT quantile_cont(mean_price, 0.05) AS vmin, "
              "quantile_cont(mean_price, 0.95) AS vmax FROM sl), "
              "st AS (SELECT avg(mean_price) AS mean, count(*) AS n FROM sl)")


@register("price_scale",
          f"WITH {MARTS_SQL}{_SCALE_SQL} SELECT vmin, vmax, vmax - vmin AS price_range, "
          + csv(f"vmin + (vmax - vmin) * {k / 4.0} AS tick_{k + 1}" for k in range(5))
          + ", mean, n FROM sc CROSS JOIN st",
          doubles=["vmin", "vmax", "price_range", "mean"] + [f"tick_{k}" for k in range(1, 6)])
def q_price_scale(spark, sf):
    return dashboard.price_scale(select.filter_product(latest(spark, sf), PRODUCT))


@register("distinct_areas",
          f"WITH {B.OBS_WIDE_SQL} SELECT count(DISTINCT departement) AS n_distinct FROM obs_wide")
def q_distinct_areas(spark, sf):
    return dashboard.distinct_areas(W(spark, sf))


# ------------------------------------------------------------ map tables

def _popup_sql(cols, doubles):
    parts = []
    for c in cols:
        txt = (f"printf('{c}: %.3f €/L', {rnd(c, 3)})" if c in doubles
               else f"'{c}: ' || CAST({c} AS VARCHAR)")
        parts.append(f"CASE WHEN {c} IS NOT NULL THEN {txt} END")
    return f"concat_ws(chr(10), {csv(parts)})"


_POINTS_SQL = (f"WITH {B.OBS_WIDE_SQL}{FEAT_PART}{BOUNDS_SQL}, "
               "anom AS (SELECT f.*, (" + " OR ".join(
                   f"coalesce(f.{p} < b.{p}_lower OR f.{p} > b.{p}_upper, false)" for p in P)
               + ") AS has_any_anomaly FROM feat f CROSS JOIN bounds b), "
               f"geo AS (SELECT *, {B.LAT_SQL} AS latitude, {B.LON_SQL} AS longitude FROM anom) "
               "SELECT id, prix_maj_date, latitude, longitude, "
               "CASE WHEN coalesce(has_any_anomaly, false) THEN 'red' "
               "WHEN coalesce(economy_diff_region < 0, false) THEN 'green' ELSE 'blue' END AS color, "
               f"{_popup_sql(['departement', 'economy', 'small'], {'economy', 'small'})} AS popup "
               "FROM geo WHERE latitude IS NOT NULL AND longitude IS NOT NULL "
               f"ORDER BY {_md5_sql(['id', 'prix_maj_date'])}, id, prix_maj_date LIMIT 5000")


@register("station_points", _POINTS_SQL, doubles=["latitude", "longitude"])
def q_station_points(spark, sf):
    from ..operators import anomaly, features
    w = features.group_compare(W(spark, sf), P)
    w = features.competitive_flags(w, ["economy"])
    w = anomaly.detect_anomalies(w, P)
    g = B.with_coordinates(w)
    return station_points(g, popup_cols=["departement", "economy", "small"],
                          color_by="has_any_anomaly", competitive="competitive_economy",
                          key=["id", "prix_maj_date"])


@register("heat_points",
          f"{_GEO_SQL} SELECT latitude, longitude, economy FROM geo WHERE latitude IS NOT NULL "
          "AND longitude IS NOT NULL AND economy IS NOT NULL",
          doubles=["latitude", "longitude", "economy"])
def q_heat_points(spark, sf):
    return heat_points(B.with_coordinates(W(spark, sf)), weight="economy")


_AREAS_SQL = (f", areas AS (SELECT n_name AS departement FROM nation UNION ALL SELECT '{NO_DATA_AREA}'), "
              f"prices AS (SELECT * FROM latest WHERE fuel_type = '{PRODUCT}'), "
              "tbl AS (SELECT a.departement, p.mean_price, p.nombre_stations, "
              "p.mean_price IS NOT NULL AS has_data FROM areas a LEFT JOIN prices p "
              "ON a.departement = p.departement)")


def _prices(spark, sf):
    return select.filter_product(latest(spark, sf), PRODUCT)


def _areas(spark, sf):
    return B.table(spark, sf, "nation").select(F.col("n_name").alias("departement"))


def _areas_and_one(spark, sf):
    areas = _areas(spark, sf)
    return areas.union(areas.agg(F.lit(NO_DATA_AREA)))


@register("choropleth_table", f"WITH {MARTS_SQL}{_AREAS_SQL} SELECT * FROM tbl",
          doubles=["mean_price"])
def q_choropleth_table(spark, sf):
    return choropleth_table(_areas_and_one(spark, sf), _prices(spark, sf))


@register("choropleth_bands",
          f"WITH {MARTS_SQL}{_AREAS_SQL}, sc AS (SELECT quantile_cont(mean_price, 0.05) AS vmin, "
          "quantile_cont(mean_price, 0.95) AS vmax FROM prices) "
          "SELECT t.*, CASE WHEN t.mean_price IS NULL OR sc.vmax <= sc.vmin THEN NULL ELSE "
          "greatest(0.0, least(1.0, (t.mean_price - sc.vmin) / (sc.vmax - sc.vmin))) END AS band "
          "FROM tbl t CROSS JOIN sc",
          doubles=["mean_price", "band"])
def q_choropleth_bands(spark, sf):
    prices = _prices(spark, sf)
    return choropleth_bands(choropleth_table(_areas_and_one(spark, sf), prices),
                            dashboard.price_scale(prices))


@register("region_names_strict",
          f"WITH {MARTS_SQL} SELECT r.region_code, d.region_name, r.nombre_stations "
          f"FROM by_region r LEFT JOIN (SELECT * FROM rdim WHERE region_code <> '{OTHER}') d "
          "ON r.region_code = d.region_code")
def q_region_names_strict(spark, sf):
    names = region_dim(spark, sf).filter(F.col("region_code") != OTHER)
    out = lookups.region_names_strict(by_region(spark, sf), names)
    return out.select("region_code", "region_name", "nombre_stations")
