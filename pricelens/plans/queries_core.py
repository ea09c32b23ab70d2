"""Queries for the core pipeline: pivot, marts, top/bottom per group."""

from __future__ import annotations

from ..operators import marts, ranking
from . import bindings as B
from .catalog import register

P = B.PRODUCTS
W = B.OBS_WIDE_SQL


def _full_stats_sql(products=P) -> str:
    parts = []
    for p in products:
        parts += [f"avg({p}) AS {p}_moyen", f"min({p}) AS {p}_min",
                  f"max({p}) AS {p}_max", f"stddev_samp({p}) AS {p}_stddev"]
    parts.append("count(*) AS nombre_stations")
    return ", ".join(parts)


def _mean_sql(products=P) -> str:
    return ", ".join([f"avg({p}) AS {p}_moyen" for p in products]
                     + ["count(*) AS nombre_stations"])


FULL_DOUBLES = [f"{p}_{s}" for p in P for s in ("moyen", "min", "max", "stddev")]
MEAN_DOUBLES = [f"{p}_moyen" for p in P]


@register("pivot_wide", f"WITH {W} SELECT * FROM obs_wide", doubles=P)
def q_pivot_wide(spark, sf):
    return B.obs_wide(spark, sf)


@register("agg_by_region",
          f"WITH {W} SELECT region_code, {_full_stats_sql()} FROM obs_wide GROUP BY region_code",
          doubles=FULL_DOUBLES)
def q_agg_by_region(spark, sf):
    return marts.agg_by_region(B.obs_wide(spark, sf), P)


@register("agg_by_department",
          f"WITH {W} SELECT departement, region_code, {_full_stats_sql()} FROM obs_wide "
          "GROUP BY departement, region_code",
          doubles=FULL_DOUBLES)
def q_agg_by_department(spark, sf):
    return marts.agg_by_department(B.obs_wide(spark, sf), P)


@register("agg_by_date",
          f"WITH {W} SELECT prix_maj_date, {_mean_sql()} FROM obs_wide GROUP BY prix_maj_date",
          doubles=MEAN_DOUBLES)
def q_agg_by_date(spark, sf):
    return marts.agg_by_date(B.obs_wide(spark, sf), P)


@register("agg_by_department_date",
          f"WITH {W} SELECT departement, region_code, prix_maj_date AS date, {_mean_sql()} "
          "FROM obs_wide GROUP BY departement, region_code, prix_maj_date",
          doubles=MEAN_DOUBLES)
def q_agg_by_department_date(spark, sf):
    return marts.agg_by_department_date(B.obs_wide(spark, sf), P)


@register("agg_by_year",
          f"WITH {W} SELECT annee, {_mean_sql()} FROM obs_wide GROUP BY annee ORDER BY annee",
          doubles=MEAN_DOUBLES)
def q_agg_by_year(spark, sf):
    return marts.agg_by_year(B.obs_wide(spark, sf), P)


@register("agg_by_department_year",
          f"WITH {W} SELECT departement, region_code, annee, {_mean_sql()} FROM obs_wide "
          "GROUP BY departement, region_code, annee ORDER BY departement, annee",
          doubles=MEAN_DOUBLES)
def q_agg_by_department_year(spark, sf):
    return marts.agg_by_department_year(B.obs_wide(spark, sf), P)


_RANK_COLS = "id, departement, region_code, economy"


@register("top_n_per_group",
          f"WITH {W} SELECT {_RANK_COLS}, CAST(rank AS INTEGER) AS rank FROM ("
          "SELECT *, row_number() OVER (PARTITION BY region_code "
          "ORDER BY economy DESC NULLS LAST, id, prix_maj_date) AS rank FROM obs_wide) t "
          "WHERE rank <= 10",
          doubles=["economy"])
def q_top_n(spark, sf):
    return ranking.top_n_per_group(
        B.obs_wide(spark, sf), group="region_code", value=B.HEADLINE, n=10,
        columns=["id", "departement", "region_code", B.HEADLINE],
        tiebreak=["id", "prix_maj_date"])


@register("bottom_n_per_group",
          f"WITH {W} SELECT {_RANK_COLS}, CAST(rank AS INTEGER) AS rank FROM ("
          "SELECT *, row_number() OVER (PARTITION BY region_code "
          "ORDER BY economy ASC, id, prix_maj_date) AS rank FROM obs_wide "
          "WHERE economy IS NOT NULL) t WHERE rank <= 10",
          doubles=["economy"])
def q_bottom_n(spark, sf):
    return ranking.bottom_n_per_group(
        B.obs_wide(spark, sf), group="region_code", value=B.HEADLINE, n=10,
        columns=["id", "departement", "region_code", B.HEADLINE],
        tiebreak=["id", "prix_maj_date"])
