"""Pivot / unpivot (R1-R6) and derived features."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricelens.operators import features, reshape

RAW = ["Gazole", "SP95", "SP-95 E", "GPLc"]


def long_rows(spark):
    rows = [
        # two updates of one product on one day: the later one wins
        ("1", "01", "84", "Gazole", 1.70, "2025-01-15T08:00:00", "a", "2025-01-15"),
        ("1", "01", "84", "Gazole", 1.75, "2025-01-15T18:00:00", "b", "2025-01-15"),
        # the later update is invalid (NULL): the latest *valid* value wins
        ("1", "01", "84", "SP95", 1.80, "2025-01-15T08:00:00", "c", "2025-01-15"),
        ("1", "01", "84", "SP95", None, "2025-01-15T20:00:00", "d", "2025-01-15"),
        # the same observation in two daily files
        ("2", "2A", "94", "GPLc", 0.99, "2025-01-15T09:00:00", "e", "2025-01-15"),
        ("2", "2A", "94", "GPLc", 0.99, "2025-01-15T09:00:00", "e", "2025-01-15"),
        # NULL product name: no column, row ignored
        ("2", "2A", "94", None, 1.23, "2025-01-15T09:00:00", "f", "2025-01-15"),
        ("2", "2A", "94", "SP-95 E", 1.90, "2025-01-16T09:00:00", "g", "2025-01-16"),
    ]
    return spark.createDataFrame(rows, "id string, departement string, region_code string, "
                                       "prix_nom string, prix_valeur double, prix_maj string, "
                                       "prix_id string, prix_maj_date string")


def test_pivot_latest_valid(spark):
    wide = reshape.pivot_wide(long_rows(spark), RAW)
    assert sorted(wide.columns) == sorted(["id", "departement", "region_code", "prix_maj_date",
                                           "gazole", "sp95", "sp_95_e", "gplc"])
    got = {(r.id, r.prix_maj_date): r for r in wide.collect()}
    assert len(got) == 3
    r = got[("1", "2025-01-15")]
    assert r.gazole == 1.75 and r.sp95 == 1.80 and r.gplc is None
    assert got[("2", "2025-01-15")].gplc == 0.99
    assert got[("2", "2025-01-16")].sp_95_e == 1.90


def test_pivot_unpivot_keeps_non_null_cells(spark):
    wide = reshape.pivot_wide(long_rows(spark), RAW)
    cells = {c: c for c in ["gazole", "sp95", "sp_95_e", "gplc"]}
    long = reshape.unpivot_long(wide, cells, ids=["id", "prix_maj_date"], variable="p",
                                value="v")
    n_cells = sum(sum(1 for c in cells if r[c] is not None) for r in wide.collect())
    assert long.count() == n_cells
    empty = reshape.unpivot_long(wide, {"nope": "x"}, ids=["id"])
    assert empty.count() == 0 and empty.columns == ["id", "fuel_type", "mean_price"]


def test_union_and_distinct(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 3.0)], "k int, b double")
    u = reshape.union_all([a, b])
    assert u.count() == 2 and set(u.columns) == {"k", "a", "b"}
    d = reshape.distinct_sorted(spark.createDataFrame([(3,), (1,), (3,), (None,)], "x int"), "x")
    assert [r.x for r in d.collect()] == [None, 1, 3]


def wide_rows(spark):
    rows = [("1", "84", 1.0, 2.0, "2025-01-01"), ("2", "84", 3.0, None, "2025-01-01"),
            ("1", "84", 2.0, 4.0, "2025-01-02"), ("3", "11", 5.0, 1.0, "2025-01-01"),
            ("4", None, 7.0, 7.0, "2025-01-01"), ("5", None, 9.0, None, "2025-01-01")]
    return spark.createDataFrame(rows, "id string, region_code string, gazole double, "
                                       "sp95 double, prix_maj_date string")


def test_row_means(spark):
    df = features.row_mean_available(features.row_mean(wide_rows(spark), ["gazole", "sp95"]),
                                     ["gazole", "sp95"])
    got = {(r.id, r.prix_maj_date): (r.prix_moyen_station, r.prix_moyen_disponible)
           for r in df.collect()}
    assert got[("1", "2025-01-01")] == (1.5, 1.5)
    assert got[("2", "2025-01-01")] == (None, 3.0)


def test_group_compare_flags_score(spark):
    df = features.group_compare(wide_rows(spark), ["gazole", "sp95"])
    df = features.competitive_flags(df, ["gazole", "sp95"])
    df = features.competitive_score(df, ["gazole", "sp95"])
    rows = {(r.id, r.prix_maj_date): r for r in df.collect()}
    r = rows[("1", "2025-01-01")]
    assert r.gazole_moy_region == 2.0          # mean of 1, 3, 2 over region 84, all dates
    assert r.gazole_diff_region == -1.0 and r.gazole_pct_vs_region == -50.0
    assert r.competitive_gazole is True and r.competitivity_score == 2
    # NULL region is its own group, like a window partition
    assert rows[("4", "2025-01-01")].gazole_moy_region == 8.0
    # flags are never NULL; the flag is true exactly when diff < 0
    for x in rows.values():
        assert x.competitive_sp95 in (True, False)
        assert x.competitive_sp95 == (x.sp95_diff_region is not None and x.sp95_diff_region < 0)


def test_lag_change(spark):
    df = features.lag_change(wide_rows(spark), "gazole", order=["prix_maj_date"])
    got = {(r.id, r.prix_maj_date): r.gazole_evolution for r in df.collect()}
    assert got[("1", "2025-01-01")] is None and got[("1", "2025-01-02")] == 1.0


def test_features_independent_of_partitioning(spark):
    base = wide_rows(spark)
    a = features.add_features(base, ["gazole", "sp95"], flagged=["gazole"])
    b = features.add_features(base.repartition(5), ["gazole", "sp95"], flagged=["gazole"])
    key = lambda r: (r.id, r.prix_maj_date)
    assert sorted(a.collect(), key=key) == sorted(b.collect(), key=key)


def test_hot_entity_pivot_means_lag_vs_brute_force(spark):
    # one entity holds a third of the rows; results must equal a pandas
    # brute force (latest valid value, rounded region mean, lag by date)
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(7)
    rows = []
    ents = [("hot", "11")] + [(f"e{i}", "11" if i % 2 else "84") for i in range(60)]
    for ent, reg in ents:
        n = 600 if ent == "hot" else 20
        for k in range(n):
            v = None if rng.random() < 0.1 else float(np.round(rng.uniform(1, 2), 2))
            day = 1 + int(rng.integers(0, 28))
            rows.append((ent, reg, ["Gazole", "SP95"][k % 2], v,
                         f"2025-01-{day:02d}T{k % 24:02d}:{k % 60:02d}:00", f"{ent}-{k}",
                         f"2025-01-{day:02d}"))
    schema = ("id string, region_code string, prix_nom string, prix_valeur double, "
              "prix_maj string, prix_id string, prix_maj_date string")
    long = spark.createDataFrame(rows, schema).repartition(6)
    wide = reshape.pivot_wide(long, ["Gazole", "SP95"])
    out = features.lag_change(features.group_compare(wide, ["gazole"]), "gazole",
                              order=["prix_maj_date"])
    got = {(r.id, r.prix_maj_date): (r.gazole, r.gazole_moy_region, r.gazole_evolution)
           for r in out.collect()}

    pdf = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
    valid = pdf[pdf.prix_valeur.notna()].sort_values(["prix_maj", "prix_id"])
    last = valid.groupby(["id", "region_code", "prix_maj_date", "prix_nom"]).prix_valeur.last()
    w = pdf[["id", "region_code", "prix_maj_date"]].drop_duplicates().set_index(
        ["id", "region_code", "prix_maj_date"])
    w["gazole"] = last.xs("Gazole", level="prix_nom")
    w = w.reset_index()
    means = w.groupby("region_code").gazole.mean()
    w = w.sort_values(["id", "prix_maj_date"])
    w["evo"] = w.gazole - w.groupby("id").gazole.shift(1)
    assert len(got) == len(w)
    for r in w.itertuples():
        g, m, e = got[(r.id, r.prix_maj_date)]
        assert (g is None and pd.isna(r.gazole)) or abs(g - r.gazole) < 1e-12
        assert abs(m - round(means[r.region_code], 3)) < 1e-9
        assert (e is None and pd.isna(r.evo)) or abs(e - r.evo) < 1e-9


@pytest.mark.parametrize("kind", ["date", "timestamp", "int"])
def test_lag_over_a_hot_entity(spark, kind):
    """One entity with a third of all rows, NULL values, dates and ids: equal to
    the plain window, and no task has more of it than a range of days."""
    rng = random.Random(4)
    rows = []
    for i in range(1500):
        entity = "hot" if i % 3 == 0 else rng.choice([None, "a", "b", "c"])
        day = None if rng.random() < 0.02 else rng.randint(-400, 900)
        rows.append((entity, day, i, None if rng.random() < 0.1 else float(rng.randint(1, 9))))
    df = spark.createDataFrame(rows, "id string, d int, k int, gazole double")
    at = {"date": F.date_add(F.lit("1970-03-01").cast("date"), F.col("d")), "int": F.col("d"),
          "timestamp": F.timestamp_seconds(F.col("d") * 40_000)}[kind]
    df = df.withColumn("day", at)
    got = features.lag_change(df, "gazole", order=["day"], tiebreak=["k"])
    w = Window.partitionBy("id").orderBy(F.col("day").asc_nulls_first(), "k")
    want = df.withColumn("gazole_evolution", F.col("gazole") - F.lag("gazole").over(w))
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    if kind == "date":
        ranges = df.groupBy("id", features.date_range("day", "date")).count()
        assert ranges.agg(F.max("count")).first()[0] < 60 < df.filter("id = 'hot'").count() / 5


def test_lag_shuffles_the_rows_once(spark):
    df = wide_rows(spark).withColumn("prix_maj_date", F.to_date("prix_maj_date"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = features.lag_change(df, "gazole", order=["prix_maj_date"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    # the rows, the carry aggregate, its window and its way back to the rows
    assert len([x for x in shuffles if "id#" in x and "__range" in x]) <= 3
    assert plan.count("partial_max_by") == 1
