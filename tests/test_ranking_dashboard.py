"""Ranking (W1-W6), dashboard statistics (G7-G21), map tables."""

import hashlib
import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.operators import dashboard, lookups, marts, ranking, select
from pricelens.operators.mapdata import (choropleth_bands, choropleth_table, heat_points,
                                         station_points)


def stations(spark):
    rows = []
    for i in range(14):                       # ties at rank 10, NULLs in region 11
        rows.append((f"s{i:02d}", "11", 1.5 if i < 12 else None))
    rows += [("t1", "84", 1.9), ("t2", "84", None)]
    return spark.createDataFrame(rows, "id string, region_code string, gazole double")


def test_top_and_bottom_per_group(spark):
    df = stations(spark)
    top = ranking.top_n_per_group(df, tiebreak=["id"]).collect()
    r11 = sorted((r["rank"], r.id) for r in top if r.region_code == "11")
    assert [x[0] for x in r11] == list(range(1, 11))
    assert [x[1] for x in r11] == [f"s{i:02d}" for i in range(10)]   # ties broken by id
    bottom = ranking.bottom_n_per_group(df, tiebreak=["id"]).collect()
    assert all(r.gazole is not None for r in bottom)                  # NULLs never "cheapest"
    assert sorted(r.id for r in bottom if r.region_code == "84") == ["t1"]


def test_window_group_limit_in_plan(spark):
    plan = ranking.top_n_per_group(stations(spark))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "AdaptiveSparkPlan" in plan


def test_global_top_k_and_sample(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"),
                                  (F.col("id") % 97).cast("double").alias("v"))
    top = ranking.global_top_k(df, value="v", k=5, tiebreak=["id"]).collect()
    assert [r.v for r in top] == [96.0] * 5
    s1 = {r.id for r in ranking.bounded_sample(df, n=100, key=["id"]).collect()}
    s2 = {r.id for r in ranking.bounded_sample(df.repartition(7), n=100, key=["id"]).collect()}
    assert len(s1) == 100 and s1 == s2                 # independent of partitioning
    # brute force: the 100 smallest seeded hashes
    ids = [r.id for r in df.select("id").collect()]
    want = set(sorted(ids, key=lambda i: (hashlib.md5(f"{i}|42".encode()).hexdigest(), i))[:100])
    assert s1 == want
    assert ranking.bounded_sample(df, n=5000, key=["id"]).count() == 1000
    # many rows for an entity: the sample takes rows, not entities
    rows = spark.range(5000).select((F.col("id") % 100).alias("id"), F.col("id").alias("day"))
    got = ranking.bounded_sample(rows, n=500, key=["id", "day"]).collect()
    assert len(got) == 500 and len({r.id for r in got}) > 90
    with pytest.raises(TypeError):
        ranking.bounded_sample(rows, n=500)


def test_bounded_sample_writes_only_the_chosen_keys(spark, monkeypatch):
    written = []
    inner = ranking.materialize
    monkeypatch.setattr(ranking, "materialize", lambda df, name="t": written.append(df.columns) or inner(df, name))
    df = spark.range(4000).selectExpr("id", "CASE WHEN id % 9 = 0 THEN NULL ELSE id % 50 END AS day", "id * 2 AS v")
    got = ranking.bounded_sample(df, n=200, key=["id", "day"])
    want = ranking.bounded_sample(df, n=200, key=["id", "day"], prefilter=False)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    assert written == [["__k0", "__k1"]] and got.columns == df.columns


def test_histogram_and_scale(spark):
    vals = [1.0, 2.0, 2.5, 3.0, 10.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    h = {r.bin: r for r in dashboard.histogram(df, "v", bins=20).collect()}
    assert len(h) == 20 and sum(r.n for r in h.values()) == 5
    assert h[19].n == 1                                # the maximum falls in the last bin
    assert abs(h[0].mean - 3.7) < 1e-12
    const = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    hc = {r.bin: r.n for r in dashboard.histogram(const, "v", bins=20).collect()}
    assert hc[0] == 2
    sc = dashboard.price_scale(df, "v").collect()[0]
    arr = np.array([1.0, 2.0, 2.5, 3.0, 10.0])
    assert abs(sc.vmin - np.percentile(arr, 5)) < 1e-12
    assert abs(sc.vmax - np.percentile(arr, 95)) < 1e-12
    assert abs(sc.tick_3 - (sc.vmin + sc.vmax) / 2) < 1e-12 and sc.n == 6


def region_mart(spark):
    rows = [("11", 1.8, 1.9), ("84", 1.6, None), ("99", 2.0, 2.1)]
    return spark.createDataFrame(rows, "region_code string, gazole_moyen double, "
                                       "sp95_moyen double")


def test_national_deviation_and_overview(spark):
    dev = dashboard.national_deviation(region_mart(spark), "gazole").collect()
    assert [r.region_code for r in dev] == ["84", "11"]          # 99 hidden, sorted by gap
    assert abs(dev[0].moyenne_nationale - 1.8) < 1e-12            # mean includes 99
    ov = dashboard.overview_means(region_mart(spark), ["gazole", "sp95"]).collect()[0]
    assert abs(ov.sp95_moyen - 2.0) < 1e-12
    ps = {r.carburant: r for r in dashboard.product_summary(region_mart(spark),
                                                             ["gazole", "sp95"]).collect()}
    assert ps["GAZOLE"].prix_min == 1.6 and ps["SP95"].prix_max == 2.1


def test_region_lookups(spark):
    named = lookups.lookup_region_name(region_mart(spark)).collect()
    got = {r.region_code: r.region_name for r in named}
    assert got["99"] == "Autres" and got["11"] == "Île-de-France"
    strict = {r.region_code: r.region_name
              for r in lookups.region_names_strict(region_mart(spark)).collect()}
    assert strict["99"] is None
    unknown = spark.createDataFrame([("42",)], "region_code string")
    assert lookups.lookup_region_name(unknown).collect()[0].region_name == "Inconnu"


def test_first_last_and_period(spark):
    rows = [("2025-01-03", 1.7), ("2025-01-01", 1.5), (None, 9.9), ("2025-01-02", None)]
    df = spark.createDataFrame(rows, "d string, gazole_moyen double").select(
        F.col("d").cast("date").alias("prix_maj_date"), "gazole_moyen")
    r = dashboard.first_last_change(df, ["gazole"]).collect()[0]
    assert abs(r.variation - 0.2) < 1e-12
    p = dashboard.period_span(df).collect()[0]
    assert (p.date_min_text, p.date_max_text) == ("01/01/2025", "03/01/2025")


def test_rollup_and_latest_slice(spark):
    rows = [("01", "2025-01-01", "Gazole", 1.0, 10), ("03", "2025-01-01", "Gazole", 3.0, 5),
            ("75", "2025-01-01", "Gazole", 2.0, 7), ("01", "2025-01-02", "Gazole", 1.2, 10),
            ("XX", "2025-01-02", "Gazole", 9.0, 1), ("01", "2025-01-01", "SP95", 2.0, 4)]
    df = spark.createDataFrame(rows, "departement string, d string, fuel_type string, "
                                     "mean_price double, nombre_stations long") \
        .withColumn("date", F.col("d").cast("date")).drop("d")
    roll = {(r.region, str(r.date), r.fuel_type): r
            for r in dashboard.rollup_region(df).collect()}
    r = roll[("84", "2025-01-01", "Gazole")]
    assert r.mean_price == 2.0 and r.nombre_stations == 15     # unweighted mean, summed counts
    assert not any(k[0] is None for k in roll)                 # unmapped "XX" dropped
    latest = select.latest_slice(df).collect()
    assert {(r.departement, r.fuel_type) for r in latest} == {("01", "Gazole"), ("XX", "Gazole"),
                                                              ("01", "SP95")}
    yr = select.filter_year(df, 2025).count()
    assert yr == 6 and select.filter_year(df, 2024).count() == 0


def test_map_tables(spark):
    areas = spark.createDataFrame([("01",), ("02",), ("03",)], "departement string")
    prices = spark.createDataFrame([("01", 1.0, 3), ("03", 2.0, 4)],
                                   "departement string, mean_price double, nombre_stations long")
    t = choropleth_table(areas, prices)
    scale = dashboard.price_scale(prices)
    bands = {r.departement: (r.has_data, r.band) for r in choropleth_bands(t, scale).collect()}
    assert bands["02"] == (False, None)
    assert bands["01"][1] == 0.0 and bands["03"][1] == 1.0
    pts = spark.createDataFrame(
        [("a", 45.0, 5.0, 1.5, True, False), ("b", None, 5.0, 1.4, False, True),
         ("c", 44.0, 4.0, None, False, True)],
        "id string, latitude double, longitude double, gazole double, "
        "has_any_anomaly boolean, competitive_gazole boolean")
    sp = {r.id: r for r in station_points(pts, popup_cols=["id", "gazole"],
                                          color_by="gazole", key=["id"]).collect()}
    assert set(sp) == {"a", "c"} and sp["a"].color == "red" and sp["c"].color == "green"
    plain = station_points(pts, popup_cols=["id"], color_by="absent", key=["id"]).collect()
    assert {r.color for r in plain} == {"blue"}        # an absent column colours nothing
    assert sp["a"].popup == "id: a\ngazole: 1.500 €/L" and sp["c"].popup == "id: c"
    assert heat_points(pts).count() == 1


def test_run_summary_and_profiles(spark):
    df = spark.createDataFrame(
        [("11", "75", 2024, True), ("11", None, 2025, False), (None, "01", None, False)],
        "region_code string, departement string, annee int, has_any_anomaly boolean")
    s = marts.run_summary(df).collect()[0]
    assert (s.total_rows, s.n_regions, s.n_departements, s.n_years, s.n_anomalies) == (3, 2, 3, 2, 1)
    cs = {r.column: r for r in marts.column_stats(df, ["annee"]).collect()}
    assert cs["annee"]["count"] == 2 and cs["annee"]["mean"] == 2024.5
    tp = marts.table_profile(df, "t").collect()[0]
    assert tp.n_rows == 3 and tp.n_columns == 4
