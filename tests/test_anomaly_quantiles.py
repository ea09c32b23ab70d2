"""Quantiles (exact and sketch) and IQR flags (A1-A5)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.operators import anomaly, quantiles
from pricelens.operators.quantiles import approx_quantiles, exact_quantiles


def test_exact_quantiles_match_numpy_with_hot_group(spark):
    rng = np.random.default_rng(7)
    rows = []
    for g, n in (("hot", 3000), ("a", 700), ("b", 1), ("c", 40)):
        vals = np.round(rng.normal(10, 3, n), 2)          # many duplicates
        rows += [(g, float(v)) for v in vals]
    rows += [("a", None)] * 50
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    got = {r.g: r for r in exact_quantiles(df, "v", probs, groups=["g"], accuracy=50).collect()}
    for g in ("hot", "a", "b", "c"):
        vals = np.array([v for k, v in rows if k == g and v is not None])
        for q in probs:
            want = np.percentile(vals, q * 100)          # linear interpolation
            assert abs(got[g][f"v_p{int(q * 100):02d}"] - want) < 1e-9


def test_exact_quantiles_global_and_empty(spark):
    df = spark.createDataFrame([(float(x),) for x in range(1, 11)], "v double")
    r = exact_quantiles(df, "v", [0.25, 0.75], names=["q1", "q3"]).collect()
    assert len(r) == 1 and abs(r[0].q1 - 3.25) < 1e-12 and abs(r[0].q3 - 7.75) < 1e-12
    empty = spark.createDataFrame([(None,)], "v double")
    r = exact_quantiles(empty, "v", [0.5], names=["m"]).collect()
    assert len(r) == 1 and r[0].m is None


@pytest.mark.parametrize("bound", [1, 7, 100])
def test_brackets_are_narrowed_whatever_the_ties(spark, bound):
    """Heavy ties, ties at the wanted rank, skewed and tiny groups: many rounds."""
    rng = np.random.default_rng(bound)
    groups = {"ties": np.repeat([1.0, 2.0, 3.0], 900), "mostly": np.r_[np.full(2000, 5.0), rng.normal(5, 1, 900)],
              "distinct": rng.permutation(4000) / 8, "skew": np.exp(rng.normal(0, 6, 2500)), "one": np.array([4.0]),
              None: np.r_[rng.normal(0, 1, 300), np.full(700, 0.25)]}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 1.0]
    names = [f"q{i}" for i in range(len(probs))]
    got = {r.g: r for r in exact_quantiles(df, "v", probs, groups=["g"], names=names, accuracy=60, bound=bound).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        for n, q in zip(names, probs):
            assert got[g][n] == pytest.approx(np.percentile(vs, q * 100), rel=1e-12, abs=1e-12)


def test_no_window_is_wider_than_the_bound(spark, monkeypatch):
    """Ten million distinct values, one of them repeated ten million times more."""
    n, bound, widest = 10_000_000, 500, []
    narrowed = quantiles._narrowed

    def run(cells, ranks, keys, b):
        out = narrowed(cells, ranks, keys, b)
        widest.append(out.groupBy(*keys).agg(F.count("_v").alias("d")).agg(F.max("d")).first()[0])
        return out
    monkeypatch.setattr(quantiles, "_narrowed", run)
    df = spark.range(n).select((F.col("id") * 7919 % n).cast("double").alias("v"))
    df = df.union(spark.range(n).select(F.lit(123_456.0)))
    r = exact_quantiles(df, "v", [0.25, 0.75], names=["a", "b"], accuracy=1000, bound=bound).first()
    assert r.a == 123_456.0 and r.b == (2 * n - 1) * 0.75 - n
    assert widest and max(widest) <= bound


def test_approx_quantile_rank_error(spark):
    vals = [float(x) for x in range(10000)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = approx_quantiles(df, "v", [0.25, 0.75], accuracy=1000).collect()[0]
    # rank error at most n / accuracy
    assert abs(r.v_p25 - 2500) <= 10 and abs(r.v_p75 - 7500) <= 10


def test_iqr_flags(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, None]
    df = spark.createDataFrame([(str(i), v, None) for i, v in enumerate(vals)],
                               "id string, gazole double, e85 double")
    out = anomaly.detect_anomalies(df, ["gazole", "e85"])
    got = {r.id: (r.is_outlier_gazole, r.is_outlier_e85, r.has_any_anomaly) for r in out.collect()}
    assert got["5"] == (True, False, True)             # 100 is above Q3 + 1.5 IQR
    assert got["6"] == (False, False, False)           # NULL value -> not an outlier
    assert sum(1 for v in got.values() if v[2]) == 1   # all-NULL column flags nothing
    b = anomaly.iqr_bounds(df, ["gazole", "e85"]).collect()[0]
    assert (b.gazole_q1, b.gazole_q3) == (2.25, 4.75) and b.e85_q1 is None
    ba = anomaly.iqr_bounds(df, ["gazole"], method="approx", accuracy=100).collect()[0]
    assert ba.gazole_q1 in vals and ba.gazole_q3 in vals


def test_outlier_rate_and_by_region(spark):
    df = spark.createDataFrame(
        [("r1", True, True), ("r1", False, True), ("r2", False, False), ("r2", False, False)],
        "region_name string, is_outlier_gazole boolean, has_any_anomaly boolean")
    rates = {r["product"]: r for r in anomaly.outlier_rate(df).collect()}
    assert rates["gazole"].n_outliers == 1 and rates["any"].n_outliers == 2
    assert rates["any"].pct_outliers == 50.0
    by = {r.region_name: r.n_anomalies for r in anomaly.anomalies_by_region(df).collect()}
    assert by == {"r1": 2, "r2": 0}
    empty = spark.createDataFrame([], "is_outlier_gazole boolean")
    assert anomaly.outlier_rate(empty).collect()[0].pct_outliers == 0.0


def test_quantile_table_full_join_keeps_groups(spark):
    from pricelens.operators.quantiles import quantile_table
    df = spark.createDataFrame([("a", 1.0, None), ("a", 3.0, None), ("b", None, 2.0),
                                (None, 5.0, 6.0)], "g string, x double, y double")
    got = {r.g: r for r in quantile_table(df, ["x", "y"], [0.5], groups=["g"]).collect()}
    assert set(got) == {"a", "b", None}
    assert got["a"].x_p50 == 2.0 and got["a"].y_p50 is None
    assert got["b"].x_p50 is None and got["b"].y_p50 == 2.0
    assert got[None].x_p50 == 5.0
