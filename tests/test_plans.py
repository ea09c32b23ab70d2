"""Plan-shape tests: the physical properties the scale design relies on."""

import os

from pyspark.sql import functions as F

from pricelens.operators import features, marts, ranking, select


def plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def wide(spark, tmpdir_path):
    rows = [(f"s{i % 50}", "84" if i % 3 else "11", f"d{i % 7}",
             f"2025-01-{1 + i % 28:02d}", 1.0 + (i % 17) / 10.0) for i in range(600)]
    df = spark.createDataFrame(rows, "id string, region_code string, departement string, "
                                     "d string, gazole double") \
        .withColumn("prix_maj_date", F.col("d").cast("date")).drop("d") \
        .withColumn("annee", F.year("prix_maj_date"))
    path = os.path.join(tmpdir_path, "wide")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_group_mean_is_broadcast_not_shuffled(spark, tmpdir_path):
    p = plan(features.group_compare(wide(spark, tmpdir_path), ["gazole"]))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_top_n_limits_before_shuffle(spark, tmpdir_path):
    p = plan(ranking.top_n_per_group(wide(spark, tmpdir_path), tiebreak=["id", "prix_maj_date"]))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_marts_partial_aggregation_and_single_scan(spark, tmpdir_path):
    w = wide(spark, tmpdir_path)
    assert "partial_avg" in plan(marts.agg_by_region(w, ["gazole"]))
    agg = w.groupingSets([["region_code"], ["departement", "region_code"]],
                         "departement", "region_code").agg(F.avg("gazole"))
    p = plan(agg)
    assert "Expand" in p and p.count("FileScan parquet") == 1


def test_year_filter_pushed_to_scan(spark, tmpdir_path):
    p = plan(select.filter_year(wide(spark, tmpdir_path), 2025, date="prix_maj_date"))
    assert "PushedFilters: [IsNotNull(prix_maj_date), GreaterThanOrEqual(prix_maj_date" in p


def test_global_top_k_is_take_ordered(spark, tmpdir_path):
    p = plan(ranking.global_top_k(wide(spark, tmpdir_path), value="gazole", k=5,
                                  tiebreak=["id"]))
    assert "TakeOrderedAndProject" in p


def test_scalar_statistics_attach_without_join(spark, tmpdir_path):
    # IQR bounds and histogram range are one-row aggregates read as scalar
    # subqueries: the big side is neither joined nor shuffled for them
    from pricelens.operators import anomaly, dashboard
    w = wide(spark, tmpdir_path)
    for df in (anomaly.detect_anomalies(w, ["gazole"]), dashboard.histogram(w, "gazole")):
        p = plan(df)
        assert "Subquery" in p
        assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_broadcast_if_small_checks_rows_and_bytes(spark):
    from pricelens.functions.sizing import broadcast_if_small
    big = spark.range(100).select((F.col("id") % 10).alias("k"), "id")
    small = spark.range(10).withColumnRenamed("id", "k")

    def hinted(side, **kw):
        p = plan(big.join(broadcast_if_small(small, **kw), "k", "left"))
        return "BroadcastHashJoin" in p
    assert hinted(small)
    # a bound the side exceeds drops the hint (the planner then picks by statistics)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert hinted(small)
        assert not hinted(small, max_rows=5)
        assert not hinted(small, max_bytes=20)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_scalar_statistics_computed_once(spark, tmpdir_path):
    # six products x two bounds read one struct subquery: after execution
    # the repeated reads are ReusedSubquery, not separate jobs
    from pricelens.operators import anomaly
    w = wide(spark, tmpdir_path).withColumn("sp95", F.col("gazole") + 0.1)
    df = anomaly.detect_anomalies(w, ["gazole", "sp95"])
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedSubquery" in p
