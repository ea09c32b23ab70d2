"""Work done once: exchanges, projections and files of the job's and increments' steps."""

import glob
import json
import math
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from pricelens.functions import sizing
from pricelens.functions.columns import rounded
from pricelens.operators import anomaly, features, reshape
from pricelens.plans import bindings as B
from pricelens.plans import incremental, pipeline, queries_job
from pricelens.plans.queries_increments import LAYOUT
from pricelens.sources import files, landing


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rounded_is_round(spark):
    odd = [0.0, -0.0, 0.00005, -0.00005, 1.00005, -1.00005, 0.12345, 2.5, -2.5, 0.125, 1.005, 1e5 + 0.00005,
           999999.99995, 1e6, 1e15 + 0.3, 1e300, float("inf"), float("-inf"), float("nan"), None]
    odd += [k / 1e5 + d for k in range(-40, 40) for d in (0.0, 1e-9, -1e-9)]
    df = spark.createDataFrame([(v, None if v is None else v * 3) for v in odd], "a double, b double")
    for digits in (0, 2, 3, 4, 6):
        got = df.select(rounded(["a", "b"], digits).alias("r"), F.round("a", digits).alias("a"),
                        F.round("b", digits).alias("b")).collect()
        for r in got:
            for x, y in zip(r.r, (r.a, r.b)):
                assert x == y or (x is not None and math.isnan(x) and math.isnan(y))
                assert x is None or math.copysign(1, x) == math.copysign(1, y)


def test_json_arrays_without_exchange(spark, tmp_path, monkeypatch):
    plans, real = [], type(spark.range(1)).mapInArrow
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow",
                        lambda self, *a, **b: plans.append(out := real(self, *a, **b)) or out)
    df = spark.range(0, 23, 1, 3).select("id", F.concat(F.lit('}] "{,\n'), F.col("id")).alias("t"))
    landing.write_json_array(df, f"{tmp_path}/a", rows_per_file=3, compression="gzip")
    assert "Exchange" not in _plan(plans[0])
    # parts of 7, 8 and 8 rows in arrays of at most 3
    assert len(glob.glob(f"{tmp_path}/a/part-*.txt.gz")) == 9
    back = files.scan_json(spark, f"{tmp_path}/a", "id long, t string", glob="part-*.txt.gz")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    landing.write_json_array(df.filter("id < 0"), f"{tmp_path}/none")
    assert files.scan_json(spark, f"{tmp_path}/none", "id long, t string", glob="part-*.txt").count() == 0


def test_pivot_names_and_order_once(spark):
    df = spark.createDataFrame([(1, "A b", 1.0, 1), (1, "a-B", 2.0, 2), (1, "C", 3.0, 1), (None, "C", None, 1)],
                               "id int, n string, v double, o int")
    out = reshape.pivot_wide(df, ["a_b", "c"], name="n", value="v", order=["o"], keys=["id"])
    assert _plan(out).count("translate(") == 1
    assert sorted(map(str, out.collect())) == sorted(["Row(id=1, a_b=2.0, c=3.0)", "Row(id=None, a_b=None, c=None)"])


def test_lag_window_and_join_share_an_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(e, d, v) for e in ("a", None) for d, v in (
            (None, 9.0), ("2024-01-05", 1.0), ("2024-01-06", None), ("2024-03-01", 4.0), ("2024-03-02", 6.0))],
            "id string, d string, v double").withColumn("d", F.col("d").cast("date"))
        out = features.lag_change(df, "v", order=("d",), out="c")
        rows = [x for x in re.findall(r"Exchange hashpartitioning\(([^\n]*)", _plan(out)) if x.startswith("__key#")]
        assert len(rows) == 2                       # the rows once, their last values once
        got = {(r.id, str(r.d)): r.c for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for e in ("a", None):
        assert [got[e, d] for d in ("None", "2024-01-05", "2024-01-06", "2024-03-01", "2024-03-02")] == [
            None, -8.0, None, None, 2.0]


def test_merged_states_through_one_exchange(spark):
    state = spark.createDataFrame([(1, "d", "r", None, 2024, p, (1, 2.0)) for p in ("2024-01", "none")],
                                  "id int, departement string, region_code string, prix_maj_date date, annee int, "
                                  "period string, economy struct<o0:int,v:double>")
    for p in B.PRODUCTS[1:]:
        state = state.withColumn(p, F.col("economy"))
    out = incremental._greater(state.unionByName(state), LAYOUT)
    assert _plan(out).count("Exchange") == 1
    assert out.count() == 2 and set(out.columns) == set(state.columns)


def test_a_merge_aggregates_and_sorts_once(spark, tmp_path, monkeypatch):
    """The increment's rows meet the old states unaggregated, and the aggregate's sort
    is the one the files need."""
    plans, real = [], incremental.materialize
    monkeypatch.setattr(incremental, "materialize", lambda df, *a: plans.append(_plan(df)) or real(df, *a))
    rows = [(e, "d", "r", None, None, "Economy", v, t, 1, 1, 1) for e, v, t in (
        (1, 1.0, "a"), (1, 2.0, "b"), (2, None, "c"), (3, 5.0, None))]
    schema = ("id int, departement string, region_code string, prix_maj_date date, annee int, prix_nom string, "
              "prix_valeur double, prix_maj string, l_orderkey long, l_linenumber int, l_partkey long")
    for some in (rows, rows[:1], [(2, *rows[0][1:])]):
        incremental.merge(spark, str(tmp_path), spark.createDataFrame(some, schema), LAYOUT)
    assert len(plans) == 3 and not any(x in p for p in plans for x in ("Exchange", "Aggregate"))
    got = {r.id: r.economy for r in incremental.wide(spark, str(tmp_path), LAYOUT).collect()}
    assert got == {1: 2.0, 2: 1.0, 3: 5.0}
    state = incremental._lifted(incremental.observed(spark.createDataFrame(rows, schema), LAYOUT), LAYOUT)
    out = incremental._greater(state, LAYOUT).sortWithinPartitions("period", "prix_maj_date")
    assert out.count() == 3 and len(out.collect()) == 3
    assert len(re.findall(r"\bSort \[", _plan(out).split("Initial Plan")[0])) == 1


LONG = "id string, k string, d string, n string, v double, o string"


def test_a_dealt_pivot_and_its_lag_share_an_exchange(spark):
    """Long rows are shuffled once for the pivot and the change behind it; the rows are those
    of the pivot that is written first."""
    rows = [(e, k, d, p, v, o) for e in ("a", "b", None) for k in ("x", None) for d, p, v, o in (
        (None, "P", 9.0, "1"), ("2024-01-05", "P", 1.0, "9"), ("2024-01-05", "p ", 2.0, "10"),
        ("2024-01-06", "P", None, "1"), ("2024-01-06", "Q-r", 5.0, "1"), ("2024-03-01", "P", 4.0, "1"),
        ("2024-03-02", "other", 6.0, "1"), ("2024-05-02", "P", 7.0, None))]
    df = (spark.createDataFrame(rows, LONG).withColumn("d", F.col("d").cast("date"))
          .withColumn("x", F.when(F.col("k") == "x", -0.0)))
    how = dict(name="n", value="v", order=["o"], keys=["id", "d", "k", "x"])
    lag = dict(order=("d",), tiebreak=["k", "x"], out="c")
    plain = sizing.materialize(reshape.pivot_wide(df, ["P", "Q-r"], **how))
    want = features.lag_change(plain, "p", **lag)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = reshape.pivot_wide(df, ["P", "Q-r"], dealt=features.range_key("id", "d", "date"), **how)
        got = features.lag_change(dealt, "p", dealt=reshape.DEALT, **lag)
        assert got.columns == want.columns
        found = got.collect()
        plan = _plan(got).split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(found) == 36 and sorted(map(str, found)) == sorted(map(str, want.collect()))
    assert any(r.c == 2.0 - 9.0 for r in found)
    # the second reader of the long rows takes the first one's exchange
    assert plan.count("ReusedExchange") == 1
    assert plan.count("REPARTITION_BY_COL") == 2 and len(re.findall(r"Exchange hashpartitioning\(__dealt", plan)) <= 2


def test_of_the_same_order_the_greatest_value_counts(spark):
    rows = [("a", "x", "2024-03-01", "P", v, "1") for v in (3.5, 4.0, None, 3.0)]
    df = spark.createDataFrame(rows, LONG).withColumn("d", F.col("d").cast("date"))
    for some in (df, df.orderBy("v"), df.orderBy(F.desc("v"))):
        out = reshape.pivot_wide(some, ["P"], name="n", value="v", order=["o"], keys=["id", "d"],
                                 dealt=features.range_key("id", "d", "date"))
        assert [r.p for r in out.collect()] == [4.0]


def _shuffles(spark):
    dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}


def _gone(spark, before):
    for _ in range(50):
        if not _shuffles(spark) - before:
            return True
        time.sleep(0.2)
    return False


def test_shuffle_files_go_with_their_query(spark):
    before = _shuffles(spark)
    conf = spark.conf.get(sizing._CLEANUP)
    dealt = spark.range(1000).repartition(3, "id")
    with sizing.brief_shuffles(spark):
        assert sizing.materialize(dealt).count() == 1000
    assert _gone(spark, before)
    with pytest.raises(KeyError), sizing.brief_shuffles(spark):
        raise KeyError
    assert spark.conf.get(sizing._CLEANUP) == conf


def _tables(spark, name):
    base = sizing.scratch_path(spark, "materialized").split(":", 1)[-1]
    return set(glob.glob(f"{base}/{name}-*"))


def test_quantile_values_go_once_counted(spark):
    before = _tables(spark, "quantile-values")
    df = spark.range(1000).select(F.col("id").cast("double").alias("a"))
    bounds = anomaly.iqr_bounds(df, ["a"])
    assert not _tables(spark, "quantile-values") - before
    assert (bounds.first().a_q1, bounds.first().a_q3) == (249.75, 749.25)


def test_the_job_holds_little_at_once(spark, tmp_path, monkeypatch):
    """Rows are dealt out for the detailed table while they are narrow, the landed rows are gone
    by then, and no shuffle file outlives the job."""
    plans, real = [], files.write_table
    landed, shuffles = _tables(spark, "landed"), _shuffles(spark)

    def write(df, path, **options):
        plans.append(_plan(df))
        assert not _tables(spark, "landed") - landed
        real(df, path, **options)
    monkeypatch.setattr(files, "write_table", write)
    rows = [{"id": str(i % 9), "cp": "75001" if i % 2 else "20000", "ville": "v", "prix_nom": "Gazole", "prix_id": str(i),
             "prix_valeur": str(1 + i / 100), "prix_maj": f"2024-0{1 + i % 9}-11T08:00:00"} for i in range(90)]
    os.makedirs(tmp_path / "raw")
    (tmp_path / "raw" / "carburants_2025-01-15.json").write_text(json.dumps(rows))
    pipeline.run_detailed(spark, f"{tmp_path}/raw", f"{tmp_path}/out")
    plan, = plans
    assert plan.count("REBALANCE") == 1
    below = plan[plan.index("REBALANCE"):]
    assert "Scan parquet" in below.split("\n")[1] and "gazole_evolution" in below.split("\n")[1]
    assert _gone(spark, shuffles)
    back = files.load_detailed(spark, f"{tmp_path}/out")
    assert back.count() == len({(r["id"], r["cp"], r["prix_maj"]) for r in rows})


def test_discard_where_a_folder_is_written_otherwise_in_a_uri(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sizing, "scratch_path", lambda _, name: f"{tmp_path}/a b/{name}")
    sizing.discard(sizing.materialize(spark.range(3), "t"))
    assert not os.listdir(tmp_path / "a b" / "materialized")


def test_landing_shuffles_narrow_rows_and_keeps_no_files(spark, tmp_path):
    """Rows cross the joins with their value instead of what it is made of; a NULL or zero
    quantity gives no value."""
    lines = [(o, 1, 1, o, q, 10.0) for o, q in ((1, 4.0), (2, 0.0), (3, None))]
    tables = {"lineitem": spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                                                       "l_quantity double, l_extendedprice double")
              .withColumn("l_shipdate", F.lit("1995-03-04 00:00:00").cast("timestamp_ntz")),
              "part": spark.createDataFrame([(1, "PROMO")], "p_partkey long, p_type string"),
              "supplier": spark.createDataFrame([(1, "S", 0)], "s_suppkey long, s_name string, s_nationkey int"),
              "nation": spark.createDataFrame([(0, "N")], "n_nationkey int, n_name string")}
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    before = _shuffles(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(B.raw_snapshot(spark, str(tmp_path)))
        base = queries_job._land(spark, str(tmp_path), "narrow")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt, = [x.split("\n")[1] for x in plan.split("Exchange hashpartitioning(l_partkey")[1:]]
    assert "AS value" in dealt
    back = files.scan_jsonl(spark, f"{base}/raw", glob="part-*").collect()
    assert sorted((r.prix_id, r.prix_valeur) for r in back) == [("1-1-1", "2.5"), ("2-2-1", None), ("3-3-1", None)]
    assert _gone(spark, before)
