"""Increments, sets of tables published at once, observed reports, clustered files."""

import glob
import json
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pricelens.operators import anomaly, clean, marts, reshape
from pricelens.plans import incremental, pipeline
from pricelens.sources import files, published

LONG = ("id string, departement string, region_code string, prix_maj_date date, annee int, prix_nom string, "
        "prix_valeur double, prix_maj string, prix_id string")
KEYS = ("id", "departement", "region_code", "prix_maj_date", "annee")
LAYOUT = incremental.Layout(keys=KEYS, order=("prix_maj", "prix_id"), products=("Gazole", "SP95"), headline="gazole",
                            top_n=3)


def long_rows(n=400, seed=1):
    rng, rows = random.Random(seed), []
    import datetime
    for i in range(n):
        day = None if rng.random() < 0.03 else datetime.date(2024, 12, 20) + datetime.timedelta(rng.randint(0, 70))
        dep = rng.choice(["01", "2A", "75", None])
        rows.append((str(rng.randint(1, 12)), dep, {"01": "84", "2A": "94", "75": "11"}.get(dep), day,
                     day.year if day else None, rng.choice(["Gazole", "SP95", "Other", None]),
                     None if rng.random() < 0.2 else rng.randint(100, 120) / 100,
                     f"2025-01-01T{rng.randint(10, 20)}:00:00", str(i)))
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, LONG)


def same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    rows = [sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in d.select(*cols).collect()),
                   key=repr) for d in (a, b)]
    assert rows[0] == rows[1]


def full(spark, rows):
    return reshape.pivot_wide(table(spark, rows), LAYOUT.products, order=LAYOUT.order, keys=KEYS)


def full_marts(wide):
    return marts.build_marts(wide, LAYOUT.columns, headline="gazole", top_n=3,
                             tiebreak=["id", "prix_maj_date", "departement", "region_code", "annee"])


def test_increments_equal_the_full_build(spark, tmpdir_path):
    """Cuts in any order, one of them twice, an empty one between."""
    rows = long_rows()
    cuts = [rows[300:], rows[:100], [], rows[100:300], rows[:100], rows[50:120]]
    for cut in cuts:
        incremental.merge(spark, tmpdir_path, table(spark, cut), LAYOUT)
    wide = full(spark, rows)
    same(incremental.wide(spark, tmpdir_path, LAYOUT), wide)
    got, want = incremental.mart_tables(spark, tmpdir_path, LAYOUT), full_marts(wide)
    assert set(got) == set(want)
    for name in want:
        same(got[name], want[name])


def test_replaced_and_removed_values_leave_the_rankings(spark, tmpdir_path):
    rows = long_rows(200, 2)
    incremental.merge(spark, tmpdir_path, table(spark, rows), LAYOUT)
    best = incremental.mart_tables(spark, tmpdir_path, LAYOUT)["most_expensive"].filter("rank = 1").collect()
    wide = incremental.wide(spark, tmpdir_path, LAYOUT)
    # each first place gets a later, lower price
    firsts = wide.join(spark.createDataFrame(best).select("id", "departement", "gazole").distinct(),
                       ["id", "departement", "gazole"]).collect()
    lower = [(r.id, r.departement, r.region_code, r.prix_maj_date, r.annee, "Gazole", 0.5, "2026-01-01T00:00:00", "0")
             for r in firsts]
    assert lower
    incremental.merge(spark, tmpdir_path, table(spark, lower), LAYOUT)
    now = full(spark, rows + lower)
    for name, want in full_marts(now).items():
        same(incremental.mart_tables(spark, tmpdir_path, LAYOUT)[name], want)
    # and one entity goes
    gone = now.filter("id = '3'").select("id", "prix_maj_date")
    incremental.remove(spark, tmpdir_path, gone, LAYOUT)
    left = now.filter("id <> '3'")
    same(incremental.wide(spark, tmpdir_path, LAYOUT), left)
    for name, want in full_marts(left).items():
        same(incremental.mart_tables(spark, tmpdir_path, LAYOUT)[name], want)


def test_only_touched_periods_are_rewritten(spark, tmpdir_path):
    rows = long_rows()
    incremental.merge(spark, tmpdir_path, table(spark, rows), LAYOUT)
    before = published.current(spark, tmpdir_path)[1]
    january = [r for r in long_rows(30, 9) if r[3] and r[3].isoformat().startswith("2025-01")]
    incremental.merge(spark, tmpdir_path, table(spark, january), LAYOUT)
    after = published.current(spark, tmpdir_path)[1]
    assert {n for n in after if after[n] != before[n]} == {f"{t}/2025-01" for t in incremental.TABLES}
    assert {n.split("/")[1] for n in after} == {"2024-12", "2025-01", "2025-02", "none"}
    same(incremental.wide(spark, tmpdir_path, LAYOUT, since="2025-02").filter("prix_maj_date IS NOT NULL"),
         full(spark, rows).filter("prix_maj_date >= '2025-02-01'"))
    assert published.expire(spark, tmpdir_path, keep=1) == 0 and len(after) == 16
    incremental.merge(spark, tmpdir_path, table(spark, january), LAYOUT)
    assert published.expire(spark, tmpdir_path, keep=1) == 1          # the first rewrite of January
    same(incremental.wide(spark, tmpdir_path, LAYOUT), full(spark, rows + january))


def test_nothing_merged(spark, tmpdir_path):
    assert incremental.merge(spark, tmpdir_path, table(spark, []), LAYOUT) == 0
    assert incremental.wide(spark, tmpdir_path, LAYOUT) is None
    assert incremental.mart_tables(spark, tmpdir_path, LAYOUT) == {}
    with pytest.raises(ValueError):
        incremental.remove(spark, tmpdir_path, table(spark, []).select("id"), LAYOUT)


def test_a_stopped_job_leaves_the_old_marts(spark, tmpdir_path):
    old = spark.createDataFrame([("01", 1.0)], "departement string, gazole_moyen double")
    published.publish_marts(spark, {"by_region": old, "by_departement": old}, tmpdir_path)
    new = old.withColumn("gazole_moyen", F.lit(2.0))
    broken = new.withColumn("gazole_moyen", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        published.publish_marts(spark, {"by_region": new, "by_departement": broken}, tmpdir_path)
    for name in ("by_region", "by_departement"):
        assert [tuple(r) for r in published.load_published(spark, tmpdir_path, name).collect()] == [("01", 1.0)]
    published.publish_marts(spark, {"by_region": new}, tmpdir_path)
    assert published.load_published(spark, tmpdir_path, "by_region").first().gazole_moyen == 2.0
    assert published.load_published(spark, tmpdir_path, "by_departement").first().gazole_moyen == 1.0
    assert published.expire(spark, tmpdir_path, keep=1) == 1          # the stopped job's folder
    with pytest.raises(ValueError):
        published.load_published(spark, tmpdir_path, "by_year")


def test_two_writers_from_one_set(spark, tmpdir_path):
    df = spark.range(1).withColumn("code", F.lit("01"))
    since, _ = published.current(spark, tmpdir_path)
    one, two = (published.write(df, tmpdir_path, published.new_folder()) for _ in range(2))
    published.publish(spark, tmpdir_path, {"t": one}, since)
    with pytest.raises(RuntimeError):
        published.publish(spark, tmpdir_path, {"t": two}, since)
    assert published.current(spark, tmpdir_path) == (1, {"t": one})
    published.publish(spark, tmpdir_path, {"t": None}, 1)
    assert published.current(spark, tmpdir_path) == (2, {})


def test_job_statistics_need_no_scan(spark, tmpdir_path):
    """The report, outlier counts and summary of the job's two writes are those of
    scans, and nothing reads the detailed table for them."""
    raw = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw)
    rng = random.Random(6)
    rows = [{"id": str(i % 9), "cp": rng.choice(["1000", "75001", "20000"]), "ville": None if i % 10 == 0 else "v",
             "adresse": "a", "geom": {"lat": 1.0, "lon": 2.0}, "prix_nom": rng.choice(["Gazole", "SP95"]),
             "prix_valeur": 4.9 if i % 37 == 0 else 1 + rng.random() / 10, "prix_id": str(i),
             "prix_maj": f"202{rng.randint(3, 5)}-0{rng.randint(1, 9)}-11T08:00:00"} for i in range(300)]
    with open(f"{raw}/carburants_2025-01-15.json", "w") as f:
        json.dump(rows, f)
    got = pipeline.detailed_job(spark, raw, tmpdir_path)
    detailed = files.load_detailed(spark, tmpdir_path)
    assert got.summary == marts.run_summary(detailed).first().asDict()
    rate = {r["product"]: r.n_outliers for r in anomaly.outlier_rate(detailed).collect()}
    assert got.outliers == rate and rate["any"] > 0
    scan = files.scan_snapshots(spark, raw, source_col=None, on_corrupt="report")
    assert got.report == clean.clean_report(scan).first().asDict() and got.report["rows_removed"] == 30


def test_clustered_files_skip_row_groups(spark, tmpdir_path):
    """A one-year filter can skip most row groups of a clustered table and hardly any
    of an unordered one; the rows are the same."""
    df = (spark.range(60_000).withColumn("r", F.lit("84")).withColumn("pad", F.md5(F.col("id").cast("string")))
          .withColumn("day", F.date_add(F.lit("2015-01-01"), (F.col("id") * 7919 % 3650).cast("int"))))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark._jsc.hadoopConfiguration().set("parquet.block.size", str(128 * 1024))
    spark._jsc.hadoopConfiguration().set("parquet.page.size.row.check.min", "100")
    try:
        read = {}
        for name, by in (("plain", ()), ("clustered", ("day",))):
            path = os.path.join(tmpdir_path, name)
            files.write_table(df, path, partition_by=["r"], cluster_by=by)
            groups = []
            for f in glob.glob(f"{path}/r=84/*.parquet"):
                meta = pq.ParquetFile(f).metadata
                at = meta.schema.to_arrow_schema().get_field_index("day")
                groups += [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
            hit = [s for s in groups if str(s.min) < "2019-01-01" and str(s.max) >= "2018-01-01"]
            read[name] = len(hit) / len(groups)
            assert len(groups) > 8
            assert files.scan_parquet(spark, path).filter("year(day) = 2018").count() == \
                df.filter("year(day) = 2018").count()
        assert read["clustered"] < 0.5 < read["plain"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark._jsc.hadoopConfiguration().unset("parquet.block.size")
        spark._jsc.hadoopConfiguration().unset("parquet.page.size.row.check.min")
