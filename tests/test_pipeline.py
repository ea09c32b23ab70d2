"""End-to-end batch job: landed snapshots -> detailed table -> marts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from pricelens.plans import pipeline
from pricelens.sources import files


def rec(i, cp, fuel, price, ts):
    return {"id": None if i is None else str(i), "cp": cp, "ville": "V", "adresse": "A",
            "geom": {"lat": 45.0, "lon": 5.0}, "prix_nom": fuel, "prix_valeur": price,
            "prix_maj": ts, "prix_id": f"{i}-{fuel}-{ts}"}


def test_run_detailed_and_marts(spark, tmpdir_path):
    raw = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw)
    day1 = [rec(1, "75001", "Gazole", "1.70", "2025-01-15T08:00:00"),
            rec(1, "75001", "Gazole", "1.72", "2025-01-15T18:00:00"),
            rec(1, "75001", "SP95", "1.85", "2025-01-15T08:00:00"),
            rec(2, "20090", "Gazole", "1.90", "2025-01-15T09:00:00"),
            rec(3, "01000", "Gazole", "9.99", "2025-01-15T09:00:00"),   # invalid -> NULL
            rec(None, "75002", "Gazole", "1.6", "2025-01-15T09:00:00")]  # no id -> dropped
    day2 = [rec(1, "75001", "Gazole", "1.65", "2025-01-16T08:00:00")]
    with open(os.path.join(raw, "carburants_2025-01-15.json"), "w") as f:
        json.dump(day1, f)
    with open(os.path.join(raw, "carburants_2025-01-16.json"), "w") as f:
        json.dump(day2, f)
    with open(os.path.join(raw, "carburants_2025-01-16_metadata.json"), "w") as f:
        json.dump({"dataset_name": "carburants", "record_count": 1}, f)
    out = os.path.join(tmpdir_path, "out")
    path = pipeline.run_detailed(spark, raw, out, run_ts="2025-01-17T06:00:00")
    det = files.scan_parquet(spark, path, string_partitions=pipeline.DETAILED_PARTITIONS)
    rows = {(r.id, str(r.prix_maj_date)): r for r in det.collect()}
    assert len(rows) == 4
    r1 = rows[("1", "2025-01-15")]
    assert r1.gazole == 1.72 and r1.sp95 == 1.85              # latest valid value
    assert r1.region_code == "11" and r1.departement == "75"
    assert rows[("2", "2025-01-15")].departement == "2A"
    assert rows[("3", "2025-01-15")].gazole is None
    assert abs(rows[("1", "2025-01-16")].gazole_evolution - (1.65 - 1.72)) < 1e-12
    assert {r.has_any_anomaly for r in rows.values()} <= {True, False}
    paths = pipeline.run_marts(spark, path, out)
    assert set(paths) == {"by_region", "by_departement", "by_date", "by_departement_date",
                          "by_year", "by_departement_year", "most_expensive", "least_expensive"}
    by_region = {r.region_code: r for r in files.load_mart(spark, out + "/aggregations",
                                                           "by_region").collect()}
    assert by_region["11"].nombre_stations == 2
    least = files.load_mart(spark, out + "/aggregations", "least_expensive").collect()
    assert all(r.gazole is not None for r in least)
    assert det.filter(F.col("departement") == "2A").count() == 1   # codes stay strings


def test_shuffle_partitions_from_input_size(spark, tmpdir_path):
    from pricelens import schema
    from pricelens.session import shuffle_partitions_for
    raw = os.path.join(tmpdir_path, "sized")
    os.makedirs(raw)
    for name, n in (("carburants_2025-01-15.json", 3), ("carburants_2025-01-16.json", 5),
                    ("carburants_2025-01-16_metadata.json", 1)):
        with open(os.path.join(raw, name), "w") as f:
            json.dump([rec(i, "75001", "Gazole", "1.7", "2025-01-15T08:00:00")
                       for i in range(n)], f)
    want = sum(os.path.getsize(os.path.join(raw, n)) for n in os.listdir(raw)
               if not n.endswith("_metadata.json"))
    assert files.input_bytes(spark, raw, schema.SNAPSHOT_GLOB) == want
    mb = 1024 * 1024
    assert shuffle_partitions_for(0, 8) == 16                   # floor: 2 per core
    assert shuffle_partitions_for(10 * 1024 * mb, 4000) == 8000
    # 256 MB each, whatever the number of cores
    assert shuffle_partitions_for(100 * 1024 * 1024 * mb, 8) == 409600
    assert shuffle_partitions_for(100 * 1024 * 1024 * mb, 4000) == 409600
    assert shuffle_partitions_for(10 * 1024 * 1024 * mb, 4000) == 40960


def _day(recs, path, name):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        json.dump(recs, f)


def test_readme_recipe_reads_overlapping_days_once(spark, tmpdir_path):
    """The library recipe of the README: the same observations in two daily
    files are one wide row each, and the source file is no key."""
    from pricelens.operators import clean
    raw = os.path.join(tmpdir_path, "raw")
    recs = [rec(i, "75001", "Gazole", "1.70", "2025-01-15T08:00:00") for i in range(10)]
    _day(recs, raw, "carburants_2025-01-15.json")
    _day(recs, raw, "carburants_2025-01-16.json")
    long = clean.clean_observations(files.scan_snapshots(spark, raw))
    detailed = pipeline.detailed_table(long, raw_products=["Gazole", "SP95"])
    assert detailed.count() == 10


def test_latest_value_by_moment_then_number(spark):
    """Offsets are applied, ids compare as numbers, products by normal form."""
    from pricelens.operators import clean, reshape
    rows = [("a", "Gazole", "1.70", "2025-01-15T02:30:00+02:00", "9"),
            ("a", "Gazole", "1.80", "2025-01-15T02:10:00+01:00", "1"),
            ("b", "SP-95", "1.50", "2025-01-15T08:00:00", "9"),
            ("b", "SP-95", "1.60", "2025-01-15T08:00:00", "10"),
            ("c", "Hydrogene", "2.00", "2025-01-15T08:00:00", "1")]
    df = spark.createDataFrame(rows, "id string, prix_nom string, prix_valeur string, "
                                     "prix_maj string, prix_id string")
    df = clean.parse_date_year(clean.validate_range(df))
    assert reshape.product_names(df) == ["gazole", "hydrogene", "sp_95"]
    wide = {r.id: r for r in reshape.pivot_wide(df).collect()}
    assert len(wide) == 3
    assert wide["a"].gazole == 1.80 and wide["b"].sp_95 == 1.60 and wide["c"].hydrogene == 2.0
    left = reshape.unlisted_products(df, ["gazole"]).collect()
    assert {(r.name, r.rows) for r in left} == {("SP-95", 2), ("Hydrogene", 1)}


@pytest.mark.parametrize("quantiles", ["exact", "approx"])
def test_csv_job_takes_columns_by_name(spark, tmpdir_path, quantiles):
    raw = os.path.join(tmpdir_path, f"csv-{quantiles}")
    os.makedirs(raw)
    with open(os.path.join(raw, "carburants_2025-01-15.csv"), "w") as f:
        f.write("ville,cp,id,geom_lon,geom_lat,prix_nom,prix_valeur,prix_maj,prix_id\n"
                "V,01000,1,5.0,45.0,Gazole,1.70,2025-01-15T08:00:00,1\n"
                "V,20090,2,5.0,45.0,Gazole,1.75,2025-01-15T08:00:00,2\n")
    out = os.path.join(tmpdir_path, f"out-{quantiles}")
    pipeline.run_detailed(spark, raw, out, fmt="csv", quantiles=quantiles)
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "true")
    try:
        rows = {r.id: r for r in files.load_detailed(spark, out).collect()}
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    assert rows["1"].departement == "01" and rows["2"].departement == "2A"   # text in any session
    assert rows["1"].latitude == 45.0 and rows["1"].gazole == 1.70


def test_corrupt_input_fails_the_job_or_is_counted(spark, tmpdir_path):
    raw = os.path.join(tmpdir_path, "raw")
    good = [rec(i, "75001", "Gazole", "1.70", "2025-01-15T08:00:00") for i in range(3)]
    _day(good, raw, "carburants_2025-01-15.json")
    with open(os.path.join(raw, "carburants_2025-01-16.json"), "w") as f:
        f.write(json.dumps(good)[:-30])                       # a truncated array
    with pytest.raises(ValueError, match="1 corrupt"):
        pipeline.run_detailed(spark, raw, os.path.join(tmpdir_path, "out"))
    path = pipeline.run_detailed(spark, raw, os.path.join(tmpdir_path, "out2"), max_corrupt=1)
    assert spark.read.parquet(path).count() == 3
    # the job leaves none of its own intermediate tables
    from pricelens.functions.sizing import discard
    with pytest.raises(ValueError):
        discard(spark.read.parquet(path))
