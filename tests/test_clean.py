"""Clean layer (P1-P10) on literal edge rows."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from pricelens import schema
from pricelens.operators import clean


def raw_rows(spark, with_dep=False):
    rows = [
        ("1", "1000", "Bourg", "1.5", "2025-01-15T10:30:00+01:00", "Gazole"),
        ("2", "20090", "Ajaccio", "0", "2025-01-15", "SP95"),
        ("3", "20200", "Bastia", "-1", "not-a-date", "SP98"),
        ("4", "97110", "Pointe", "5.0", None, "E10"),
        ("5", "75001", "Paris", "4.999", "2025-02-01 08:00:00", "E85"),
        ("6", "75002", "Paris", "abc", "2025-02-01", "GPLc"),
        (None, "75003", "Paris", "1.7", "2025-02-01", "Gazole"),
        ("8", None, "Paris", "1.7", "2025-02-01", "Gazole"),
        ("9", "75004", None, "1.7", "2025-02-01", "Gazole"),
        ("10", "75005", "Paris", None, "2025-02-01", None),
    ]
    df = spark.createDataFrame(rows, "id string, cp string, ville string, prix_valeur string, "
                                     "prix_maj string, prix_nom string")
    if with_dep:
        df = df.withColumn("dep_code", F.when(F.col("cp") == "97110", "971")
                           .when(F.col("cp") == "1000", "1").otherwise(F.substring("cp", 1, 2)))
    return df


def test_normalize_columns_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], ["  Prix Valeur ", "Dep-Code"])
    assert clean.normalize_columns(df).columns == ["prix_valeur", "dep_code"]
    bad = spark.createDataFrame([(1, 2)], ["A B", "a_b"])
    with pytest.raises(ValueError):
        clean.normalize_columns(bad)


def test_require_keys_drops_null_keys(spark):
    out = clean.require_keys(raw_rows(spark))
    assert sorted(r.id for r in out.collect()) == sorted(["1", "2", "3", "4", "5", "6", "10"])


def test_pad_and_department_from_postal(spark):
    df = clean.pad_column(clean.require_keys(raw_rows(spark)), "cp", 5)
    df = clean.derive_department(df)
    got = {r.cp: r.departement for r in df.collect()}
    assert got["01000"] == "01"
    assert got["20090"] == "2A"
    assert got["20200"] == "2B"
    assert got["97110"] == "97"


def test_department_from_dep_code_keeps_overseas(spark):
    df = clean.derive_department(raw_rows(spark, with_dep=True))
    got = {r.cp: r.departement for r in df.collect()}
    assert got["97110"] == "971"   # lpad alone would truncate to "97"
    assert got["1000"] == "01"


def test_region_from_department_map(spark):
    df = spark.createDataFrame([("01",), ("2A",), ("03",), ("97",), (None,)], "departement string")
    got = {r.departement: r.region_code for r in clean.derive_region(df).collect()}
    assert got == {"01": "84", "2A": "94", "03": "84", "97": "99", None: "99"}
    assert len(schema.DEPARTMENT_REGION) == 96


def test_region_from_reg_code_when_present(spark):
    df = spark.createDataFrame([("75", 32), ("75", None)], "departement string, reg_code int")
    got = sorted(r.region_code for r in clean.derive_region(df).collect())
    assert got == ["11", "32"]      # per-row fallback to the department map


def test_department_fallback_per_row(spark):
    df = spark.createDataFrame([("75001", "75"), ("20090", None)], "cp string, dep_code string")
    got = {r.cp: r.departement for r in clean.derive_department(df).collect()}
    assert got == {"75001": "75", "20090": "2A"}


def test_validate_range_keeps_rows(spark):
    out = clean.validate_range(raw_rows(spark))
    got = {r.id: r.prix_valeur for r in out.collect()}
    assert len(got) == 10
    assert got["1"] == 1.5 and got["5"] == 4.999
    for k in ("2", "3", "4", "6", "10"):
        assert got[k] is None


def test_parse_date_year(spark):
    out = clean.parse_date_year(raw_rows(spark))
    got = {r.id: (r.prix_maj_date, r.annee) for r in out.collect()}
    assert str(got["1"][0]) == "2025-01-15" and got["1"][1] == 2025
    assert got["3"] == (None, None)
    assert got["4"] == (None, None)
    assert str(got["5"][0]) == "2025-02-01"


def test_extract_geo(spark):
    df = spark.createDataFrame([Row(id="1", geom=Row(lat=45.5, lon=4.8)),
                                Row(id="2", geom=None)],
                               "id string, geom struct<lat:double,lon:double>")
    got = {r.id: (r.latitude, r.longitude) for r in clean.extract_geo(df).collect()}
    assert got == {"1": (45.5, 4.8), "2": (None, None)}
    no_geom = spark.createDataFrame([("1",)], "id string")
    assert clean.extract_geo(no_geom).columns == ["id"]


def test_clean_report(spark):
    r = clean.clean_report(raw_rows(spark)).collect()[0]
    assert (r.rows_in, r.rows_out, r.rows_removed) == (10, 7, 3)
    assert abs(r.removed_pct - 30.0) < 1e-9
    empty = spark.createDataFrame([], "id string, cp string, ville string")
    assert clean.clean_report(empty).collect()[0].removed_pct == 0.0


def test_stamp_processing_fixed_per_run(spark):
    out = clean.stamp_processing(raw_rows(spark), run_ts="2025-06-30T08:00:00",
                                 run_date="2025-06-30").collect()
    assert {r.processing_timestamp for r in out} == {"2025-06-30T08:00:00"}
    assert {str(r.processing_date) for r in out} == {"2025-06-30"}


def test_clean_observations_composite(spark):
    df = raw_rows(spark).withColumn("geom", F.struct(F.lit(45.0).alias("lat"),
                                                     F.lit(5.0).alias("lon")))
    out = clean.clean_observations(df)
    cols = set(out.columns)
    assert {"departement", "region_code", "latitude", "longitude", "prix_maj_date",
            "annee"} <= cols
    assert out.count() == 7
