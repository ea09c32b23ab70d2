"""Scans and sinks (S1-S14) on literal files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from pricelens import schema
from pricelens.sources import files, landing


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


REC = {"id": "1", "cp": "1000", "ville": "Bourg", "adresse": "1 rue", "geom": {"lat": 46.2, "lon": 5.2},
       "prix_nom": "Gazole", "prix_valeur": 1.75, "prix_maj": "2025-01-15T08:00:00+01:00",
       "prix_id": "p1", "ingestion_timestamp": "2025-01-15T06:00:00"}


def test_format_guard():
    with pytest.raises(ValueError):
        files.check_format("xml")


def test_snapshots_skip_sidecar_and_keep_codes_as_strings(spark, tmpdir_path):
    raw = os.path.join(tmpdir_path, "raw")
    recs = [dict(REC), dict(REC, id="2", cp="20090", prix_valeur="abc")]
    write(f"{raw}/carburants_2025-01-15.json", json.dumps(recs))
    write(f"{raw}/carburants_2025-01-16.json", json.dumps([dict(REC, id="3")]))
    write(f"{raw}/carburants_2025-01-16_metadata.json",
          json.dumps({"dataset_name": "carburants", "record_count": 1}))
    df = files.scan_snapshots(spark, raw)
    assert df.count() == 3
    assert {r.source_file.rsplit("/", 1)[-1] for r in df.collect()} == {
        "carburants_2025-01-15.json", "carburants_2025-01-16.json"}
    assert dict(df.dtypes)["cp"] == "string"


def test_json_lines_and_multiline(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "lines.jsonl")
    write(p, "\n".join(json.dumps(dict(REC, id=str(i))) for i in range(5)))
    assert files.scan_jsonl(spark, p).count() == 5
    q = os.path.join(tmpdir_path, "arr")
    landing.write_json_array(spark.createDataFrame([(i,) for i in range(50)], "x int")
                             .repartition(3), q)
    back = files.scan_json(spark, q, "x int", glob="part-*.txt")
    assert sorted(r.x for r in back.collect()) == list(range(50))


def test_partitioned_round_trip_keeps_codes(spark, tmpdir_path):
    df = spark.createDataFrame([("01", "84", 1.0), ("2A", "94", 2.0), ("75", "11", 3.0)],
                               "departement string, region_code string, gazole double")
    out = os.path.join(tmpdir_path, "detailed")
    files.write_table(df, out, partition_by=["region_code", "departement"])
    back = files.scan_parquet(spark, out)
    assert dict(back.dtypes)["departement"] == "string"
    assert sorted(r.departement for r in back.collect()) == ["01", "2A", "75"]
    assert back.filter(F.col("region_code") == "84").count() == 1


def test_marts_exact_folder_and_csv(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "aggregations")
    a = spark.createDataFrame([("01", 1.0)], "departement string, gazole_moyen double")
    b = spark.createDataFrame([("01", "2025-01-01", 1.0)], "departement string, date string, "
                                                           "gazole_moyen double")
    files.write_marts({"by_departement": a, "by_departement_date": b}, base)
    got = files.load_mart(spark, base, "by_departement")
    assert got.count() == 1 and "date" not in got.columns
    csv = os.path.join(tmpdir_path, "export")
    files.export_csv(a, csv)
    back = files.scan_csv(spark, csv, "departement string, gazole_moyen double")
    assert back.collect()[0].departement == "01"
    with pytest.raises(ValueError):
        files.write_table(a, csv, fmt="xml")


def test_landing_enrich_and_audit(spark):
    df = spark.createDataFrame([("1", "1000"), ("2", "75001")], "id string, cp string")
    out = landing.landing_enrich(df, "2025-01-15T06:00:00")
    assert sorted(r.cp for r in out.collect()) == ["01000", "75001"]
    audit = landing.ingest_audit(df, dataset_name="carburants", source_url="http://x",
                                 ingestion_ts="2025-01-15T06:00:00").collect()[0]
    assert audit.record_count == 2 and audit.ingestion_date == "2025-01-15"
    text = '{"id":"1","cp":"1000"}{"id":"2","cp":"75001"}'
    assert abs(audit.file_size_mb - len(text) / 2 ** 20) < 1e-12
    assert audit.__fields__[:4] == ["dataset_name", "ingestion_timestamp", "ingestion_date",
                                    "source_url"]


def test_array_reader_refuses_lines_and_truncated_files(spark, tmpdir_path):
    lines = os.path.join(tmpdir_path, "lines_2025-01-15.json")
    write(lines, "\n".join(json.dumps(dict(REC, id=str(i))) for i in range(40)))
    cut = os.path.join(tmpdir_path, "cut_2025-01-15.json")
    write(cut, json.dumps([dict(REC, id=str(i)) for i in range(40)])[:-25])
    empty = os.path.join(tmpdir_path, "empty_2025-01-15.json")
    write(empty, "[]")
    for bad in (lines, cut):
        with pytest.raises(Exception, match="corrupt input record"):
            files.scan_json(spark, bad).collect()
        with pytest.raises(Exception, match="corrupt input record"):
            files.scan_json(spark, bad).count()
        rows = files.scan_json(spark, bad, on_corrupt="report").collect()
        assert len(rows) == 1 and rows[0].id is None and rows[0][schema.CORRUPT]
    assert files.scan_json(spark, empty).count() == 0
    assert files.scan_json(spark, [lines, cut, empty], on_corrupt="report").count() == 2
    audit = landing.ingest_audit(files.scan_json(spark, cut, on_corrupt="report"),
                                 dataset_name="d", source_url="u", ingestion_ts="2025-01-15T06:00:00")
    assert audit.first().corrupt_count == 1


ARRAYS = {
    "plain": ('[{"x": 1, "s": "a"}, {"x": 2, "s": "b"}]', [(1, "a"), (2, "b")]),
    "one_line": ('[{"x":1,"s":"}"},{"x":2,"s":"] {"},{"x":3,"s":"a} ] [b"}]', [(1, "}"), (2, "] {"), (3, "a} ] [b")]),
    "spread": ('\n [\n{"x": 1,\n "s":\n"a"}\n,\n{"x": 2}\n]\n\n', [(1, "a"), (2, None)]),
    "quotes": ('[{"x": 1, "s": "\\"] {"}, {"x": 2, "s": "\\\\"}]', [(1, '"] {'), (2, "\\")]),
    "nested": ('[{"x": 1, "s": "a", "n": {"k": [{"z": 1}, [2]]}}]', [(1, "a")]),
    "wrong_type": ('[{"x": "one", "s": 5}, {"x": 2.0, "s": null}]', [(None, "5"), (2, None)]),
    "empty": ("[]", []), "blank": (" \n ", []), "nothing": ("", []),
    "lines": ('{"x": 1}\n{"x": 2}', None), "single": ('{"x": 1}', None),
    "cut": ('[{"x": 1}, {"x": 2}', None), "cut_in": ('[{"x": 1}, {"x"', None), "cut_text": ('[{"x": 1}, {"s": "]', None),
    "two": ('[{"x": 1}]\n[{"x": 2}]', None), "lines_behind": ('[{"x": 1}]\n{"x": 2}', None),
    "empty_first": ('[] [{"x": 1}]', None), "number_behind": ('[{"x": 1}] 5 ]', None),
    "words": ("no json", None), "no_comma": ('[{"x": 1} {"x": 2}]', None),
}


@pytest.mark.parametrize("name", sorted(ARRAYS))
def test_array_files(spark, tmpdir_path, name):
    text, want = ARRAYS[name]
    p = os.path.join(tmpdir_path, f"{name} é.json")
    write(p, text)
    if want is None:
        with pytest.raises(Exception, match="corrupt input record"):
            files.scan_json(spark, p, "x int, s string").collect()
        got = files.scan_json(spark, p, "x int, s string", on_corrupt="report", source_col="f").collect()
        assert [r.x for r in got] == [None] and got[0][schema.CORRUPT] and got[0].f
    else:
        got = files.scan_json(spark, p, "x int, s string").collect()
        assert [(r.x, r.s) for r in got] == want


def test_array_files_of_many_blocks(spark, tmpdir_path):
    """A file far larger than a block is checked by many tasks and read once."""
    p = os.path.join(tmpdir_path, "big.json")
    rows = [dict(REC, id=str(i), ville="a } ] [ b" if i % 7 == 0 else "c") for i in range(3000)]
    write(p, json.dumps(rows))
    lines = os.path.join(tmpdir_path, "cut.json")
    write(lines, json.dumps(rows)[:-1])
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "20k")
    try:
        assert spark.read.option("lineSep", "}").text(p).rdd.getNumPartitions() > 20
        assert sorted(files.broken_arrays(spark, tmpdir_path)) == [f"file:{lines}"]
        assert sorted(int(r.id) for r in files.scan_json(spark, p).collect()) == list(range(3000))
        assert files.scan_json(spark, tmpdir_path, on_corrupt="report").count() == 3001
    finally:
        spark.conf.set(key, old)


def test_arrays_are_parsed_once(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "a.json")
    write(p, json.dumps([REC] * 3))
    plan = files.scan_json(spark, p)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 1 and "wholetext" not in plan
    assert "from_json" not in plan


def test_corrupt_lines_and_csv_rows(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "l_2025-01-15.json")
    write(p, "\n".join([json.dumps(REC), '{"id": "2", "cp"', json.dumps(dict(REC, id="3"))]))
    with pytest.raises(Exception, match="corrupt input record"):
        files.scan_jsonl(spark, p).count()
    got = files.scan_snapshots(spark, tmpdir_path, fmt="jsonl", on_corrupt="report").collect()
    assert sorted(str(r.id) for r in got) == ["1", "3", "None"]
    assert all(r.source_file.endswith("l_2025-01-15.json") for r in got)
    c = os.path.join(tmpdir_path, "c.csv")
    write(c, "b,a\n1,x\n2\n3,y\n")
    with pytest.raises(Exception, match="corrupt input record"):
        files.scan_csv(spark, c, "a string, b int").collect()
    got = files.scan_csv(spark, c, "a string, b int, z double", on_corrupt="report").collect()
    assert sorted((r.a, r.b) for r in got if r[schema.CORRUPT] is None) == [("x", 1), ("y", 3)]
    with pytest.raises(ValueError):
        files.scan_snapshots(spark, tmpdir_path, fmt="xml")
    with pytest.raises(ValueError):
        files.scan_jsonl(spark, p, on_corrupt="ignore")


def test_corrupt_input_fails_before_any_filter(spark, tmpdir_path):
    """A filter on the keys does not hide corrupt rows, which have none."""
    write(os.path.join(tmpdir_path, "a.jsonl"), json.dumps(REC) + "\n{\"id\"\n")
    write(os.path.join(tmpdir_path, "a.json"), json.dumps(REC))
    write(os.path.join(tmpdir_path, "a.csv"), "id,cp\n1,2\n3\n")
    for fmt in ("jsonl", "json", "csv"):
        df = files.read_table(spark, os.path.join(tmpdir_path, f"a.{fmt}"), fmt, "id string, cp string")
        with pytest.raises(Exception, match="corrupt input record"):
            df.filter("cp IS NOT NULL AND id > ''").select("id").collect()


def test_checkpoint_dir_required_off_local_masters():
    # lineage cuts never go to one machine's disk on a cluster
    from pricelens.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
    Context.getCheckpointDir = lambda self: "hdfs:///shared/ckpt"
    assert ensure_checkpoint_dir(Session()) == "hdfs:///shared/ckpt"
    for one_machine in ("file:/tmp/ckpt", "file:///data/ckpt", "/tmp/ckpt"):
        Context.getCheckpointDir = lambda self, p=one_machine: p
        with pytest.raises(RuntimeError):
            ensure_checkpoint_dir(Session())
