"""Incremental snapshot cleaning with a file stream."""

import json
import os

from pricelens.streaming import start_incremental_clean


def _land(path, name, recs):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(json.dumps(recs))


def rec(i, price="1.75"):
    return {"id": str(i), "cp": "75001", "ville": "Paris", "prix_nom": "Gazole",
            "prix_valeur": price, "prix_maj": "2025-01-15T08:00:00", "prix_id": f"p{i}"}


def test_incremental_clean_picks_up_new_files_once(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "raw")
    out = os.path.join(tmpdir_path, "long")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    _land(landing, "carburants_2025-01-15.json", [rec(1), rec(2, "abc")])
    _land(landing, "carburants_2025-01-15_metadata.json", {"record_count": 2})
    q = start_incremental_clean(spark, landing, out, checkpoint_location=ckpt)
    q.awaitTermination()
    first = spark.read.parquet(out)
    assert first.count() == 2
    assert {r.region_code for r in first.collect()} == {"11"}
    _land(landing, "carburants_2025-01-16.json", [rec(3)])
    q = start_incremental_clean(spark, landing, out, checkpoint_location=ckpt)
    q.awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert sorted(r.id for r in rows) == ["1", "2", "3"]          # no file read twice
    # the default checkpoint belongs to the output: another output gets everything
    for other in ("long-b", "long-c"):
        path = os.path.join(tmpdir_path, other)
        start_incremental_clean(spark, landing, path).awaitTermination()
        assert spark.read.parquet(path).count() == 3
    assert {r.id: r.prix_valeur for r in rows}["2"] is None        # invalid price -> NULL


def test_a_batch_run_again_replaces_itself(spark, tmpdir_path):
    landing, out = os.path.join(tmpdir_path, "raw"), os.path.join(tmpdir_path, "long")
    _land(landing, "carburants_2025-01-15.json", [rec(1), rec(2)])
    for ckpt in ("a", "b"):                       # a lost checkpoint: batch 0 comes again
        start_incremental_clean(spark, landing, out, checkpoint_location=f"{tmpdir_path}/{ckpt}").awaitTermination()
        assert spark.read.parquet(out).count() == 2


def test_corrupt_files_fail_the_stream_or_go(spark, tmpdir_path):
    import pytest

    landing = os.path.join(tmpdir_path, "raw")
    _land(landing, "carburants_2025-01-15.json", [rec(1)])
    with open(os.path.join(landing, "carburants_2025-01-16.json"), "w") as f:
        f.write(json.dumps(rec(2)) + "\n" + json.dumps(rec(3)))
    with pytest.raises(Exception, match="corrupt input record"):
        start_incremental_clean(spark, landing, f"{tmpdir_path}/x").awaitTermination()
    start_incremental_clean(spark, landing, f"{tmpdir_path}/y", on_corrupt="report").awaitTermination()
    assert [r.id for r in spark.read.parquet(f"{tmpdir_path}/y").collect()] == ["1"]
