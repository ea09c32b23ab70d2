"""Registered queries against their SQL, and the pipeline against a plain version."""

import base64
import hashlib
import zlib

import corpus_pipeline
import duckdb
import public_tokenizers as P
import pytest
import tiktoken
from brute import components, contamination, removed
from pricelens.llm import langid
from pricelens.llm.common import held_out
from pricelens.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(ORACLES[name])
    cols = sorted(want.columns)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == cols
    expected = sorted(want.project(", ".join(cols)).fetchall(), key=repr)
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=repr) == expected


def test_pipeline_matches_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    # 1: the same dictionaries, one compressor call for each block
    model = langid.fit(docs, ~held_out("doc_id", 4, 2))
    import pyarrow as pa
    told = langid._predictor(model, model.min_margin)(pa.array([t for _, t in rows]))
    rows = [r for r, gone in zip(rows, told.field("rejected").to_pylist()) if not gone]
    # 2: one of each group
    comp, _ = components(rows)
    rows = [r for r, c in zip(rows, comp) if c == r[0]]
    # 3: repeated words go
    rows = [(i, " ".join(x for x, m in zip(w, mask) if not m) if any(mask) else t)
            for (i, t), (w, mask) in zip(rows, removed(rows))]
    # 4: contaminated documents go
    rows = [r for r, c in zip(rows, contamination(rows, items)) if not c[3]]
    # 5: ids
    ranks = {base64.b64decode(a): int(b) for a, b in
             map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in rows:
        ids = enc.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(t.encode()).hexdigest()))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(got) == sorted(want) and 0 < len(got) < 200


def test_pipeline_stages_pass_odd_rows(spark, tmpdir_path):
    """NULLs in every column, an empty text, repeated rows, and no rows at all."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = "the quick brown fox jumps over the lazy dog and then it sleeps in the sun all day long " * 2
    odd = spark.createDataFrame(
        [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (None, None, None, None, None), (2, None, "en", "a", 0),
         (3, "", "en", "a", 0), (None, text, None, None, None), (4, "un texte tout à fait différent", "fr", None, 3)],
        schema)
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmpdir_path}/benchmark.parquet")
    for docs in (odd, odd.limit(0)):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, tmpdir_path)
            path = f"{tmpdir_path}/{name}-{docs.count()}-{zlib.crc32(repr(docs.columns).encode())}"
            out.write.mode("overwrite").parquet(path)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == odd.columns
            docs = spark.read.parquet(path)
