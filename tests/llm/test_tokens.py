"""Token counts, token store and byte-level BPE against the libraries' own results."""

import base64
import random
import uuid
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pricelens.llm import byte_bpe, token_counts, token_store
from pricelens.session import scratch_path
from tokenizers import Tokenizer

TEXTS = ["Hello world", "  two  spaces   and\n\n\nlines \n x", "", None, "don't we'll I'M", "é ü ß 漢字 🙂",
         "a" * 20_000, "\t\ttabs\x0b\x0c \r\n", "<|endoftext|> is text", "1234 5 67", " leading", "trailing ",
         " ", "   ", "x　y z w", "the the the the", "\x00\x01\x02", "word " * 3000]


def rows():
    rng = random.Random(1)
    more = ["".join(rng.choice("ab, .'s\n 1é") for _ in range(rng.randint(0, 60))) for _ in range(150)]
    out = [(i * 7 % 1000, t) for i, t in enumerate(TEXTS + more)]
    return out + [(out[0][0], "a repeated id"), (out[0][0], "Hello world"), (None, "no id"), (None, None)]


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in
             map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocab():
    return byte_bpe.load(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


@pytest.mark.parametrize("batch_bytes", [1 << 23, 200])
def test_encode_and_decode(make, vocab, encoding, batch_bytes):
    got = [(r.doc_id, r.n_tokens, list(r.ids), bytes(r.decoded)) for r in
           byte_bpe.encode_decode(make(rows()), vocab, batch_bytes=batch_bytes).collect()]
    want = []
    for i, t in rows():
        ids = encoding.encode_ordinary(t or "")
        want.append((i, len(ids), ids, (t or "").encode()))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert byte_bpe.encode_decode(make([]), vocab).count() == 0


BLANKS = ["foo \u00a0 \u00a0 bar", " \u00a0" * 8, "a\n \nb", "\n \n", "a\t \tb", "\t \t ", "x\n ", "x\u3000 ", " \u2003 y",
          "a \x1c b", "one two", "one two "]


def test_blanks_inside_white_space(make, vocab, encoding):
    """A blank inside a run of other white space begins no pre-token."""
    got = {r.doc_id: list(r.ids) for r in byte_bpe.encode_decode(make(list(enumerate(BLANKS))), vocab).collect()}
    assert got == {i: encoding.encode_ordinary(t) for i, t in enumerate(BLANKS)}
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    enc = token_store.WordEncoder(P.path("byte_bpe_50k.json"), None, False)
    for t in BLANKS:
        assert np.frombuffer(enc(t), "<u2").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_store_round_trip(spark, make):
    docs = make(rows())
    path = scratch_path(spark, f"test-store-{uuid.uuid4().hex}")
    token_store.write_store(docs, path, P.path("byte_bpe_50k.json"), end_id=2)
    store = token_store.open_store(spark, path)
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    listed = []
    for i, t in rows():
        if i is not None:
            ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
            listed.append((i, np.array(ids, "<u2").tobytes(), ids))
    listed.sort(key=lambda r: r[:2])
    want, at = [], 0
    for i, _, ids in listed:
        want.append((i, at, len(ids), ids))
        at += len(ids)
    got = [(r.key, r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist())
           for r in token_store.lookup(store, docs).collect()]
    assert sorted(got) == sorted(want)
    # keys that are not stored, NULL keys and repeated asking
    asked = spark.createDataFrame([(listed[3][0],), (listed[3][0],), (10**9,), (-5,), (None,)], "doc_id long")
    assert {r.key for r in token_store.lookup(store, asked).collect()} == {listed[3][0]}


def test_store_of_few_buckets(spark, make, monkeypatch):
    """More shards than buckets; shards cut by bytes; no table left in the catalog."""
    monkeypatch.setattr(token_store, "SHARD_BYTES", 2000)
    texts = [(i, "word " * (2000 if 300 <= i < 310 else 5)) for i in range(600)] + [(None, "none"), (7, None)]
    docs = make(texts)
    before = spark.conf.get("spark.sql.sources.bucketing.maxBuckets")
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "3")
    try:
        n, cuts = token_store.shard_cuts(docs, "doc_id", "text", 2000)
        assert n == 601 and set(range(300, 309)) <= set(cuts.tolist()) and list(cuts) == sorted(set(cuts))
        path = scratch_path(spark, f"test-store-{uuid.uuid4().hex}")
        store = token_store.write_store(docs, path, P.path("byte_bpe_50k.json"))
        assert store.buckets == 3 and store.ids().select("shard").distinct().count() > 10
        got = sorted((r.key, r.start, r.n_tokens) for r in token_store.lookup(store, docs).collect())
    finally:
        spark.conf.set("spark.sql.sources.bucketing.maxBuckets", before)
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    sizes = sorted((i, len(tok.encode(t or "", add_special_tokens=False).ids) + 1)
                   for i, t in texts if i is not None)
    assert [(k, n) for k, _, n in got] == [(k, n) for k, n in sizes]
    assert [s for _, s, _ in got] == [sum(n for _, n in sizes[:i]) for i in range(len(sizes))]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("token_ids_")]


def test_store_of_no_rows(spark, make):
    path = scratch_path(spark, f"test-store-{uuid.uuid4().hex}")
    store = token_store.write_store(make([]), path, P.path("byte_bpe_50k.json"))
    assert token_store.lookup(store, make([(1, "x")])).count() == 0


def test_minimal_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(-2**62, 2**62, n))
        levels = token_store.build_mph(keys)
        assert sorted(token_store.mph_slots(keys, levels).tolist()) == list(range(len(keys)))
        assert sum(map(len, levels)) <= 64 * max(1, len(levels)) + 4 * len(keys)


def test_words_encode_as_texts():
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        tok = Tokenizer.from_file(P.path(name))
        tok.encode_special_tokens = True
        enc = token_store.WordEncoder(P.path(name), None, False)
        assert enc.by_word == name.startswith("byte")
        for _, t in rows():
            assert np.frombuffer(enc(t or ""), "<u2").tolist() == tok.encode(
                t or "", add_special_tokens=False).ids


ADDED = ["<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|><|endoftext|>  y \n", "<|endoftext|", "no token, twice  spaced",
         "<|startoftext|> z"]


def test_added_tokens_as_the_library(spark, make):
    """Against the library with the files' own settings."""
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        tok = Tokenizer.from_file(P.path(name))
        enc = token_store.WordEncoder(P.path(name), None, False, added_tokens=True)
        for t in [*ADDED, *TEXTS]:
            assert np.frombuffer(enc(t or ""), "<u2").tolist() == tok.encode(t or "", add_special_tokens=False).ids
    from pricelens.llm.queries import QUERIES
    path = scratch_path(spark, f"test-store-{uuid.uuid4().hex}")
    make(list(enumerate(ADDED))).write.parquet(f"{path}/documents.parquet")
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want, at = [], 0
    for i, t in enumerate(ADDED):
        ids = tok.encode(t, add_special_tokens=False).ids + [2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = QUERIES["op2_token_store"](spark, path).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == want


def plain_attribution(encoding, text, spans):
    raw, at, out, none = text.encode(), 0, [0] * len(spans), 0
    place = [len(text[:c].encode()) for c in range(len(text) + 1)]
    byte = [(place[min(max(s, 0), len(text))], place[min(max(e, 0), len(text))]) for s, e in spans]
    for i in encoding.encode_ordinary(text):
        size = len(encoding.decode_single_token_bytes(i))
        share = [max(0, min(at + size, e) - max(at, s)) for s, e in byte]
        best = max(range(len(spans)), key=lambda k: (share[k], [-x for x in byte[k]], -k), default=None)
        if best is None or not share[best]:
            none += 1
        else:
            out[best] += 1
        at += size
    assert at == len(raw)
    return out, none


def test_lines(make, vocab, encoding):
    got = {(r.doc_id, r.n_tokens, r.unattributed, tuple((s.name, s.start, s.end, s.n_tokens) for s in r.sections))
           for r in token_counts.section_tokens(make(rows()), vocab).collect()}
    want = set()
    for i, t in rows():
        t = t or ""
        lines = [x for x in t.split("\n")]
        spans, at = [], 0
        for k, x in enumerate(lines):
            size = len(x) + (k < len(lines) - 1)
            if size:
                spans.append((at, at + size))
            at += size
        n, none = plain_attribution(encoding, t, spans)
        want.add((i, len(encoding.encode_ordinary(t)), none,
                  tuple((str(k), *s, c) for k, (s, c) in enumerate(zip(spans, n)))))
    assert got == want


def test_given_sections(spark, make, vocab, encoding):
    """Gaps, overlaps, spans inside a token or beyond the text, and none."""
    text = "Überschrift: der Text\nhas several parts, naïve and 漢字漢字 at the end"
    table = [(1, "a", 0, 5), (1, "b", 3, 17), (1, "c", 30, 30), (1, "d", 40, 500), (1, "e", 20, 26), (9, "z", 0, 3)]
    docs = make([(1, text), (2, "nothing here"), (3, None), (9, "")])
    sections = spark.createDataFrame(table, "doc_id long, name string, start int, end int")
    got = {r.doc_id: r for r in token_counts.section_tokens(
        token_counts.sections_of(docs, sections), vocab, sections_col="sections").collect()}
    mine = sorted((n, s, e) for i, n, s, e in table if i == 1)
    n, none = plain_attribution(encoding, text, [x[1:] for x in mine])
    assert [(s.name, s.n_tokens) for s in got[1].sections] == [(x[0], c) for x, c in zip(mine, n)]
    assert got[1].unattributed == none and none + sum(n) == got[1].n_tokens
    assert got[2].unattributed == got[2].n_tokens > 0 and got[3].n_tokens == 0
    assert [(s.name, s.n_tokens) for s in got[9].sections] == [("z", 0)]
    assert token_counts.section_tokens(make([]), vocab).count() == 0
