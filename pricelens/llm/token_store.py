"""Token ids on disk with a minimal perfect hash index.

Layout of a store (folder ``path``):

* ``ids``: a Parquet table bucketed by ``shard``.  Shards are ranges of the
  key in ascending order; a row is a block of consecutive documents of one
  shard: ``keys`` (int64), ``bounds`` (int64, where each document's ids begin in
  the block, and the end) and ``ids``, the raw little-endian ids end to end (16
  bits each if the vocabulary allows, else 32).
* ``starts``: ids before each shard.
* ``index``: key buckets.  A row is a minimal perfect hash of the bucket's keys
  (levels of bit maps: a key alone at its bit is placed, the others go on to the
  next level; the slot is the number of set bits before), and for every slot
  the key's 32-bit fingerprint, shard, block and row.

A lookup hashes a key to its bucket and slot in constant time, compares the
fingerprint, and reads the block the slot names.  Reading many keys joins
them with the index by bucket and with ``ids`` by shard; the bucketed table is
read where it lies, only the keys are shuffled.
"""

from __future__ import annotations

import array
import json
import math
import sys
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keyed_text
from .exchange import cells
from .textvec import mix, spans

U = np.uint64
SHARD_BYTES = 8 << 20           # text bytes
MAX_SHARDS = 1 << 20            # shards grow beyond 8 TB of text
MAX_BUCKETS = 1 << 15           # files of a written table for each task; Spark's own limit is 100,000
RANGES = 1024
BLOCK_IDS = 1 << 18
INDEX_KEYS = 100_000
GAMMA = 1.5
CACHE_WORDS = 1_000_000


# --- encoding --------------------------------------------------------------------

class WordEncoder:
    """Ids of texts by a tokenizers file, as packed bytes.

    For byte-level BPE without a normaliser every pre-token is encoded alone,
    so words are encoded by the library's model once and kept (a bounded number
    of them).  Other tokenizers encode whole texts.  With ``added_tokens`` the
    strings of the file's added tokens give their ids, as in the library with the
    file's own settings, and texts that hold one are encoded whole; without, they
    are ordinary text.
    """

    def __init__(self, path: str, end_id: int | None, wide: bool, added_tokens: bool = False):
        import regex
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.added: list[str] = []
        if added_tokens:
            self.added = [t.content for t in self.tok.get_added_tokens_decoder().values() if t.content]
        else:
            self.tok.encode_special_tokens = True     # their strings are ordinary text
        self.dtype = "<u4" if wide else "<u2"
        self.end = b"" if end_id is None else np.array([end_id], self.dtype).tobytes()
        conf = json.loads(self.tok.to_str())
        pre = conf.get("pre_tokenizer") or {}
        self.by_word = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                        and pre.get("use_regex", True) and conf.get("normalizer") is None
                        and conf["model"]["type"] == "BPE")
        if self.by_word:
            # the cut of byte-level pre-tokenisers
            self.find = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
                                      r"| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+").findall
            self.split = regex.compile(r"(?V1)(?= \S)").split
            self.words, self.others = _Kept(self._word), _Kept(self._piece)
            self.letters = {b: c for b, c in enumerate(_byte_letters())}
            self.tokenize = self.tok.model.tokenize
            self.code = "I" if wide else "H"
            self.marks = {m: self._piece(m) for m in ".,;:!?"}

    def _piece(self, piece: str) -> bytes:
        letters = piece.encode().decode("latin-1").translate(self.letters)
        ids = array.array(self.code, [t.id for t in self.tokenize(letters)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _chunk(self, chunk: str) -> bytes:
        return b"".join([self.words[p[1:]] if p[0] == " " and p[1:].isalpha() else self.others[p]
                         for p in self.find(chunk)])

    def _word(self, word: str) -> bytes:
        """Ids of a space and a word (text up to the next space)."""
        if not word or word[0].isspace():        # the space may lie inside a pre-token
            raise _LoneSpace
        if word.isalpha():                       # one pre-token
            return self._piece(" " + word)
        mark = self.marks.get(word[-1:])
        if mark is not None and word[:-1].isalpha():
            return self.words[word[:-1]] + mark
        return self._chunk(" " + word)

    def __call__(self, text: str) -> bytes:
        if not self.by_word or any(s in text for s in self.added):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids,
                            self.dtype).tobytes() + self.end
        first, *rest = text.split(" ")
        try:                                     # such a word is never kept, so it is always noticed
            return self._chunk(first) + b"".join(map(self.words.__getitem__, rest)) + self.end
        except _LoneSpace:
            return b"".join(map(self._chunk, self.split(text))) + self.end


class _LoneSpace(Exception):
    """A space before other white space or the end of the text."""


class _Kept(dict):
    """Values by key, made when first asked for; emptied when it holds too many."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[key] = self.make(key)
        return value


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


_ENCODERS: dict = {}


def encoder_for(path: str, end_id: int | None, wide: bool, added_tokens: bool = False) -> WordEncoder:
    """One encoder, with the words it knows, for all tasks of a Python worker."""
    name = (path, end_id, wide, added_tokens)
    if name not in _ENCODERS:
        _ENCODERS[name] = WordEncoder(*name)
    return _ENCODERS[name]


def encoded(docs: DataFrame, tokenizer: str, *, end_id: int | None = 2, id_col: str = "doc_id",
            text_col: str = "text", cuts: np.ndarray | None = None,
            added_tokens: bool = False) -> DataFrame:
    """(key long, ids binary) of the rows with an id; NULL texts are empty.
    ``tokenizer`` is the path of a tokenizers file on every executor.  With
    ascending ``cuts`` of the keys also (shard int), the range a key is in."""
    from tokenizers import Tokenizer

    wide = Tokenizer.from_file(tokenizer).get_vocab_size() > 1 << 16

    def run(batches):
        encode = encoder_for(tokenizer, end_id, wide, added_tokens)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                ids = [encode(t.as_py()) for t in part.column("text")]
                cols, names = [part.column("doc_id"), pa.array(ids, pa.binary())], ["key", "ids"]
                if cuts is not None:
                    at = np.searchsorted(cuts, part.column("doc_id").to_numpy(), "left")
                    cols, names = [*cols, pa.array(at.astype(np.int32))], [*names, "shard"]
                yield pa.RecordBatch.from_arrays(cols, names=names)
    base = keyed_text(docs, id_col, text_col).filter("doc_id IS NOT NULL")
    return base.mapInArrow(run, "key long, ids binary" + (", shard int" if cuts is not None else ""))


# --- minimal perfect hash ----------------------------------------------------------

def _level_hash(keys: np.ndarray, level: int) -> np.ndarray:
    seed = U((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
    with np.errstate(over="ignore"):
        return mix(keys.view(np.uint64) * U(0xD1342543DE82EF95) + seed)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_level_hash(keys, 1000) >> U(32)).astype(np.uint32)


def build_mph(keys: np.ndarray, gamma: float = GAMMA) -> list[np.ndarray]:
    """Bit maps (bool arrays) of the levels for distinct int64 keys."""
    levels, left = [], keys
    while len(left):
        size = max(64, int(math.ceil(gamma * len(left))))
        at = (_level_hash(left, len(levels)) % U(size)).astype(np.int64)
        bits = np.bincount(at, minlength=size) == 1
        levels.append(bits)
        left = left[~bits[at]]
    return levels


def mph_slots(keys: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Slot of each key: 0..n-1 for the keys of the index, -1 or any slot for others."""
    out = np.full(len(keys), -1, dtype=np.int64)
    todo, before = np.arange(len(keys)), 0
    for level, bits in enumerate(levels):
        rank = np.cumsum(bits)
        at = (_level_hash(keys[todo], level) % U(len(bits))).astype(np.int64)
        hit = bits[at]
        out[todo[hit]] = before + rank[at[hit]] - 1
        todo, before = todo[~hit], before + int(rank[-1])
    return out


# --- writing ------------------------------------------------------------------------

def _pack(wide: bool):
    width = 4 if wide else 2

    def run(batches):
        shard, block, keys, parts, held = None, 0, [], [], 0

        def flush():
            bounds = np.concatenate(([0], np.cumsum([len(p) // width for p in parts], dtype=np.int64)))
            row = (shard, block, len(keys), int(bounds[-1]), np.array(keys, np.int64).tobytes(),
                   bounds.tobytes(), b"".join(parts))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (
                pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                names=["shard", "block", "rows", "tokens", "keys", "bounds", "ids"])

        for b in batches:
            for s, k, v in zip(b.column("shard").to_pylist(), b.column("key").to_pylist(),
                               b.column("ids").to_pylist()):
                if keys and (s != shard or held >= BLOCK_IDS * width):
                    yield flush()
                    block = block + 1 if s == shard else 0
                    keys, parts, held = [], [], 0
                shard = s
                keys.append(k)
                parts.append(v)
                held += len(v)
        if keys:
            yield flush()
    return run


_BLOCKS = ("shard int, block int, rows int, tokens long, keys binary, bounds binary, ids binary")


def _entries(index_buckets: int):
    def run(batches):
        for b in batches:
            for s, k, raw in zip(b.column("shard").to_pylist(), b.column("block").to_pylist(),
                                 b.column("keys")):
                keys = np.frombuffer(raw.as_buffer(), dtype=np.int64)
                row = np.arange(len(keys), dtype=np.int32)
                new = np.ones(len(keys), dtype=bool)
                new[1:] = keys[1:] != keys[:-1]
                keys, row = keys[new], row[new]
                bucket = (_level_hash(keys, 2000) % U(index_buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                rows = [(x, s, k, keys[order[i:j]].tobytes(), row[order[i:j]].tobytes())
                        for x, i, j in cells(bucket[order])]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                    names=["bucket", "shard", "block", "keys", "row"])
    return run


_INDEX = ("bucket int, size long, levels array<long>, bits binary, prints binary, "
          "shards binary, blocks binary, rows binary")


def _build(table: pa.Table) -> pa.Table:
    table = table.sort_by([("shard", "ascending"), ("block", "ascending")])
    parts = [np.frombuffer(x.as_buffer(), dtype=np.int64) for x in table.column("keys")]
    size = [len(p) for p in parts]
    keys = np.concatenate(parts)
    shard = np.repeat(table.column("shard").to_numpy(), size).astype(np.int32)
    block = np.repeat(table.column("block").to_numpy(), size).astype(np.int32)
    row = np.concatenate([np.frombuffer(x.as_buffer(), dtype=np.int32) for x in table.column("row")])
    # a repeated key may begin in several blocks; its first place counts
    keys, first = np.unique(keys, return_index=True)
    shard, block, row = shard[first], block[first], row[first]
    levels = build_mph(keys)
    slot = mph_slots(keys, levels)
    order = np.empty(len(keys), dtype=np.int64)
    order[slot] = np.arange(len(keys))
    value = (table.column("bucket")[0].as_py(), len(keys), [len(x) for x in levels],
             b"".join(np.packbits(x).tobytes() for x in levels), fingerprints(keys)[order].tobytes(),
             shard[order].tobytes(), block[order].tobytes(), row[order].tobytes())
    kinds = (pa.int32(), pa.int64(), pa.list_(pa.int64())) + (pa.binary(),) * 5
    return pa.table([pa.array([v], t) for v, t in zip(value, kinds)],
                    names=["bucket", "size", "levels", "bits", "prints", "shards", "blocks", "rows"])


def _levels(sizes: list[int], bits: bytes) -> list[np.ndarray]:
    out, at = [], 0
    for n in sizes:
        width = (n + 7) // 8
        out.append(np.unpackbits(np.frombuffer(bits, np.uint8, width, at), count=n).astype(bool))
        at += width
    return out


class Store:
    """A written store: ``ids`` as a bucketed table, ``starts`` and ``index``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int, index_buckets: int, wide: bool):
        self.spark, self.path, self.wide = spark, path, wide
        self.buckets, self.index_buckets = buckets, index_buckets
        self.name = f"token_ids_{uuid.uuid4().hex}"

    def ids(self) -> DataFrame:
        """The blocks, with their bucketing known to the plan.  The catalog has the
        table only while it is looked up; its files stay."""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({_BLOCKS}) "
                       f"USING parquet CLUSTERED BY (shard) INTO {self.buckets} BUCKETS "
                       f"LOCATION '{self.path}/ids'")
        found = self.spark.table(self.name)
        self.spark.sql(f"DROP TABLE {self.name}")
        return found

    def index(self) -> DataFrame:
        return self.spark.read.schema(_INDEX).parquet(f"{self.path}/index")

    def starts(self) -> DataFrame:
        return self.spark.read.schema("shard int, start long").parquet(f"{self.path}/starts")


def open_store(spark: SparkSession, path: str) -> Store:
    meta = spark.read.parquet(f"{path}/meta").first()
    return Store(spark, path, meta["buckets"], meta["index_buckets"], meta["wide"])


def shard_cuts(docs: DataFrame, id_col: str, text_col: str, shard_bytes: int) -> tuple[int, np.ndarray]:
    """(documents with a key, last keys of all shards but the last).

    Shards hold about ``shard_bytes`` of text, or more beyond ``MAX_SHARDS`` of them,
    and there is at least one for every shuffle partition if keys allow.  Keys
    are first cut into ``RANGES`` ranges of about equal row counts; the bytes of
    these say where shards end: light ranges go together, heavy ones are cut
    again.  What reaches the driver has the bound RANGES * RANGES keys.  Rows of
    one key stay in one shard.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("key"),
                       F.octet_length(text_col).alias("bytes")).filter("key IS NOT NULL")

    def ranks(m: int) -> Column:
        return F.percentile_approx("key", [i / m for i in range(1, m)], 20 * m)

    n, coarse = rows.agg(F.count(F.lit(1)), ranks(RANGES)).first()
    coarse = np.unique(np.array(coarse or [], dtype=np.int64))

    @F.pandas_udf("int")
    def range_of(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(coarse, k.to_numpy(), "left").astype(np.int32))

    ranged = rows.withColumn("range", range_of("key"))
    size = np.zeros(len(coarse) + 1, dtype=np.int64)
    for r in ranged.groupBy("range").agg(F.sum(F.coalesce("bytes", F.lit(0)) + 1)).collect():
        size[r[0]] = r[1]
    total = int(size.sum())
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = max(min(shard_bytes, total / least), total / MAX_SHARDS, 1)
    pieces = np.clip(np.ceil(size / target), 1, RANGES).astype(np.int64)
    fine = {}
    if pieces.max() > 1:
        m = int(pieces.max())
        heavy = ranged.filter(F.col("range").isin(np.flatnonzero(pieces > 1).tolist()))
        fine = dict(heavy.groupBy("range").agg(ranks(m)).collect())
    cuts, held = [], 0.0
    for i in range(len(size)):
        if pieces[i] > 1:
            if i and held:
                cuts.append(int(coarse[i - 1]))
            own = fine[i]
            cuts += [own[j * len(own) // int(pieces[i])] for j in range(1, int(pieces[i]))]
            held = size[i] / pieces[i]
        else:
            held += size[i]
        if held >= target / 2 and i < len(coarse) and held + size[i + 1] > target:
            cuts.append(int(coarse[i]))
            held = 0.0
    return n, np.unique(np.array(cuts, dtype=np.int64))


def write_store(docs: DataFrame, path: str, tokenizer: str, *, end_id: int | None = 2,
                id_col: str = "doc_id", text_col: str = "text", added_tokens: bool = False) -> Store:
    """Encode ``docs`` into a new store at ``path`` (a shared folder).

    Documents are stored in ascending id order; rows that repeat an id follow
    each other, in the order of their ids' bytes; rows with a NULL id have no
    key and are not stored.  NULL texts hold ``end_id`` only.  ``added_tokens``:
    see ``WordEncoder``.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    wide = Tokenizer.from_file(tokenizer).get_vocab_size() > 1 << 16
    n, cuts = shard_cuts(docs, id_col, text_col, SHARD_BYTES)
    # beyond the bucket limit a bucket holds several shards, sorted; a group stays one shard
    buckets = min(len(cuts) + 1, MAX_BUCKETS, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))

    rows = encoded(docs, tokenizer, end_id=end_id, id_col=id_col, text_col=text_col, cuts=cuts,
                   added_tokens=added_tokens)
    packed = (rows.select("shard", "key", "ids").repartition(buckets, "shard")
                  .sortWithinPartitions("shard", "key", "ids")
                  .mapInArrow(_pack(wide), _BLOCKS))
    store = Store(spark, path, buckets, max(1, -(-n // INDEX_KEYS)), wide)
    (packed.write.bucketBy(buckets, "shard").option("path", f"{path}/ids")
           .option("compression", "zstd").saveAsTable(store.name))
    ids = store.ids()
    per_shard = ids.groupBy("shard").agg(F.sum("tokens").alias("tokens"))     # a row per shard, MAX_SHARDS
    before = F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    per_shard.select("shard", F.coalesce(before, F.lit(0)).cast("long").alias("start")) \
             .write.parquet(f"{path}/starts")
    (ids.select("shard", "block", "keys").mapInArrow(
        _entries(store.index_buckets), "bucket int, shard int, block int, keys binary, row binary")
        .groupBy("bucket").applyInArrow(_build, _INDEX).write.parquet(f"{path}/index"))
    spark.createDataFrame([(buckets, store.index_buckets, wide)],
                          "buckets int, index_buckets int, wide boolean").write.parquet(f"{path}/meta")
    return store


# --- reading -------------------------------------------------------------------------

_PLACE = "key long, shard int, block int, row int"


def _find(left: pa.Table, right: pa.Table) -> pa.Table:
    """Places of asked keys (left) by a bucket of the index (right)."""
    keys = left.column("key").to_numpy().astype(np.int64)
    if right.num_rows:
        r = right.to_pylist()[0]
        slot = mph_slots(keys, _levels(r["levels"], r["bits"]))
        prints, shards, blocks, rows = (np.frombuffer(r[c], t) for c, t in (
            ("prints", np.uint32), ("shards", np.int32), ("blocks", np.int32), ("rows", np.int32)))
        ok = slot >= 0
        ok[ok] = prints[slot[ok]] == fingerprints(keys[ok])
        keys, slot = keys[ok], slot[ok]
    else:
        keys, slot = keys[:0], np.zeros(0, np.int64)
        shards = blocks = rows = np.zeros(0, np.int32)
    return pa.table([pa.array(keys), pa.array(shards[slot]), pa.array(blocks[slot]), pa.array(rows[slot])],
                    names=["key", "shard", "block", "row"])


def places(store: Store, keys: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """(key, shard, block, row) of the distinct asked keys whose fingerprint the
    index holds; NULL keys have no place."""
    n = store.index_buckets

    @F.pandas_udf("int")
    def bucket_of(k: pd.Series) -> pd.Series:
        return pd.Series((_level_hash(k.to_numpy().astype(np.int64), 2000) % U(n)).astype(np.int32))

    asked = keys.select(F.col(key_col).cast("long").alias("key")).filter("key IS NOT NULL").distinct()
    asked = asked.select("key", bucket_of("key").alias("bucket"))
    return (asked.groupBy("bucket").cogroup(store.index().groupBy("bucket"))
                 .applyInArrow(_find, _PLACE))


_READ = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                   ("ids", pa.binary())])


def _read(wide: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """Ids at the places (left) of one shard (right: its blocks)."""
        dtype = np.dtype("<u4" if wide else "<u2")
        if not (left.num_rows and right.num_rows):
            return _READ.empty_table()
        right = right.sort_by("block")
        base = left.column("start")[0].as_py()
        tokens = right.column("tokens").to_numpy()
        before = dict(zip(right.column("block").to_pylist(), (np.cumsum(tokens) - tokens).tolist()))
        at = {k: i for i, k in enumerate(right.column("block").to_pylist())}
        want: dict[int, list] = {}
        for k, b, r in zip(left.column("key").to_pylist(), left.column("block").to_pylist(),
                           left.column("row").to_pylist()):
            want.setdefault(b, []).append((k, r))
        keys, starts, sizes, raws = [], [], [], []
        for b, asked in want.items():
            more = asked
            while more and b in at:       # a repeated key may go on in the next block
                i = at[b]
                own = np.frombuffer(right.column("keys")[i].as_buffer(), np.int64)
                bounds = np.frombuffer(right.column("bounds")[i].as_buffer(), np.int64)
                data = np.frombuffer(right.column("ids")[i].as_buffer(), dtype)
                k = np.array([x for x, _ in more], np.int64)
                lo = np.array([x for _, x in more], np.int64)
                hi = np.searchsorted(own, k, "right")
                exact = (lo < hi) & (own[np.minimum(lo, len(own) - 1)] == k)
                k, lo, hi = k[exact], lo[exact], hi[exact]
                row = spans(np.arange(len(own)), lo, hi)
                keys.append(np.repeat(k, hi - lo))
                starts.append(base + before[b] + bounds[row])
                sizes.append(bounds[row + 1] - bounds[row])
                raws.append(spans(data, bounds[row], bounds[row + 1]).astype("<u4"))
                more = [(int(x), 0) for x, h in zip(k, hi) if h == len(own)]
                b += 1
        size = np.concatenate(sizes)
        off = np.concatenate(([0], np.cumsum(size))) * 4
        ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [
            None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(np.concatenate(raws).tobytes())])
        return pa.table([pa.array(np.concatenate(keys)), pa.array(np.concatenate(starts)),
                         pa.array(size), ids.cast(pa.binary())], schema=_READ)
    return run


def lookup(store: Store, keys: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """(key long, start long, n_tokens long, ids binary of unsigned 32-bit
    little-endian ids) of every stored document with an asked key; ``start`` is
    the number of ids before it in the store.  Keys that are NULL or not stored
    give no row, asked-for twice they give the rows once; repeated stored
    keys give each of their rows.  The key itself is compared at the place, so
    a chance fingerprint match gives nothing."""
    found = places(store, keys, key_col).join(store.starts(), "shard")
    return (found.groupBy("shard").cogroup(store.ids().groupBy("shard"))
                 .applyInArrow(_read(store.wide), "key long, start long, n_tokens long, ids binary"))
