"""Byte-level BPE encoding and decoding with a global distinct-word shuffle.

1. Texts are cut into pre-tokens (matches of a pattern).  A batch of texts
   keeps each text as a sequence of codes into the batch's own list of
   distinct pre-tokens: position is the place in the sequence.
2. The distinct pre-tokens of all batches meet by a hash of the pre-token;
   each is encoded once for the whole corpus.
3. The ids go back to the batches that asked and every text is reassembled by
   position; a pre-token that a third of all texts hold is one row per batch.
4. Decoding joins ids with the token-byte table (its size is that of the
   vocabulary) and concatenates the bytes.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import block_count, keyed_text, lean, lean_pair, release, text_bytes
from .exchange import cells, planes, unplanes
from .textvec import ragged, spans

BATCH_BYTES = 2 << 20
WORD_BYTES = 8 << 20
# a space before other white space or the end may lie inside a pre-token
LONE_SPACE = re.compile(r" (?!\S)")


class Vocabulary:
    """Ranks of a tiktoken file and the pattern that cuts texts."""

    def __init__(self, rank_lines: bytes, pattern: str):
        self.pattern = pattern
        pairs = (line.split() for line in rank_lines.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}

    def __reduce__(self):
        return _vocabulary, (tuple(self.ranks.items()), self.pattern)

    def encoder(self):
        import tiktoken

        return tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=self.ranks,
                                 special_tokens={})

    def byte_table(self) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets): the token-byte table by id."""
        size = max(self.ranks.values(), default=-1) + 1
        parts = [b""] * size
        for token, i in self.ranks.items():
            parts[i] = token
        return _packed(parts)


def _vocabulary(items, pattern):
    v = Vocabulary(b"", pattern)
    v.ranks = dict(items)
    return v


def _packed(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    off = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) for p in parts], out=off[1:])
    return np.frombuffer(b"".join(parts), dtype=np.uint8), off


def load(path: str, pattern: str) -> Vocabulary:
    with open(path, "rb") as f:
        return Vocabulary(f.read(), pattern)


# --- 1: pre-tokens by position ---------------------------------------------------
#
# One exchange carries both kinds of rows of the first step to where they are
# needed, by ``slot``.  A negative slot is a batch: ``ids`` the document ids,
# ``nums`` the bounds of each text in the batch's sequence of codes (int64),
# ``body`` the codes.  Another slot is a range of pre-token hashes: the distinct
# pre-tokens of one batch there, ``codes`` (ascending) their codes as steps,
# ``nums`` their byte lengths, ``body`` their bytes.

CUT = "slot long, batch long, ids array<long>, codes binary, nums binary, body binary"
_CUT = pa.schema([("slot", pa.int64()), ("batch", pa.int64()), ("ids", pa.list_(pa.int64())),
                  ("codes", pa.binary()), ("nums", pa.binary()), ("body", pa.binary())])


class _Batch:
    """Texts of one batch as they arrive: codes of their chunks."""

    def __init__(self):
        self.ids, self.chunks, self.lengths, self.held = [], [], [], 0
        self.code: dict[str, int] = {}

    def add(self, doc_id, text: str, split) -> None:
        # chunks begin at a space before a non-space, always a pre-token's
        # beginning; equal chunks are cut into pre-tokens once
        if LONE_SPACE.search(text):
            own = split(text)
        else:
            own = text.split(" ")
            own[1:] = [" " + w for w in own[1:]]
        code = self.code
        self.chunks.append(np.fromiter((code.setdefault(w, len(code)) for w in own),
                                       np.int64, len(own)))
        self.ids.append(doc_id)
        self.lengths.append(len(own))
        self.held += len(text)

    def rows(self, batch: int, parts: int, find):
        import zlib

        import zstandard

        words: dict[str, int] = {}
        pieces, counts = [], []
        for chunk in self.code:
            own = find(chunk)
            counts.append(len(own))
            pieces.extend(words.setdefault(w, len(words)) for w in own)
        off = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
        chunks = np.concatenate(self.chunks)
        seq = ragged(np.array(pieces, dtype=np.uint32), off, chunks)
        ends = np.concatenate(([0], np.cumsum((off[1:] - off[:-1])[chunks])))
        bounds = ends[np.concatenate(([0], np.cumsum(self.lengths, dtype=np.int64)))]
        yield batch, batch, self.ids, None, bounds.astype(np.int64).tobytes(), planes(seq)
        pack = zstandard.ZstdCompressor(level=3).compress
        raw = [w.encode() for w in words]
        part = np.array([zlib.crc32(w) % parts for w in raw], dtype=np.int64)
        order = np.argsort(part, kind="stable")
        for p, i, j in cells(part[order]):
            own = order[i:j].tolist()                  # ascending: the order is stable
            yield (p, batch, None, planes(np.diff(order[i:j], prepend=0)),
                   planes(np.array([len(raw[x]) for x in own])), pack(b"".join(raw[x] for x in own)))


def _cut(pattern: str, parts: int, batch_bytes: int):
    def run(batches):
        import regex
        from pyspark import TaskContext

        find = regex.compile(pattern).findall
        split = regex.compile(r"(?V1)(?= \S)").split
        batch = -1 - (TaskContext.get().partitionId() << 32)
        own = _Batch()

        def flush():
            for row in own.rows(batch, parts, find):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], f.type) for v, f in zip(row, _CUT)], schema=_CUT)

        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                own.add(doc_id, text.as_py(), split)
                if own.held >= batch_bytes:
                    yield from flush()
                    batch, own = batch - 1, _Batch()
                    release()
        if own.ids:
            yield from flush()
        own = None
        release()
    return run


# --- 2: each distinct pre-token once ---------------------------------------------

_TOLD = pa.schema([("slot", pa.int64()), ("codes", pa.binary()), ("counts", pa.binary()),
                   ("tokens", pa.binary())])


def _encode(vocab: Vocabulary):
    own: dict = {}              # one encoder for all groups of a task

    def run(table: pa.Table) -> pa.Table:
        import zstandard

        if table.column("slot")[0].as_py() < 0:       # texts of a batch: nothing to encode
            return _TOLD.empty_table()
        if "e" not in own:
            own["e"] = vocab.encoder()
        encode = own["e"].encode_ordinary
        unpack = zstandard.ZstdDecompressor().decompress
        known: dict[bytes, list[int]] = {}
        counted, told = [], []
        for n, b in zip(table.column("nums"), table.column("body")):
            raw, at, counts, ids = unpack(b.as_py()), 0, [], []
            for k in unplanes(n.as_py()).tolist():
                w = raw[at:at + k]
                at += k
                got = known.get(w)
                if got is None:
                    got = known[w] = encode(w.decode())
                counts.append(len(got))
                ids.extend(got)
            counted.append(planes(np.array(counts)))
            told.append(planes(np.array(ids)))
        return pa.table([table.column("batch"), table.column("codes"), pa.array(counted, pa.binary()),
                         pa.array(told, pa.binary())], schema=_TOLD)
    return run


# --- 3, 4: reassemble by position, decode ------------------------------------------

OUT = "doc_id long, n_tokens long, ids array<int>, decoded binary"
_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())),
                  ("decoded", pa.binary())])


def decode(ids: np.ndarray, off: np.ndarray, table: tuple[np.ndarray, np.ndarray]
           ) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): the bytes of each run ``ids[off[i]:off[i + 1]]``."""
    data, at = table
    size = np.concatenate(([0], np.cumsum((at[1:] - at[:-1])[ids])))
    return ragged(data, at, ids), size[off]


def _assemble(vocab: Vocabulary):
    cache: dict = {}

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.column("slot")[0].as_py() >= 0:       # a range of pre-tokens: no text
            return _OUT.empty_table()
        if "t" not in cache:
            cache["t"] = vocab.byte_table()
        codes, counts, tokens = [], [], []
        for k, c, t in zip(right.column("codes"), right.column("counts"), right.column("tokens")):
            codes.append(np.cumsum(unplanes(k.as_py()), dtype=np.int64))
            counts.append(unplanes(c.as_py()))
            tokens.append(unplanes(t.as_py()))
        codes, counts, tokens = (np.concatenate(x) if x else np.zeros(0, t)
                                 for x, t in ((codes, np.int64), (counts, np.uint32), (tokens, np.uint32)))
        # offsets of each pre-token's ids, by its code
        begin = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
        start, end = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        start[codes], end[codes] = begin[:-1], begin[1:]
        seq = unplanes(left.column("body")[0].as_py()).astype(np.int64)
        bounds = np.frombuffer(left.column("nums")[0].as_buffer(), dtype=np.int64)
        ids = spans(tokens, start[seq], end[seq]).astype(np.int64)
        total = np.concatenate(([0], np.cumsum((end - start)[seq])))
        off = total[bounds]
        text, text_off = decode(ids, off, cache["t"])
        decoded = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(off) - 1, [None, pa.py_buffer(text_off.astype(np.int64)),
                                              pa.py_buffer(np.ascontiguousarray(text))])
        lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32()))
        return pa.table([left.column("ids")[0].values, pa.array(np.diff(off), pa.int64()), lists,
                         decoded.cast(pa.binary())], schema=_OUT)
    return run


def encode_decode(docs: DataFrame, vocab: Vocabulary, *, id_col: str = "doc_id",
                  text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per document: (doc_id, n_tokens long, ids array<int>, decoded
    binary: the bytes that the ids stand for).

    A NULL or empty text has no ids.  Rows that repeat an id or have a NULL id
    are encoded like others.  Special tokens are ordinary text.
    """
    base = keyed_text(docs, id_col, text_col)
    parts = block_count(docs.sparkSession, text_bytes(base), WORD_BYTES)
    cut = base.mapInArrow(_cut(vocab.pattern, parts, batch_bytes), CUT)
    # both uses read one exchange by slot, so texts are cut once
    told = cut.groupBy("slot").applyInArrow(
        lean(_encode(vocab)), "slot long, codes binary, counts binary, tokens binary")
    return cut.groupBy("slot").cogroup(told.groupBy("slot")).applyInArrow(lean_pair(_assemble(vocab)), OUT)
