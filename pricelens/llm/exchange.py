"""Ask-and-answer over blocks of keys: packed columns in few rows.

A corpus statistic per key (how many documents hold this shingle, which is
the smallest document with this window) needs each key of every text to meet
its equals.  One row per key would make billions of small rows, so keys travel
packed: texts are dealt to *batches*, each batch finds its distinct keys, and
one row per (batch, block) carries the sorted keys of a range of hash space
as bytes.  A block's task sees each key once per batch (a key that a third of
all documents hold is one entry per batch, not one per document), computes the
statistic and answers each batch in the order in which it asked.

Batches and blocks hold a fixed number of bytes of text on average; their
number grows with the input, their size does not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_count, keyed_text, text_bytes

U = np.uint64
BATCH_BYTES = 2 << 20
BLOCK_BYTES = 8 << 20


def dealt(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          batch_bytes: int = BATCH_BYTES, block_bytes: int = BLOCK_BYTES,
          carry: bool = False) -> tuple[DataFrame, int]:
    """((batch int, doc_id, text) of all rows, number of blocks); with
    ``carry`` the other columns come along in a struct ``row``, and ``no_text``
    marks NULL texts."""
    base = keyed_text(docs, id_col, text_col)
    n = text_bytes(base)
    if carry:
        base = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                           F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                           F.col(text_col).isNull().alias("no_text"),
                           F.struct(*[F.col(c) for c in docs.columns if c != text_col]).alias("row"))
    batches = block_count(docs.sparkSession, n, batch_bytes)
    blocks = block_count(docs.sparkSession, n, block_bytes)
    # rows of one id (or of no id) spread by their length
    batch = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(batches)).cast("int")
    return base.select(batch.alias("batch"), *base.columns), blocks


def block_of(g: np.ndarray, blocks: int) -> np.ndarray:
    """Block number of mixed 64-bit hashes (their high half)."""
    return (g >> U(32)) % U(blocks)


def cells(block: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(block, from, to) of each run of an ascending block array."""
    if not len(block):
        return
    cut = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [len(block)]))
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
        yield int(block[lo]), lo, hi


def joined(column: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of packed arrays, and the count in each row."""
    parts = [np.frombuffer(x.as_buffer(), dtype=dtype) for x in column]
    sizes = np.array([len(x) for x in parts], dtype=np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, dtype)), sizes


def answers(right: pa.Table, column: str, dtype, n: int) -> np.ndarray:
    """The answers to a batch, in the order of its keys (blocks ascending)."""
    if right.num_rows == 0:
        return np.zeros(n, dtype=dtype)
    right = right.sort_by("block")
    return joined(right.column(column), dtype)[0]


def planes(values: np.ndarray) -> bytes:
    """Codes as four byte planes, compressed (high planes are nearly constant)."""
    import zstandard

    split = values.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(split).tobytes())


def unplanes(data: bytes) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").reshape(-1)


def steps(ascending: np.ndarray) -> bytes:
    """Ascending 32-bit keys by their differences (small ones, as keys of one cell
    share a range)."""
    return planes(np.diff(ascending, prepend=ascending.dtype.type(0)))


def unsteps(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data), dtype=np.uint32)
