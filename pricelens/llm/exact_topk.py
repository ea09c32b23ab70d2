"""Exact top-k search by tiled matrix products.

Queries are cut into blocks of bounded bytes.  For each block all candidate
vectors pass through one scan: a task multiplies its candidates, tile by tile,
with the block's queries, selects k per query in each tile and merges them into
its running lists, so it emits k per query however many rows it read.  The
lists of all tasks merge in a tree of fixed fan-in.

Products are integer and exact: in floating point while every sum stays below
2**53, else in 64-bit or unbounded integers.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import materialize

K = 20
SCALE = 64.0
BLOCK_BYTES = 24 << 20
TILE = 4096
QUERIES = 512
FAN_IN = 32
GROUP = 256
_LOW = -(1 << 63) + 1            # below every score; its negative fits


def quantised(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding",
              scale: float = SCALE) -> DataFrame:
    """(vec_id long, x array<long>): floor(scale * component).  NULL ids, NULL
    vectors and vectors with a NULL or non-finite component are left out."""
    x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).filter(~bad)
    return rows.select(F.col(id_col).cast("long").alias("vec_id"),
                       F.transform(x, lambda v: F.floor(v * F.lit(scale))).alias("x"))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of two int64 matrices, as int64;
    sums beyond 64 bits stop at the ends of the range."""
    if not q.shape[1]:
        return np.zeros((len(q), len(x)), dtype=np.int64)
    top = [max((abs(int(m.min())), abs(int(m.max())))) if m.size else 0 for m in (q, x)]
    most = top[0] * top[1] * q.shape[1]
    if most < 1 << 53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return q @ x.T
    wide = q.astype(object) @ x.astype(object).T
    return np.clip(wide, _LOW + 1, (1 << 63) - 1).astype(np.int64)


class _Lists:
    """Running best lists of the queries of one block and dimension."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, q, k
        self.score = np.full((len(ids), k), _LOW, dtype=np.int64)
        self.vec = np.full((len(ids), k), np.iinfo(np.int64).max, dtype=np.int64)

    def tile(self, vec: np.ndarray, x: np.ndarray) -> None:
        order = np.argsort(vec, kind="stable")
        vec, x = vec[order], x[order]
        for lo in range(0, len(self.ids), QUERIES):
            part = slice(lo, lo + QUERIES)
            s = products(self.q[part], x)
            first = np.searchsorted(vec, self.ids[part], "left")
            last = np.searchsorted(vec, self.ids[part], "right")
            for i in np.flatnonzero(last > first):
                s[i, first[i]:last[i]] = _LOW            # the query itself
            keep = min(self.k, s.shape[1])
            # candidates worse than the k-th so far cannot enter; ids ascend, so
            # the first of equal scores wins in a stable order
            if s.shape[1] > keep:
                cut = -np.partition(-s, keep - 1, axis=1)[:, keep - 1]
                best = np.empty((len(s), keep), dtype=np.int64)
                for i in range(len(s)):
                    at = np.flatnonzero(s[i] >= cut[i])
                    if len(at) > keep:
                        at = at[np.argsort(-s[i, at], kind="stable")[:keep]]
                    best[i] = at
            else:
                best = np.broadcast_to(np.arange(keep), (len(s), keep))
            self.merge(part, np.take_along_axis(s, best, 1), vec[best])

    def merge(self, part: slice, score: np.ndarray, vec: np.ndarray) -> None:
        score = np.concatenate((self.score[part], score), axis=1)
        vec = np.concatenate((self.vec[part], vec), axis=1)
        vec = np.where(score == _LOW, np.iinfo(np.int64).max, vec)
        order = _order(score, vec)[:, :self.k]
        self.score[part] = np.take_along_axis(score, order, 1)
        self.vec[part] = np.take_along_axis(vec, order, 1)


def _order(score: np.ndarray, vec: np.ndarray) -> np.ndarray:
    """Columns by falling score, then rising id."""
    return np.lexsort((vec, ~score), axis=1)


_PART = "dim int, grp int, salt long, ids binary, scores binary, vecs binary"
_KINDS = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
_NAMES = ["dim", "grp", "salt", "ids", "scores", "vecs"]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) if dim else \
        np.zeros((len(column), 0), dtype=np.int64)


def _scan(queries: dict, k: int):
    """``queries``: dimension -> (ids, matrix)."""
    def run(batches):
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId()
        lists = {d: _Lists(ids, q, k) for d, (ids, q) in queries.items()}
        for b in batches:
            x = b.column("x")
            size = pa.compute.list_value_length(x).to_numpy(zero_copy_only=False)
            vec = b.column("vec_id").to_numpy()
            for d, own in lists.items():
                at = np.flatnonzero(size == d)
                m = _matrix(x.take(pa.array(at)), d)
                for lo in range(0, len(at), TILE):
                    own.tile(vec[at[lo:lo + TILE]], m[lo:lo + TILE])
        for d, own in lists.items():
            for g, lo in enumerate(range(0, len(own.ids), GROUP)):
                part = slice(lo, lo + GROUP)
                row = (d, g, salt, own.ids[part].tobytes(), own.score[part].tobytes(),
                       own.vec[part].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _KINDS)],
                                                 names=_NAMES)
    return run


def _merge(k: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by("salt").to_pylist()
        ids = np.frombuffer(rows[0]["ids"], np.int64)
        total = _Lists(ids, np.zeros((len(ids), 0), np.int64), k)
        for r in rows:
            shape = (len(ids), k)
            total.merge(slice(None), np.frombuffer(r["scores"], np.int64).reshape(shape),
                        np.frombuffer(r["vecs"], np.int64).reshape(shape))
        row = (rows[0]["dim"], rows[0]["grp"], rows[0]["salt"], ids.tobytes(),
               total.score.tobytes(), total.vec.tobytes())
        return pa.table([pa.array([v], t) for v, t in zip(row, _KINDS)], names=_NAMES)
    return run


def _unpack(k: int):
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                ids = np.frombuffer(r["ids"], np.int64)
                score = np.frombuffer(r["scores"], np.int64)
                vec = np.frombuffer(r["vecs"], np.int64)
                rank = np.tile(np.arange(1, k + 1, dtype=np.int32), len(ids))
                some = score > _LOW
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, k)[some]), pa.array(rank[some]), pa.array(vec[some]),
                     pa.array(score[some])], names=["query_id", "rank", "vec_id", "score"])
    return run


def topk(queries: DataFrame, vectors: DataFrame, *, k: int = K,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id long, rank int from 1, vec_id long, score long): for each query
    its k highest inner products (all, if fewer), ties to the smaller vec_id.

    Both tables are (vec_id, x) as ``quantised`` gives.  Candidates are the
    rows whose id is not the query's; vectors of another length than the
    query's do not compare.  Rows that repeat an id are candidates of their
    own; of query rows that repeat an id the least vector is the query.  No
    queries or no candidates: no rows.
    """
    spark = vectors.sparkSession
    q = queries.groupBy("vec_id").agg(F.min("x").alias("x"))
    q = materialize(q, "topk-queries")
    size = int(q.agg(F.sum(F.size("x") * 8 + 8 + 16 * k)).first()[0] or 0)
    blocks = max(1, math.ceil(2 * size / block_bytes))       # dealt by hash: half full on average
    base = scratch_path(spark, f"topk/{uuid.uuid4().hex}")
    for b in range(blocks):
        own = q.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id").toArrow()
        by_dim: dict[int, tuple] = {}
        length = pa.compute.list_value_length(own.column("x")).to_numpy()
        for d in np.unique(length).tolist():
            part = own.filter(pa.array(length == d)).combine_chunks()
            ids, x = part.column("vec_id").to_numpy(), part.column("x")
            x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
            by_dim[d] = (ids, _matrix(x, d))
        lists = vectors.mapInArrow(_scan(by_dim, k), _PART)
        n = vectors.rdd.getNumPartitions()
        while n > 1:
            n = math.ceil(n / FAN_IN)
            lists = (lists.withColumn("salt", F.floor(F.col("salt") / FAN_IN).cast("long"))
                          .groupBy("dim", "grp", "salt").applyInArrow(_merge(k), _PART))
        (lists.mapInArrow(_unpack(k), "query_id long, rank int, vec_id long, score long")
              .write.parquet(f"{base}/block={b}"))
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(
        *[f"{base}/block={b}" for b in range(blocks)])
