"""Language-model scores from a subword lattice.

A text is a sequence of words and one end.  A word's probability under the
subword model is the sum over all its segmentations into pieces of an existing
vocabulary, each weighing the product of its pieces' probabilities; a forward
recursion in log space over the word's bytes computes it.  Pieces never cross
a word's boundary, so the marginal probability of a document is the product
over its words, and each distinct word of the corpus passes the lattice once.

The vocabulary is given; its scores are learnt here: each distinct training
word is cut by the vocabulary's own tokenizer, and a piece's probability is its
add-one share of all pieces.  A word that training has seen has one more path,
the whole word, with its share of the training tokens; the weight of that path
against the pieces is the Good-Turing estimate 1 - n1 / N (n1: words seen once).
A word begins with a marked piece and goes on until the next mark or the end.  With
the end's share among tokens fixed, the pieces are scaled so that all words (byte
strings, those with blanks and the empty one included) and the end sum to 1.

Shape of the job: batches of texts keep their words as codes into the batch's
distinct words; the distinct words of all batches meet by hash, where training
counts are summed and the lattice is run; counts and log probabilities go back
to the batches, which add up their texts.  The tables grow with the corpus and
are never collected; only piece counts (one row per piece) reach the driver.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import block_count, text_bytes
from .exchange import cells, planes, unplanes
from .textvec import mix

U = np.uint64
BATCH_BYTES = 8 << 20
WORD_BYTES = 4 << 20            # text bytes for each part of the words
LONG = 256                      # bytes from which a word takes the scalar path
_MARK = b"\xff"                 # stands for the word mark; never part of UTF-8


# --- lattice ------------------------------------------------------------------------

class Lattice:
    """Log probability of a byte string, summed over all segmentations."""

    def __init__(self, pieces: list[bytes], logp: np.ndarray):
        joined: dict[bytes, float] = {}
        for p, lp in zip(pieces, logp.tolist()):
            joined[p] = float(np.logaddexp(joined[p], lp)) if p in joined else lp
        self.by_piece = joined
        self.longest = max(map(len, joined), default=0)
        self.base = U(0x9E3779B97F4A7C15)
        self.inv = U(pow(int(self.base), -1, 1 << 64))
        self.logp = np.array(list(joined.values()) + [-np.inf])
        self.keys = np.array([self._key(p) for p in joined] + [0], dtype=np.uint64)
        # two-step direct table: most keys alone in a slot, the rest by search
        slot = (self.keys[:-1] >> U(43)).astype(np.int64)
        self.table = np.full(1 << 21, len(joined), dtype=np.int32)
        self.table[slot] = np.arange(len(joined))
        self.crowded = np.bincount(slot, minlength=1 << 21) > 1
        self.order = np.argsort(self.keys[:-1])
        self.sorted = self.keys[:-1][self.order]

    def _key(self, piece: bytes) -> int:
        h, power = 0, 1
        for b in piece:
            h = (h + (b + 1) * power) & (2**64 - 1)
            power = power * int(self.base) & (2**64 - 1)
        with np.errstate(over="ignore"):
            return int(mix(np.array([h], dtype=np.uint64))[0])

    def _find(self, h: np.ndarray) -> np.ndarray:
        slot = (h >> U(43)).astype(np.int64)
        at = self.table[slot]
        at = np.where(self.keys[at] == h, at, len(self.keys) - 1)
        odd = np.nonzero(self.crowded[slot])
        if len(odd[0]):
            own = h[odd]
            i = np.minimum(np.searchsorted(self.sorted, own), len(self.sorted) - 1)
            at[odd] = np.where(self.sorted[i] == own, self.order[i], len(self.keys) - 1)
        return self.logp[at]

    def _equal_length(self, rows: np.ndarray) -> np.ndarray:
        n, size = rows.shape
        with np.errstate(over="ignore", divide="ignore"):
            power = np.cumprod(np.concatenate(([U(1)], np.full(size, self.base))))
            back = np.cumprod(np.concatenate(([U(1)], np.full(size, self.inv))))
            total = np.zeros((n, size + 1), dtype=np.uint64)
            np.cumsum((rows.astype(np.uint64) + U(1)) * power[:size], axis=1, out=total[:, 1:])
            alpha = np.full((n, size + 1), -np.inf)
            alpha[:, 0] = 0.0
            for j in range(1, size + 1):
                lo = max(0, j - self.longest)
                h = mix((total[:, j:j + 1] - total[:, lo:j]) * back[lo:j])
                terms = self._find(h) + alpha[:, lo:j]
                top = terms.max(axis=1)
                safe = np.where(np.isfinite(top), top, 0.0)
                alpha[:, j] = np.where(np.isfinite(top), safe + np.log(
                    np.exp(terms - safe[:, None]).sum(axis=1)), -np.inf)
        return alpha[:, -1]

    def _scalar(self, word: bytes) -> float:
        alpha = [0.0]
        for j in range(1, len(word) + 1):
            terms = []
            for i in range(max(0, j - self.longest), j):
                lp = self.by_piece.get(word[i:j])
                if lp is not None and alpha[i] > -math.inf:
                    terms.append(alpha[i] + lp)
            if terms:
                top = max(terms)
                alpha.append(top + math.log(sum(math.exp(t - top) for t in terms)))
            else:
                alpha.append(-math.inf)
        return alpha[-1]

    def log_marginals(self, words: list[bytes]) -> np.ndarray:
        out = np.empty(len(words))
        size = np.array([len(w) for w in words], dtype=np.int64)
        for n in np.unique(size).tolist():
            at = np.flatnonzero(size == n)
            if n >= LONG or n == 0:
                out[at] = [self._scalar(words[i]) for i in at.tolist()]
                continue
            step = max(1, 200_000 // (n * min(n, self.longest)))
            for lo in range(0, len(at), step):
                part = at[lo:lo + step]
                rows = np.frombuffer(b"".join(words[i] for i in part.tolist()), np.uint8)
                out[part] = self._equal_length(rows.reshape(len(part), n))
        return out


class Pieces:
    """Pieces of a sentencepiece file that words can be made of."""

    def __init__(self, path: str):
        import sentencepiece

        self.path = path
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids, self.bytes = [], []
        for i in range(self.sp.get_piece_size()):
            if self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_unused(i):
                continue
            p = self.sp.id_to_piece(i)
            raw = bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else (
                p.encode().replace("▁".encode(), _MARK))
            if raw.rfind(_MARK) <= 0:             # a mark inside never occurs in a word
                self.ids.append(i)
                self.bytes.append(raw)


def with_end(pieces: list[bytes], p: np.ndarray, end: float) -> np.ndarray:
    """Log probabilities of pieces (shares ``p``, sum 1), scaled so that the words
    they make sum to 1 - ``end``.

    With the marked pieces' mass a and the others' mass b, words sum to a / (1 - b);
    scaled by 1 - e both, that is 1 - end for e = end * a / (1 - end + end * a).
    """
    a = float(p[[x.startswith(_MARK) for x in pieces]].sum())
    return np.log(p) + math.log1p(-end * a / (1 - end + end * a))


# --- words of the corpus --------------------------------------------------------------

CUT = "batch long, part int, ids array<long>, nums binary, body binary"
_CUT = pa.schema([("batch", pa.int64()), ("part", pa.int32()), ("ids", pa.list_(pa.int64())),
                  ("nums", pa.binary()), ("body", pa.binary())])


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A-Z) runs of bytes other than space and 0x09-0x0D."""
    return text.encode("utf-8", "replace").lower().split()


class _Batch:
    def __init__(self):
        self.ids, self.train, self.seqs, self.held = [], [], [], 0
        self.code: dict[bytes, int] = defaultdict()
        self.code.default_factory = self.code.__len__

    def add(self, doc_id, text: str, train: bool) -> None:
        own = words_of(text)
        self.seqs.append(np.fromiter(map(self.code.__getitem__, own), np.uint32, len(own)))
        self.ids.append(doc_id)
        self.train.append(train)
        self.held += len(text)

    def rows(self, batch: int, parts: int, with_texts: bool):
        import zlib

        import zstandard

        size = np.array([len(s) for s in self.seqs], dtype=np.int64)
        seq = np.concatenate(self.seqs)
        if with_texts:
            bounds = np.concatenate(([0], np.cumsum(size)))
            yield batch, -1, self.ids, bounds.tobytes(), planes(seq)
        learnt = seq[np.repeat(np.array(self.train, dtype=bool), size)]
        count = np.bincount(learnt, minlength=len(self.code))
        words = list(self.code)
        part = np.array([zlib.crc32(w) % parts for w in words], dtype=np.int64)
        order = np.argsort(part, kind="stable")
        pack = zstandard.ZstdCompressor(level=1).compress
        for p, i, j in cells(part[order]):
            own = order[i:j]
            nums = np.array([own, [len(words[x]) for x in own.tolist()], count[own]], dtype=np.uint32)
            yield batch, p, None, pack(nums.tobytes()), pack(b"".join(words[x] for x in own.tolist()))


def _cut(parts: int, batch_bytes: int, with_texts: bool):
    def run(batches):
        from pyspark import TaskContext

        batch, own = TaskContext.get().partitionId() << 32, _Batch()

        def flush():
            for row in own.rows(batch, parts, with_texts):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], f.type) for v, f in zip(row, _CUT)], schema=_CUT)

        for b in batches:
            for doc_id, text, train in zip(b.column("doc_id").to_pylist(), b.column("text"),
                                           b.column("train").to_pylist()):
                own.add(doc_id, text.as_py(), train)
                if own.held >= batch_bytes:
                    yield from flush()
                    batch, own = batch + 1, _Batch()
        if own.ids:
            yield from flush()
    return run


def _totals(nums: pa.ChunkedArray, body: pa.ChunkedArray):
    """(distinct words, training counts, for each row the places of its words)."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    place: dict[bytes, int] = defaultdict()
    place.default_factory = place.__len__
    rows, counts = [], []
    for n, b in zip(nums, body):
        table = np.frombuffer(unpack(n.as_py()), dtype=np.uint32).reshape(3, -1)
        raw, ends = unpack(b.as_py()), np.cumsum(table[1]).tolist()
        begins = [0, *ends[:-1]]
        rows.append(np.fromiter((place[raw[x:y]] for x, y in zip(begins, ends)), np.int64, len(ends)))
        counts.append(table[2])
    at = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    total = np.bincount(at, weights=np.concatenate(counts) if counts else None,
                        minlength=len(place)).astype(np.int64)
    return list(place), total, rows


_TOKENS, _WORDS, _ONCE = -1, -2, -3


def _learn(path: str):
    """(piece, n): piece counts over distinct training words; under negative
    numbers the training tokens, the distinct words and the words seen once."""
    def run(table: pa.Table) -> pa.Table:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        words, total, _ = _totals(table.column("nums"), table.column("body"))
        seen = np.flatnonzero(total > 0)
        pieces = np.zeros(sp.get_piece_size(), dtype=np.int64)
        for lo in range(0, len(seen), 20_000):
            own = [words[i].decode("utf-8", "replace") for i in seen[lo:lo + 20_000].tolist()]
            ids = [x for e in sp.encode(own, num_threads=1) for x in e]
            pieces += np.bincount(np.array(ids, dtype=np.int64), minlength=len(pieces))
        used = np.flatnonzero(pieces)
        keys = np.concatenate((used, [_TOKENS, _WORDS, _ONCE]))
        values = np.concatenate((pieces[used], [total.sum(), len(seen), (total == 1).sum()]))
        return pa.table([pa.array(keys, pa.int32()), pa.array(values, pa.int64())], names=["piece", "n"])
    return run


def _answer(pieces: Pieces, logp: np.ndarray):
    path, own = pieces.path, {}       # the processor itself stays on the driver

    def run(table: pa.Table) -> pa.Table:
        import zstandard

        if "l" not in own:
            own["l"] = Lattice(Pieces(path).bytes, logp)
        words, total, rows = _totals(table.column("nums"), table.column("body"))
        marginal = own["l"].log_marginals([_MARK + w for w in words]).astype(np.float32)
        pack = zstandard.ZstdCompressor(level=1).compress
        counts = [pack(total[r].tobytes()) for r in rows]
        probs = [marginal[r].tobytes() for r in rows]
        return pa.table([table.column("batch"), table.column("part"), pa.array(counts, pa.binary()),
                         pa.array(probs, pa.binary())], names=["batch", "part", "counts", "probs"])
    return run


OUT = "doc_id long, n_tokens long, n_known long, base_score double, score double, lattice_score double"
_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                  ("base_score", pa.float64()), ("score", pa.float64()), ("lattice_score", pa.float64())])


def _score(n_tokens: int, n_types: int, n_ends: int, weight: float, end_share: float):
    def mixed(count, marginal):
        """log10 of the whole-word path and the pieces together."""
        with np.errstate(divide="ignore"):
            whole = np.log(weight * count / max(n_tokens, 1))
            return np.logaddexp(whole, math.log1p(-weight) + marginal) / math.log(10)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        own = left.filter(pc.equal(left.column("part"), -1))
        asked = left.filter(pc.greater_equal(left.column("part"), 0)).sort_by("part")
        told = right.sort_by("part")
        codes = [np.frombuffer(unpack(n.as_py()), np.uint32).reshape(3, -1)[0] for n in asked.column("nums")]
        codes = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
        count, marginal = np.zeros(len(codes), np.int64), np.zeros(len(codes))
        if len(codes):
            count[codes] = np.concatenate([np.frombuffer(unpack(c.as_py()), np.int64) for c in told.column("counts")])
            marginal[codes] = np.concatenate([np.frombuffer(p.as_py(), np.float32) for p in told.column("probs")])
        bounds = np.frombuffer(own.column("nums")[0].as_buffer(), dtype=np.int64)
        seq = unplanes(own.column("body")[0].as_py())
        n = len(bounds) - 1
        doc = np.repeat(np.arange(n), np.diff(bounds))
        denominator = n_tokens + n_types + 1
        base = np.log10((count + 1) / denominator)
        end_base = math.log10((n_ends + 1) / denominator)
        end = float(mixed(np.float64(n_ends), math.log(end_share)))

        def add(per_word, at_end):
            return np.bincount(doc, weights=per_word[seq], minlength=n) + at_end

        known = add((count > 0).astype(float), float(n_ends > 0)).astype(np.int64)
        return pa.table([own.column("ids")[0].values, pa.array(np.diff(bounds) + 1, pa.int64()),
                         pa.array(known, pa.int64()), pa.array(add(base, end_base)),
                         pa.array(add(mixed(count.astype(float), marginal), end)),
                         pa.array(add(marginal / math.log(10), math.log10(end_share)))], schema=_OUT)
    return run


def scores(docs: DataFrame, vocabulary: str, learn_from: Column | None = None, *,
           id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per document: (doc_id, n_tokens long, n_known long, base_score
    double, score double, lattice_score double, train_tokens long).

    Tokens are the words and one end.  ``score`` is the log10 probability of
    the text; ``lattice_score`` that of pieces alone (words that training saw
    have no path of their own); ``base_score`` sums the add-one log10 unigram
    probabilities.  ``n_known`` counts tokens that training has.  ``learn_from``
    picks the training rows (default: all; a NULL condition is no).
    ``vocabulary`` is the path of a sentencepiece file on every executor.

    A NULL, empty or blank text is its end alone.  Without training rows only
    pieces and ends count.  Rows that repeat an id or have none are scored each.
    """
    learn = F.lit(True) if learn_from is None else F.coalesce(learn_from, F.lit(False))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"), learn.alias("train"))
    parts = block_count(docs.sparkSession, text_bytes(base), WORD_BYTES)
    pieces = Pieces(vocabulary)
    found = (base.mapInArrow(_cut(parts, batch_bytes, False), CUT).groupBy("part")
                 .applyInArrow(_learn(vocabulary), "piece int, n long")
                 .groupBy("piece").agg(F.sum("n").alias("n")).collect())   # a row per piece
    n = {r["piece"]: r["n"] for r in found}
    n_ends = base.filter("train").count()
    n_tokens, once = n.get(_TOKENS, 0) + n_ends, n.get(_ONCE, 0)
    n_types = n.get(_WORDS, 0) + (n_ends > 0)
    weight = min(max(1 - once / n_tokens, 0.01), 0.99) if n_tokens else 0.0
    count = np.array([n.get(i, 0) + 1 for i in pieces.ids], dtype=np.float64)
    # one share more than the base's, so words keep some mass without training
    end_share = (n_ends + 1) / (n_tokens + n_types + 2)
    logp = with_end(pieces.bytes, count / count.sum(), end_share)
    cut = base.mapInArrow(_cut(parts, batch_bytes, True), CUT)
    asked = cut.groupBy("batch").applyInArrow(_ask, "batch long, part int, nums binary, body binary")
    told = asked.groupBy("part").applyInArrow(
        _answer(pieces, logp), "batch long, part int, counts binary, probs binary")
    out = (cut.groupBy("batch").cogroup(told.groupBy("batch"))
              .applyInArrow(_score(n_tokens, n_types, n_ends, weight, end_share), OUT))
    return out.withColumn("train_tokens", F.lit(n_tokens).cast("long"))


def _ask(table: pa.Table) -> pa.Table:
    return table.filter(pc.greater_equal(table.column("part"), 0)).select(
        ["batch", "part", "nums", "body"])
