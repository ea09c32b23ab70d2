"""Toxicity from the nearest labelled examples.

1. *Vectors.*  The terms are the words of a text (lower-cased; ASCII other than
   letters parts words), all of them.  Weights are (1 + ln tf) * idf * lean, vectors
   have length one.  Document frequencies over all documents give idf.  A term that
   no example has weighs as one that no document has: it lowers all cosines of its
   text alike.  ``lean`` is ``BASE`` for a term that says nothing of the label and
   grows with the root of its chi-square among the examples; no term is left out.
2. *Index.*  The examples' vectors form an inverted index.  Terms that many
   examples have are rows of a matrix, which multiplies the vectors of some texts
   together; the other terms' lists are read once for each text that has them.  So
   a text gets its cosine with every example, and the k nearest are exact.
3. *Votes.*  Neighbours vote with their cosine; the votes shrink towards the share
   of toxic examples among those without a toxic-leaning term.  A text without a
   neighbour (no word in common with any example) gets that share.

Bounds: ``sample`` labelled examples (smallest hash of the id) of at most
``example_bytes`` bytes each (larger labelled texts teach nothing), whatever the
size of the corpus; everything else covers all rows and whole texts.
"""

from __future__ import annotations

from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

SAMPLE = 4096
EXAMPLE_BYTES = 65536
BASE = 0.03
CHANCE = 15.0        # chi-square that chance gives some term of a large vocabulary
K = 15
SHRINK = 0.25
TEXTS = 32           # texts whose cosines are worked out together
FREQUENT = 0.125     # a term in a larger share of the examples is a row of the matrix

_SPACE = bytes.maketrans(bytes(x for x in range(128) if not chr(x).isalpha()),
                         b" " * sum(not chr(x).isalpha() for x in range(128)))


def _split(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(_SPACE).split()


def words(text: str | None) -> Counter:
    """Word -> occurrences of a whole text."""
    return Counter(_split(text))


def _numbers(found, number: dict[bytes, int]) -> np.ndarray:
    """The number of each word, -1 for one without."""
    return np.fromiter(map(number.get, found, repeat(-1)), np.int64, len(found))


# --- 1: vectors ------------------------------------------------------------------------

def _example_terms(batches):
    for b in batches:
        got = [words(t.as_py()) for t in b.column("text")]
        yield pa.RecordBatch.from_arrays(
            [b.column("key"), b.column("label"), pa.array([list(g) for g in got], pa.list_(pa.binary())),
             pa.array([list(g.values()) for g in got], pa.list_(pa.int32()))],
            names=["key", "label", "terms", "tf"])


def _frequencies(vocabulary: list[bytes]):
    """(term, documents that have it) of a partition; term -1 counts documents."""
    def run(batches):
        number = {t: i for i, t in enumerate(vocabulary)}
        seen, rows = np.zeros(len(vocabulary) + 1, np.int64), 0      # the last: of words without a number
        for b in batches:
            for text in b.column("text"):
                rows += 1
                seen[_numbers(set(_split(text.as_py())), number)] += 1
        at = np.flatnonzero(seen[:-1])
        for lo in range(0, len(at), 10_000):
            part = at[lo:lo + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(seen[part])],
                                             names=["term", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([rows], pa.int64())],
                                         names=["term", "n"])
    return run


def chi_square(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    """Of each term held by ``pos`` toxic and ``neg`` other examples; 0 for terms
    that lean to the others."""
    total, held = n_pos + n_neg, pos + neg
    below = held * (total - held) * float(n_pos) * float(n_neg)
    with np.errstate(divide="ignore", invalid="ignore"):
        got = total * (pos * (n_neg - neg) - neg * (n_pos - pos)) ** 2 / below
    return np.where((below > 0) & (pos * n_neg > neg * n_pos), got, 0.0)


# --- 2, 3: inverted index and votes --------------------------------------------------------

def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one range after the other."""
    first = np.cumsum(length) - length
    return np.repeat(start - first, length) + np.arange(int(length.sum()))


class Index:
    """Examples with at least one term, and the terms' lists of them."""

    def __init__(self, weight: np.ndarray, rows: list[tuple], labels_without: tuple[int, int],
                 unknown: float = 0.0):
        """weight: of each term; rows: (doc_id, label, at, tf); labels_without:
        (toxic, all) of the examples that the prior counts; unknown: weight of a
        term without a number."""
        self.weight, self.unknown = weight, unknown
        vectors = [self.entries(r[2], r[3]) for r in rows]
        self.ids = np.array([r[0] for r in rows], dtype=np.int64)
        self.label = np.array([r[1] for r in rows], dtype=np.float64)
        self.n, terms = len(rows), len(weight)
        none = [np.zeros(0)]
        term = np.concatenate([at for at, _ in vectors] or none).astype(np.int64)
        value = np.concatenate([w for _, w in vectors] or none)
        row = np.repeat(np.arange(self.n), [len(at) for at, _ in vectors])
        # frequent terms: 0 where an example lacks the term
        count = np.bincount(term, minlength=terms)
        frequent = np.flatnonzero(count > FREQUENT * self.n)
        self.place = np.full(terms, -1)
        self.place[frequent] = np.arange(len(frequent))
        place = self.place[term]
        self.dense = np.zeros((len(frequent), self.n))
        self.dense[place[place >= 0], row[place >= 0]] = value[place >= 0]
        # the others: their lists one after the other
        by_term = np.flatnonzero(place < 0)
        by_term = by_term[np.argsort(term[by_term], kind="stable")]
        self.row, self.value = row[by_term], value[by_term]
        self.size = np.where(self.place < 0, count, 0)
        self.begin = np.cumsum(self.size) - self.size
        toxic, total = labels_without
        self.prior = (toxic + 0.5) / (total + 1.0) if total else (
            float((self.label.sum() + 0.5) / (len(self.label) + 1.0)))

    def entries(self, at, tf, other: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of length one; ``other``: sum of (1 + ln tf) squared
        over the words without a number."""
        at = np.asarray(at, dtype=np.int64)
        w = (1 + np.log(np.asarray(tf, dtype=np.float64))) * self.weight[at]
        norm = np.sqrt((w * w).sum() + other * self.unknown ** 2)
        return at, w / norm if norm > 0 else w

    def vector(self, at, tf) -> np.ndarray:
        v = np.zeros(len(self.weight))
        at, w = self.entries(at, tf)
        v[at] = w
        return v

    def cosines(self, queries: list[tuple]) -> np.ndarray:
        """Of each (at, tf[, other]) with every example."""
        common, got = np.zeros((len(queries), len(self.dense))), np.zeros((len(queries), self.n))
        for i, query in enumerate(queries):
            at, w = self.entries(*query)
            place, size = self.place[at], self.size[at]
            common[i, place[place >= 0]] = w[place >= 0]
            post = _ranges(self.begin[at], size)
            got[i] = np.bincount(self.row[post], weights=np.repeat(w, size) * self.value[post], minlength=self.n)
        return got + common @ self.dense

    def _best(self, cosine: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        floor = max(1e-12, np.partition(cosine, -k)[-k] - 1e-9) if self.n > k else 1e-12
        hit = np.flatnonzero(cosine > floor)
        order = np.lexsort((self.ids[hit], -np.round(cosine[hit], 12)))[:k]
        return hit[order], cosine[hit[order]]

    def nearest(self, queries: list[tuple], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each (at, tf[, other]) the (examples, cosines) of the k nearest with a
        positive cosine, by falling cosine, ties by the example's id; exact."""
        if not self.n:
            return [(np.zeros(0, np.int64), np.zeros(0))] * len(queries)
        return [self._best(c, k) for lo in range(0, len(queries), TEXTS)
                for c in self.cosines(queries[lo:lo + TEXTS])]

    def vote(self, best: np.ndarray, cosine: np.ndarray) -> float:
        return float((self.prior * SHRINK + (cosine * self.label[best]).sum()) / (SHRINK + cosine.sum()))


def build(examples: pa.Table, df: np.ndarray, n_docs: int, number: np.ndarray) -> Index:
    """The index of (key, label, terms, tf) examples; ``number``: of each example's
    terms, one after the other; ``df``: documents that have a term."""
    label = np.array(examples.column("label").to_pylist(), dtype=np.int64)
    sizes = np.array([len(x) for x in examples.column("tf").to_pylist()], dtype=np.int64)
    tf = (np.concatenate([np.asarray(x, np.int64) for x in examples.column("tf").to_pylist() if x])
          if len(number) else np.zeros(0, np.int64))
    toxic = np.repeat(label, sizes) > 0
    chi = chi_square(np.bincount(number[toxic], minlength=len(df)).astype(float),
                     np.bincount(number[~toxic], minlength=len(df)).astype(float),
                     int(label.sum()), int((label == 0).sum()))
    lean = np.sqrt(np.maximum(chi - CHANCE, 0) / max(len(label), 1))
    weight = (np.log((1 + n_docs) / (1 + df)) + 1) * (BASE + lean)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    keys, rows, rest = examples.column("key").to_pylist(), [], [0, 0]
    for i, (lo, hi) in enumerate(zip(ends[:-1], ends[1:])):
        if hi > lo:
            rows.append((keys[i], int(label[i]), number[lo:hi], tf[lo:hi]))
        if not (lean[number[lo:hi]] > 0).any():
            rest[0] += int(label[i])
            rest[1] += 1
    return Index(weight, rows, (rest[0], rest[1]), (np.log(1 + n_docs) + 1) * BASE)


_SCORED = ("doc_id long, score double, predicted int, "
           "evidence array<struct<doc_id:long,cosine:double,label:int>>")


def _score(vocabulary: list[bytes], index: Index, k: int, evidence: int):
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))

    def run(batches):
        number = {t: i for i, t in enumerate(vocabulary)}
        for b in batches:
            scores, shown, texts = [], [], b.column("text")
            for lo in range(0, len(texts), TEXTS):
                queries = []
                for text in texts[lo:lo + TEXTS]:
                    found = words(text.as_py())
                    at = _numbers(found, number)
                    tf = np.fromiter(found.values(), np.int64, len(found))
                    known = at >= 0
                    queries.append((at[known], tf[known], float(((1 + np.log(tf[~known])) ** 2).sum())))
                for (at, _, _), (best, cosine) in zip(queries, index.nearest(queries, k)):
                    scores.append(index.vote(best, cosine) if len(at) else index.prior)
                    shown.append([{"doc_id": int(index.ids[e]), "cosine": float(c), "label": int(index.label[e])}
                                  for e, c in zip(best[:evidence].tolist(), cosine.tolist())])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(shown, kind)],
                names=["doc_id", "score", "predicted", "evidence"])
    return run


def toxicity(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, *,
             id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             sample: int = SAMPLE, example_bytes: int = EXAMPLE_BYTES, k: int = K,
             evidence: int = 3) -> DataFrame:
    """One row per document: (doc_id, score double in 0..1, predicted int,
    evidence array<struct<doc_id, cosine, label>>: its nearest examples).

    Examples are the labelled documents that ``learn_from`` (a condition on the
    label rows) admits; NULL ids and labels teach nothing, of label rows that
    repeat an id the larger label counts, and of document rows that repeat it
    the least text.  NULL, empty and letterless texts, and texts without a word in
    common with an example, have no neighbour and score the prior; without any
    example every text scores 0.5 and predicts 1.
    """
    own = labels.filter(learn_from) if learn_from is not None else labels
    own = (own.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(F.col(id_col).cast("long").alias("key"))
              .agg((F.max(label_col) > 0).cast("int").alias("label")))
    # at most ``sample`` rows
    chosen = F.broadcast(materialize(own.orderBy(F.xxhash64("key"), "key").limit(sample), "toxic-sample"))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    small = F.coalesce(F.octet_length("text"), F.lit(0)) <= example_bytes
    examples = (base.filter(small).join(chosen, base["doc_id"] == chosen["key"])
                    .groupBy("key", "label").agg(F.min("text").alias("text"))
                    .mapInArrow(_example_terms, "key long, label int, terms array<binary>, tf array<int>")
                    .toArrow().sort_by("key"))
    terms = examples.column("terms").combine_chunks().flatten().dictionary_encode()
    if isinstance(terms, pa.ChunkedArray):
        terms = terms.combine_chunks()
    vocabulary = terms.dictionary.to_pylist()
    number = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    got = (base.select("text").mapInArrow(_frequencies(vocabulary), "term int, n long")
               .groupBy("term").agg(F.sum("n").alias("n")).toArrow())      # a row per term of the examples
    df = np.zeros(len(vocabulary) + 1)
    df[got.column("term").to_numpy()] = got.column("n").to_numpy()
    index = build(examples, df[:-1], int(df[-1]), number)
    return base.mapInArrow(_score(vocabulary, index, k, evidence), _SCORED)
