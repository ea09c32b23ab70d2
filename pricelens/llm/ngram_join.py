"""N-gram Jaccard join: blocked sparse product of document by n-gram incidence.

A document's row of the incidence matrix is the set of its 5-word shingles
(64-bit hashes).  Two documents link when ``100 * overlap >= percent * union``.

1. *Column statistics, in blocks.*  Texts are dealt to batches; every batch
   sends its distinct columns (shingles), packed by column block, with the
   number of its documents that hold them.  A block sums them and answers
   each column's document count as one rarity byte (monotone in the count).
2. *Row bound.*  A linked document shares at least ``ceil(percent * n / 100)``
   of its n columns with one other document, so rows with fewer columns of
   count two or more can have no link and are discarded with all entries.
3. *Blocked product.*  For the rows left only the entries among the
   ``n - ceil(percent * n / 100) + 1`` rarest columns can hold a pair's first
   common column.  Equal rows (copies) collapse to one class first.  Entries
   of one column propose pairs, thinned by the size bound
   (``100 * smaller >= percent * larger``) and by the bound that follows from
   the ranks of the common column.
   An overlap is at most the lesser number of shared columns (count two or
   more) of the two rows, so pairs whose rows share too little fall away too.
4. *Exact overlaps.*  Proposed pairs get their full overlap from the sorted
   rows.  A column with m rows first proposes pairs with one pivot row (the one
   that shares the largest part of itself: the original of edited copies), and
   only rows not yet connected are paired with each other afterwards, so
   groups of thousands of near copies cost links in proportion to their
   size and no component is lost.

No text, row or column is sampled or capped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sizing import discard
from .common import lean, lean_pair, materialize
from .components import components
from .exchange import answers, block_of, cells, dealt, joined, steps, unsteps
from .textvec import Words, find_words, mix, window_hashes, window_starts, word_hashes

U = np.uint64
SHINGLE = 5
PERCENT = 80
STAR_ROUNDS = 2


def shingle_sets(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the ascending distinct shingles of each text; fewer
    than k words make one shingle of all, no words make none."""
    h = word_hashes(w)
    at = window_starts(w.first, k)
    full = window_hashes(h, k)[at] if len(at) else np.zeros(0, np.uint64)
    doc = np.searchsorted(w.first, at, "right") - 1
    counts = w.counts()
    docs, hashes = [doc], [full]
    for n in range(1, k):
        short = np.flatnonzero(counts == n)
        if len(short):
            docs.append(short)
            hashes.append(window_hashes(h, n)[w.first[short]])
    doc, hashes = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    doc, hashes = doc[new], hashes[new]
    return hashes, np.searchsorted(doc, np.arange(len(counts) + 1))


def _columns(texts: pa.ChunkedArray, k: int, blocks: int):
    """Sets of a batch and its distinct columns in block order."""
    sets, off = shingle_sets(find_words(texts, lower=True), k)
    g = mix(sets ^ U(0xA5A5A5A5A5A5A5A5))
    key = (block_of(g, blocks) << U(32)) | (g & U(0xFFFFFFFF))
    uniq, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    return sets, off, uniq, inverse, count


def _emit(k: int, blocks: int):
    def emit(table: pa.Table) -> pa.Table:
        _, _, uniq, _, count = _columns(table.column("text"), k, blocks)
        src = table.column("batch")[0].as_py()
        res, few = uniq.astype(np.uint32), np.minimum(count, 255).astype(np.uint8)
        rows = [(b, src, steps(res[i:j]), few[i:j].tobytes())
                for b, i, j in cells(uniq >> U(32))]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, (
            pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["block", "batch", "res", "cnt"])
    return emit


def _count(table: pa.Table) -> pa.Table:
    """Rarity byte of each asked column: 0 for one document, then eight steps
    for each doubling."""
    res = np.concatenate([unsteps(x.as_py()) for x in table.column("res")])
    cnt, sizes = joined(table.column("cnt"), np.uint8)
    _, inverse = np.unique(res, return_inverse=True)
    total = np.bincount(inverse, weights=cnt)
    rarity = np.minimum(255, np.ceil(8 * np.log2(np.maximum(total, 1)))).astype(np.uint8)[inverse]
    cut = np.cumsum(sizes)[:-1]
    parts = [x.tobytes() for x in np.split(rarity, cut)]
    return pa.table([table.column("block"), table.column("batch"), pa.array(parts, pa.binary())],
                    names=["block", "batch", "rarity"])


ROWS = "doc_id long, md5 string, ent long, n int, toks binary, pre array<struct<tok:long,rank:int>>"


def least_overlap(n, percent: int):
    """ceil(percent * n / 100)"""
    return (n * percent + 99) // 100


def _select(k: int, blocks: int, percent: int):
    schema = pa.schema([("doc_id", pa.int64()), ("md5", pa.string()), ("ent", pa.int64()), ("n", pa.int32()),
                        ("toks", pa.binary()),
                        ("pre", pa.list_(pa.struct([("tok", pa.int64()), ("rank", pa.int32())])))])

    def select(left: pa.Table, right: pa.Table) -> pa.Table:
        sets, off, uniq, inverse, _ = _columns(left.column("text"), k, blocks)
        rarity = answers(right, "rarity", np.uint8, len(uniq))[inverse]
        ids = left.column("doc_id").to_pylist()
        out: list[list] = [[] for _ in range(6)]
        sent: set[int] = set()
        for d, (doc_id, text) in enumerate(zip(ids, left.column("text"))):
            i, j = int(off[d]), int(off[d + 1])
            n = j - i
            own = sets[i:j]
            ent = (int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(),
                                  "little", signed=True) if n else None)
            toks = pre = None
            rare = rarity[i:j]
            shared = rare > 0
            least = least_overlap(n, percent)
            if n and ent not in sent and int(shared.sum()) >= least:
                sent.add(ent)                 # copies in one batch send their row once
                first = n - least + 1
                order = np.lexsort((own, rare))[:first]
                alone = int((~shared).sum())  # columns of one document rank first
                order = order[alone:]
                toks = own[shared].tobytes()
                pre = [{"tok": t, "rank": alone + r}
                       for r, t in enumerate(own[order].view(np.int64).tolist())]
            md5 = hashlib.md5(text.as_buffer(), usedforsecurity=False).hexdigest()
            for c, v in zip(out, (doc_id, md5, ent, n, toks, pre)):
                c.append(v)
        return pa.table([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)
    return select


def incidence(docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, md5 of the text, ent, n, toks, pre).  ``ent`` names the
    set (NULL without words); ``toks`` and ``pre`` are given for rows that
    pass the row bound (once per batch among copies)."""
    batches, blocks = dealt(docs, id_col, text_col)
    asked = batches.groupBy("batch").applyInArrow(
        lean(_emit(shingle, blocks)), "block int, batch int, res binary, cnt binary")
    told = asked.groupBy("block").applyInArrow(lean(_count), "block int, batch int, rarity binary")
    return (batches.groupBy("batch").cogroup(told.groupBy("batch"))
                   .applyInArrow(lean_pair(_select(shingle, blocks, percent)), ROWS))


def _overlap(percent: int):
    def run(batches):
        for b in batches:
            left, right = b.column("toks_a"), b.column("toks_b")
            na, nb = b.column("n_a").to_pylist(), b.column("n_b").to_pylist()
            inter = [len(np.intersect1d(np.frombuffer(x.as_buffer(), np.uint64),
                                        np.frombuffer(y.as_buffer(), np.uint64),
                                        assume_unique=True)) for x, y in zip(left, right)]
            ok = [100 * i >= percent * (x + y - i) for i, x, y in zip(inter, na, nb)]
            yield pa.RecordBatch.from_arrays(
                [b.column("a"), b.column("b"), pa.array(inter, pa.int32()), pa.array(ok, pa.bool_())],
                names=["a", "b", "overlap", "linked"])
    return run


def verify(pairs: DataFrame, rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b, overlap, linked) of proposed pairs from their sorted rows."""
    x = rows.select(F.col("ent").alias("a"), F.col("n").alias("n_a"), F.col("toks").alias("toks_a"))
    y = rows.select(F.col("ent").alias("b"), F.col("n").alias("n_b"), F.col("toks").alias("toks_b"))
    full = pairs.join(x, "a").join(y, "b").select("a", "b", "n_a", "n_b", "toks_a", "toks_b")
    return full.mapInArrow(_overlap(percent), "a long, b long, overlap int, linked boolean")


def _possible(n_x: str, s_x: str, n_y: str, s_y: str, percent: int):
    """Sizes n and shared columns s of two rows admit a link."""
    return ((F.least(n_x, n_y) * 100 >= F.greatest(n_x, n_y) * percent)
            & (F.least(s_x, s_y) * (100 + percent) >= (F.col(n_x) + F.col(n_y)) * percent))


def linked_sets(rows: DataFrame, percent: int = PERCENT, star_rounds: int = STAR_ROUNDS) -> DataFrame:
    """(node, comp) of the sets (``ent``) that have a link."""
    shared = F.floor(F.octet_length("toks") / 8).cast("int")
    pre = (rows.select("ent", "n", shared.alias("s"), F.explode("pre").alias("p"))
               .select(F.col("p.tok").alias("tok"), "ent", "n", "s", F.col("p.rank").alias("rank")))
    several = pre.groupBy("tok").agg(F.min("ent").alias("lo"), F.max("ent").alias("hi"))
    several = several.filter("lo <> hi").select("tok")
    entries = materialize(pre.join(several, "tok", "left_semi"), "jaccard-entries")
    tested = comp = None
    for step in range(star_rounds):
        own = entries.withColumn("comp", F.col("ent")) if comp is None else _labelled(entries, comp)
        # the pivot of a column: first the row that shares most of itself, later any
        first = (-F.col("s") / F.col("n")) if step == 0 else F.xxhash64(F.col("ent"), F.lit(step))
        pivot = own.groupBy("tok").agg(
            F.min(F.struct(first.alias("first"), "ent", "n", "s", "comp")).alias("p"),
            F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        pivot = pivot.filter("lo <> hi").select(
            "tok", F.col("p.ent").alias("pivot"), F.col("p.comp").alias("p_comp"),
            F.col("p.n").alias("p_n"), F.col("p.s").alias("p_s"))
        met = (own.join(pivot, "tok").filter("comp <> p_comp")
                  .filter(_possible("n", "s", "p_n", "p_s", percent))
                  .groupBy("ent", "pivot").agg(F.count(F.lit(1)).alias("common")))
        met = met.select(F.greatest("ent", "pivot").alias("a"), F.least("ent", "pivot").alias("b"),
                         "ent", "common")
        if tested is not None:
            met = met.join(tested.select("a", "b"), ["a", "b"], "left_anti")
        # each row tries the pivot it meets most often
        best = met.groupBy("ent").agg(F.max(F.struct("common", "a", "b")).alias("m"))
        pairs = materialize(best.select("m.a", "m.b").distinct(), "jaccard-pairs")
        if pairs.isEmpty():
            break
        got = materialize(verify(pairs, rows, percent), "jaccard-tested")
        tested = got if tested is None else tested.unionByName(got)
        new = got.filter("linked").isEmpty()
        comp = materialize(components(tested.filter("linked").select("a", "b")), "jaccard-comp")
        if new:
            break
    own = entries.withColumn("comp", F.col("ent")) if comp is None else _labelled(entries, comp)
    # columns that still join several components: all their pairs across components
    open_ = own.groupBy("tok").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    own = own.join(open_.filter("lo <> hi").select("tok"), "tok", "left_semi")
    x = own.select("tok", *[F.col(c).alias(f"{c}_a") for c in ("ent", "n", "s", "rank", "comp")])
    y = own.select("tok", *[F.col(c).alias(f"{c}_b") for c in ("ent", "n", "s", "rank", "comp")])
    best = F.least(F.col("n_a") - F.col("rank_a"), F.col("n_b") - F.col("rank_b"))
    rest = (x.join(y, "tok").filter("ent_a > ent_b AND comp_a <> comp_b")
             .filter(_possible("n_a", "s_a", "n_b", "s_b", percent))
             .filter(best * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b")))
             .select(F.col("ent_a").alias("a"), F.col("ent_b").alias("b")).distinct())
    if tested is not None:
        rest = rest.join(tested.select("a", "b"), ["a", "b"], "left_anti")
    got = materialize(verify(materialize(rest, "jaccard-pairs"), rows, percent), "jaccard-tested")
    tested = got if tested is None else tested.unionByName(got)
    return components(tested.filter("linked").select("a", "b"))


def _labelled(entries: DataFrame, comp: DataFrame) -> DataFrame:
    return (entries.join(comp, entries["ent"] == comp["node"], "left")
                   .select("tok", "ent", "n", "s", "rank", F.coalesce("comp", "ent").alias("comp")))


def _linked(docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str):
    """Written tables: all rows (doc_id, md5, n, ent), classes of equal sets, and
    the components (node, comp) of the classes that have a link."""
    found = materialize(incidence(docs, shingle=shingle, percent=percent, id_col=id_col,
                                  text_col=text_col), "jaccard-rows")
    # one row for each class of equal sets
    rows = materialize(found.filter("toks IS NOT NULL").dropDuplicates(["ent"])
                       .select("ent", "n", "toks", "pre"), "jaccard-classes")
    all_rows = materialize(found.select("doc_id", "md5", "n", "ent"), "jaccard-documents")
    discard(found)
    comp = materialize(linked_sets(rows, percent), "jaccard-comp")
    return all_rows, rows, comp


def near_duplicate_groups(docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT,
                          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, n_shingles long, component_id long).

    component_id is the least id reachable by links, its own included.  A
    NULL, empty or wordless text has an empty set and links with nothing.
    Equal sets are links.  Rows that repeat an id are documents of their own;
    a NULL id links others but never names a component (a component of NULL
    ids only has a NULL name).
    """
    all_rows, rows, comp = _linked(docs, shingle, percent, id_col, text_col)
    classes = (all_rows.filter("ent IS NOT NULL").groupBy("ent").agg(F.min("doc_id").alias("least")))
    named = (classes.join(comp, classes["ent"] == comp["node"], "left")
                    .select("ent", "least", F.coalesce("comp", "ent").alias("comp")))
    names = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    by_set = (named.select("ent", "comp").join(names, "comp")
                   .select(F.col("ent").alias("set_id"), "component_id"))
    base = all_rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "ent")
    out = materialize(base.join(by_set, base["ent"] == by_set["set_id"], "left")
                          .select("doc_id", "n_shingles",
                                  F.when(F.col("ent").isNull(), F.col("doc_id"))
                                   .otherwise(F.col("component_id")).alias("component_id")),
                      "jaccard-groups")
    for t in (all_rows, rows, comp):          # three columns are left of all this
        discard(t)
    return out


def one_per_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  **kw) -> DataFrame:
    """The rows of ``docs`` whose id names their group (the least id of each
    component), all columns unchanged; rows with a NULL id stay."""
    groups = near_duplicate_groups(docs, id_col=id_col, text_col=text_col, **kw)
    gone = (groups.filter("component_id <> doc_id").select(F.col("doc_id").alias("gone_id")).distinct())
    return docs.join(gone, docs[id_col] == gone["gone_id"], "left_anti")


def one_row_per_group(docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component and the rows without words, all columns
    unchanged.  The row of the least id stays (NULL ids last, ties by the MD5
    of the text); of rows equal in id and text any one.  Unlike in
    ``one_per_group`` rows are told apart whatever their id."""
    all_rows, rows, comp = _linked(docs, shingle, percent, id_col, text_col)
    with_words = all_rows.filter("ent IS NOT NULL")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "md5")
    classes = with_words.groupBy("ent").agg(F.min(row).alias("least"))
    named = (classes.join(comp, classes["ent"] == comp["node"], "left")
                    .select("ent", "least", F.coalesce("comp", "ent").alias("comp")))
    stay = named.groupBy("comp").agg(F.min("least").alias("stay"))
    by_set = named.select(F.col("ent").alias("set_id"), "comp").join(stay, "comp").select("set_id", "stay")
    counted = with_words.groupBy("ent", "doc_id", "md5").agg(F.count(F.lit(1)).alias("copies"))
    told = materialize(
        counted.join(by_set, counted["ent"] == by_set["set_id"])
               .select("doc_id", "md5", "copies",
                       (F.col("doc_id").eqNullSafe(F.col("stay.doc_id")) & (F.col("md5") == F.col("stay.md5")))
                       .alias("stays"))
               .filter("copies > 1 OR NOT stays"), "jaccard-gone")
    for t in (all_rows, rows, comp):          # only rows that go or repeat are left of all this
        discard(t)

    def same(t: DataFrame):
        md5 = F.md5(F.coalesce(docs[text_col], F.lit("")).cast("binary"))
        return docs[id_col].cast("long").eqNullSafe(t["row_id"]) & (md5 == t["row_md5"])
    told = told.select(F.col("doc_id").alias("row_id"), F.col("md5").alias("row_md5"), "stays")
    out = docs.join(told, same(told), "left_anti")
    again = told.filter("stays")
    if again.isEmpty():
        return out
    return out.union(docs.join(again, same(again), "left_semi").dropDuplicates([id_col, text_col]))
