"""Benchmark decontamination: prefix-filtered set join on word windows.

Method.  Every benchmark item becomes windows of ``window`` consecutive words
(one window, if it has fewer).  The words of a window are its tokens, ordered
by rarity over the whole corpus.  A text contains a window only if it contains
every token of it, so the necessary prefix is the single rarest token: all
corpus words are joined with the rarest tokens of the windows, the token's
place in the window fixes where the window would have to begin (positional
bound), windows that would leave the text are dropped (length bound), and the
rest is verified by comparing the whole window with the words there.

Only DataFrame functions run here.  A text never leaves its row: words are
exploded beside their array inside one stage, joined with a broadcast table of
benchmark tokens and compared in place, so no text is shuffled and no key of
the corpus gathers rows.  The benchmark side grows with the benchmark, not
with the corpus; it is cut into slices of at most ``slice_rows`` windows, each
checked against ``slice_bytes`` and broadcast, and a benchmark of any size is
taken slice by slice against all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from .common import materialize

WINDOW = 13
SLICE_ROWS = 50_000
SLICE_BYTES = 32 << 20
#: Words of the contract: runs outside ASCII but for digits and letters.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
FROM, TO = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Array of the words of a text (lower-cased A-Z); NULL has none."""
    low = F.translate(F.coalesce(text, F.lit("")), FROM, TO)
    trimmed = F.regexp_replace(low, rf"^{NOT_WORD}", "")
    parts = F.split(trimmed, NOT_WORD)
    # a leading separator is cut above; a trailing one leaves one empty part
    return F.filter(parts, lambda w: w != F.lit(""))


def digest_of(words: Column) -> Column:
    """Rows of one id and one digest have the same words, so the same hits."""
    return F.md5(F.array_join(words, " ").cast("binary"))


def item_windows(items: DataFrame, window: int = WINDOW, id_col: str = "item_id",
                 text_col: str = "text") -> DataFrame:
    """(win array<string>, n_win int, item_id string): every window of every
    item, once per item.  Items without words and NULL ids give none."""
    w = (items.filter(F.col(id_col).isNotNull())
              .select(F.col(id_col).cast("string").alias("item_id"),
                      words_of(F.col(text_col)).alias("ws"))
              .filter(F.size("ws") > 0))
    starts = F.sequence(F.lit(1), F.greatest(F.size("ws") - F.lit(window - 1), F.lit(1)))
    return (w.select("item_id", "ws", F.explode(starts).alias("at"))
             .select("item_id", F.slice("ws", F.col("at"), F.lit(window)).alias("win"))
             .select("win", F.size("win").alias("n_win"), "item_id").distinct())


def _slices(windows: DataFrame, slice_rows: int, slice_bytes: int) -> tuple[DataFrame, int]:
    """The windows with a slice number, in slices of bounded rows and bytes."""
    size = F.octet_length(F.array_join("win", " ")) + 64
    n, total = windows.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    # twice the least number, as rows are dealt by hash
    count = max(1, -(-2 * n // slice_rows), -(-2 * total // slice_bytes))
    if n <= slice_rows and total <= slice_bytes:
        count = 1
    return windows.withColumn("slice", F.pmod(F.xxhash64("win"), F.lit(count))), int(count)


def _exploded(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    base = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("ws"))
    return base.select("doc_id", "ws", F.posexplode("ws").alias("pos", "word"))


def rarity(docs: DataFrame, windows: DataFrame, count: int, text_col: str = "text") -> DataFrame:
    """(word, freq): occurrences over all documents of each word of the windows."""
    tokens = docs.select(F.explode(words_of(F.col(text_col))).alias("word"))
    out = None
    for s in range(count):
        own = (windows.filter(F.col("slice") == s)
                      .select(F.explode("win").alias("word")).distinct())
        part = (tokens.join(F.broadcast(own), "word").groupBy("word")
                      .agg(F.count(F.lit(1)).alias("freq")))
        out = part if out is None else out.unionByName(part)
    # a word of several slices has the same count in each
    return out.groupBy("word").agg(F.max("freq").alias("freq"))


def occurrences(docs: DataFrame, items: DataFrame, *, window: int = WINDOW,
                id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                item_text: str = "text", slice_rows: int = SLICE_ROWS,
                slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(doc_id, ws_md5 string: a digest of the text's words, start int from 0,
    n_win int, items array<string>): every place of a document where a benchmark
    window occurs, with the items that hold it.

    NULL or wordless texts and items have no occurrence; documents with a NULL
    id give rows with a NULL id; repeated rows repeat their occurrences.
    """
    all_windows = (item_windows(items, window, item_id, item_text)
                   .groupBy("win", "n_win")
                   .agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    windows, count = _slices(materialize(all_windows, "bench-windows"), slice_rows, slice_bytes)
    freq = materialize(rarity(docs, windows, count, text_col), "bench-rarity")
    # the rarest token of each window: least frequent, then by the word itself
    tokens = windows.select("win", "slice", F.posexplode("win").alias("at", "word"))
    # a token that no document has (no row in freq) rules the window out
    first = (tokens.join(freq, "word", "left")
                   .groupBy("win", "slice")
                   .agg(F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"),
                                       "word", "at")).alias("p"))
                   .filter(F.col("p.freq") > 0)
                   .select("win", "slice", F.col("p.word").alias("word"), F.col("p.at").alias("at")))
    prefix = materialize(first.join(windows.drop("slice"), "win"), "bench-prefix")
    exploded = _exploded(docs, id_col, text_col)
    out = None
    for s in range(count):
        own = prefix.filter(F.col("slice") == s).drop("slice")
        start = F.col("pos") - F.col("at")
        hit = (exploded.join(F.broadcast(own), "word")
                       .filter((start >= 0) & (start + F.col("n_win") <= F.size("ws")))
                       .filter(F.slice("ws", start + 1, F.col("n_win")) == F.col("win"))
                       .select("doc_id", digest_of(F.col("ws")).alias("ws_md5"), start.alias("start"),
                               "n_win", "items"))
        out = hit if out is None else out.unionByName(hit)
    return out


def contamination(docs: DataFrame, items: DataFrame, *, window: int = WINDOW,
                  id_col: str = "doc_id", text_col: str = "text", share: int = 20,
                  **kw) -> DataFrame:
    """One row per document: (doc_id, n_words long, n_hit long, n_items long,
    items array<string> sorted, contaminated boolean).

    A word is hit if an occurring window covers it; a document is contaminated
    if ``share * n_hit >= n_words`` and a word is hit.  Documents with NULL or
    wordless texts have zero counts.  Rows that repeat an id or have none count
    each by itself.
    """
    return _counted(docs, items, window, id_col, text_col, share, **kw).drop("key")


def _counted(docs, items, window, id_col, text_col, share, **kw) -> DataFrame:
    """The columns of ``contamination`` and ``key``, which tells rows of an id apart."""
    occ = materialize(occurrences(docs, items, window=window, id_col=id_col,
                                  text_col=text_col, **kw), "bench-hits")
    occ = occ.withColumnRenamed("ws_md5", "key")
    spans = occ.groupBy("doc_id", "key", "start").agg(F.max("n_win").alias("n_win"))
    end = F.col("start") + F.col("n_win")
    by_doc = Window.partitionBy("doc_id", "key").orderBy("start")
    done = F.coalesce(F.max(end).over(by_doc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    new = F.greatest(end - F.greatest(F.col("start"), done), F.lit(0))
    n_hit = (spans.select("doc_id", "key", new.alias("new")).groupBy("doc_id", "key")
                  .agg(F.sum("new").cast("long").alias("n_hit")))
    found = (occ.select("doc_id", "key", F.explode("items").alias("item")).distinct()
                .groupBy("doc_id", "key").agg(F.array_sort(F.collect_set("item")).alias("items")))
    hits = n_hit.join(found, n_hit["doc_id"].eqNullSafe(found["doc_id"])
                      & (n_hit["key"] == found["key"])).select(
        n_hit["doc_id"].alias("hit_id"), n_hit["key"].alias("hit_key"), "n_hit", "items")
    base = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("ws"))
    base = base.select("doc_id", F.size("ws").cast("long").alias("n_words"),
                       digest_of(F.col("ws")).alias("key"))
    none = F.array().cast(T.ArrayType(T.StringType()))
    joined = base.join(hits, base["doc_id"].eqNullSafe(hits["hit_id"])
                       & (base["key"] == hits["hit_key"]), "left")
    n = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id", "n_words", n.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"),
        ((n > 0) & (n * share >= F.col("n_words"))).alias("contaminated"), "key")


def remove_contaminated(docs: DataFrame, items: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id",
                        text_col: str = "text", share: int = 20, **kw) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns unchanged.
    Every row counts by itself, whatever its id.  Only ids and digests of
    contaminated rows are joined back."""
    bad = (_counted(docs, items, window, id_col, text_col, share, **kw).filter("contaminated")
           .select(F.col("doc_id").alias("bad_id"), F.col("key").alias("bad_md5")).distinct())
    return docs.join(bad, docs[id_col].eqNullSafe(bad["bad_id"])
                     & (digest_of(words_of(docs[text_col])) == bad["bad_md5"]), "left_anti")
