"""Conversation prefix trie: block digests first, turns only where siblings part.

Each conversation is cut into blocks of ``BLOCK`` turns (the last may be shorter),
and each block gets the digest of everything up to its end: md5 of the digest
before it and its turns' digests.  Conversations are grouped by (digest before,
block), so a block that a third of all conversations share is one row after the
map-side sums, and everything below works on distinct blocks.  A boundary behind
which all members go on with one and the same block has no branch inside that
block: its turns are nodes as they stand.  Only where two or more different blocks
follow one boundary are the turns inside them given prefix digests and grouped.

Sums over subtrees use the chain of each node's smallest member: the nodes that a
conversation names form one run of its path down to its last turn, and each run
hangs on a node of another one.  Totals of runs are found by pointer doubling
(log2 of the tree's height rounds, a written table each), and a running sum from
the bottom of each run gives every node's subtree.

Digests are md5 over (role, text) with their lengths; two different prefixes of n
meet with a chance of about n * n / 2**129.

Odd rows: NULL role or text is empty; rows with a NULL conv_id name no conversation
and take no part; NULL turns come first; rows of one turn are ordered by role and
text; repeated rows are repeated turns.  No conversation: no node, not even a root.
A conversation without rebuilt turns is a member (and end) of the root.  Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Turns in a block.
BLOCK = 4
#: Bytes of a turn in a block: its digest, then its code points (big-endian).
ENTRY = 16 + 8
ROOT = b""


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth from 1, role, text) of every row in turn order."""
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    in_turn = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.select("conv_id", F.row_number().over(in_turn).cast("long").alias("depth"), "role", "text")


def entries(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, entry): each turn as digest and length, its text left behind."""
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    entry = F.concat(F.unhex(F.md5(said.cast("binary"))),
                     F.unhex(F.lpad(F.hex(F.length("text").cast("long")), 16, "0")))
    return rows.select("conv_id", "depth", entry.alias("entry"))


def rebuilt(rows: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """(conv_id, depth, entry) after each conversation's first h turns have made
    place for the first h of conversation ``conv_id - conv_id % group``;
    h = crc32 of the decimal id % ``heads``.  A conversation left without turns has
    one row of depth 0 and a NULL entry.  ``rows``: (conv_id, depth, entry)."""
    def h(c):
        return (F.crc32(F.col(c).cast("string").cast("binary")) % heads).cast("long")

    rows = materialize(rows, "trie-turns")
    ids = rows.groupBy("conv_id").agg(F.max("depth").alias("n"))
    # at most heads - 1 turns of each first conversation of a group
    first = (rows.filter((F.col("conv_id") % group == 0) & (F.col("depth") < heads))
             .groupBy(F.col("conv_id").alias("base"))
             .agg(F.array_sort(F.collect_list(F.struct("depth", "entry"))).alias("head")))
    ids = ids.select("conv_id", "n", h("conv_id").alias("h"),
                     (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    ids = ids.join(first, "base", "left").select(
        "conv_id", "n", "h", F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array()).alias("head"))
    taken = ids.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.depth", "t.entry")
    # where the head is shorter than h, own turns move up
    moved = ids.select("conv_id", "h", F.size("head").cast("long").alias("got"))
    own = (rows.join(moved, "conv_id").filter("depth > h")
           .select("conv_id", (F.col("depth") - F.col("h") + F.col("got")).alias("depth"), "entry"))
    none = (ids.filter((F.size("head") == 0) & (F.col("n") <= F.col("h")))
            .select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("entry")))
    return taken.unionByName(own).unionByName(none)


# --- blocks ---------------------------------------------------------------------

BLOCKS = "conv_id long, level long, before binary, block binary, last boolean"


def _blocks(size: int):
    """Blocks of conversations whose sorted turns stream past."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.bool_())
        names = ["conv_id", "level", "before", "block", "last"]
        now, level, before, block, out = None, 0, ROOT, [], []

        def close(last):
            out.append((now, level, before, b"".join(block), last))

        for b in batches:
            for conv, entry in zip(b.column("conv_id").to_pylist(), b.column("entry").to_pylist()):
                if conv != now:
                    if now is not None:
                        close(True)
                    now, level, before, block = conv, 0, ROOT, []
                elif len(block) == size:          # a turn follows: the full block is not the last
                    close(False)
                    before, level, block = hashlib.md5(before + b"".join(block)).digest(), level + 1, []
                if entry is not None:
                    block.append(entry)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                out.clear()
        if now is not None:
            close(True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
    return run


def blocks(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """(conv_id, level, before, block, last) from (conv_id, depth, entry)."""
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "depth")
    return dealt.select("conv_id", "entry").mapInArrow(_blocks(size), BLOCKS)


def _prefix(before, block, n):
    """Digest of the first n turns of a block behind ``before``; the root for none."""
    some = F.unhex(F.md5(F.concat(before, F.substring(block, F.lit(1), n * ENTRY))))
    return F.when(n == 0, before).otherwise(some)


def nodes(conv_blocks: DataFrame, size: int = BLOCK) -> DataFrame:
    """(node, above, depth, conv_id, n_convs, chars, refined) of every node but the root."""
    distinct = (conv_blocks.filter(F.length("block") > 0).groupBy("level", "before", "block")
                .agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")))
    distinct = materialize(distinct, "trie-blocks")
    following = distinct.groupBy(F.col("before").alias("b")).agg(F.count(F.lit(1)).alias("siblings"))
    known = distinct.join(following, F.col("before") == F.col("b"), "left")
    n = F.col("i")
    each = (known.select("*", F.explode(F.sequence(F.lit(1), (F.length("block") / ENTRY).cast("int"))).alias("i"))
            .select(_prefix(F.col("before"), F.col("block"), n).alias("node"),
                    _prefix(F.col("before"), F.col("block"), n - 1).alias("above"),
                    (F.col("level") * size + n).alias("depth"), "conv_id", "n_convs",
                    F.conv(F.hex(F.substring("block", n * ENTRY - 7, F.lit(8))), 16, 10).cast("long").alias("chars"),
                    (F.col("siblings") > 1).alias("refined")))
    each = materialize(each, "trie-turn-nodes")
    parted = (each.filter("refined").groupBy("node", "above", "depth", "chars")
              .agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs")))
    out = ["node", "above", "depth", "conv_id", "n_convs", "chars"]
    return each.filter("NOT refined").select(*out).unionByName(parted.select(*out))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ascending ids of each node, as they stream past."""
    now, h, out = None, None, []
    for b in batches:
        for node, conv in zip(b.column("end").to_pylist(), b.column("conv_id").to_pylist()):
            if node != now:
                if now is not None:
                    out.append((now, h.hexdigest()))
                now, h = node, hashlib.sha256(b"%d" % conv)
            else:
                h.update(b",%d" % conv)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.binary(), pa.string()))],
                                             names=["end", "ends_sha256"])
            out = []
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([h.hexdigest()])],
                                         names=["end", "ends_sha256"])


def ends(conv_blocks: DataFrame) -> DataFrame:
    """(end, ends_sha256): digest of the ids of the conversations that end at a node."""
    whole = (F.length("block") / ENTRY).cast("int")
    last = conv_blocks.filter("last").select(_prefix(F.col("before"), F.col("block"), whole).alias("end"), "conv_id")
    dealt = last.repartition("end").sortWithinPartitions("end", "conv_id")
    return dealt.mapInArrow(_ends, "end binary, ends_sha256 string")


# --- the trie -------------------------------------------------------------------

def _totals(runs: DataFrame) -> DataFrame:
    """(conv_id, saved, leaves): sums of each run and all runs below it.  ``runs``:
    (conv_id, up, saved, leaves); after round k a run holds all runs less than 2**k
    steps below it, and ``up`` is the run 2**k steps above."""
    while not runs.filter("up IS NOT NULL").isEmpty():
        hung = runs.filter("up IS NOT NULL").groupBy(F.col("up").alias("c")).agg(
            F.sum("saved").alias("s"), F.sum("leaves").alias("l"))
        above = runs.filter("up IS NOT NULL").select(F.col("conv_id").alias("d"), F.col("up").alias("next"))
        runs = materialize(
            runs.join(hung, F.col("conv_id") == F.col("c"), "left")
                .join(above, F.col("up") == F.col("d"), "left")
                .select("conv_id", F.col("next").alias("up"),
                        (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
                        (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves")), "trie-runs")
    return runs.select("conv_id", "saved", "leaves")


def trie(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """One row for each node: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.  ``rows``: (conv_id,
    depth from 1, entry), one row of depth 0 for a conversation without turns."""
    cut = materialize(blocks(rows, size), "trie-conversations")
    first = (cut.filter("level = 0").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
             .filter("n_convs > 0"))
    root = first.select(F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("above"),
                        F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs",
                        F.lit(0).cast("long").alias("chars"))
    flat = materialize(nodes(cut, size).unionByName(root), "trie-nodes")
    below = flat.groupBy(F.col("above").alias("a")).agg(F.count(F.lit(1)).alias("n_children"))
    up = flat.select(F.col("node").alias("u"), F.col("conv_id").alias("parent_conv_id"))
    # a third of all nodes may hang on one: the planner splits hot keys of these joins
    full = (flat.join(below, F.col("node") == F.col("a"), "left")
            .join(up, F.col("above") == F.col("u"), "left")
            .select("node", "depth", "conv_id", "parent_conv_id", "n_convs",
                    F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
                    ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
                    F.col("n_children").isNull().cast("long").alias("leaf")))
    full = materialize(full, "trie-linked")
    runs = materialize(
        full.groupBy("conv_id").agg(F.min_by("parent_conv_id", "depth").alias("up"),
                                    (F.min("depth") - 1).alias("at"), F.sum("saved").alias("saved"),
                                    F.sum("leaf").alias("leaves")), "trie-runs")
    total = _totals(runs.select("conv_id", "up", "saved", "leaves"))
    hung = (runs.select(F.col("conv_id").alias("r"), "up", "at").join(total, F.col("r") == F.col("conv_id"))
            .groupBy("up", "at").agg(F.sum("saved").alias("s"), F.sum("leaves").alias("l")))
    from_end = (Window.partitionBy("conv_id").orderBy(F.col("depth").desc())
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    got = (full.join(hung, (full["conv_id"] == F.col("up")) & (full["depth"] == F.col("at")), "left")
           .select("node", "depth", full["conv_id"], "parent_conv_id", "n_convs", "n_children",
                   (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
                   (F.col("leaf") + F.coalesce("l", F.lit(0))).alias("leaf"))
           .withColumn("saved_tokens", F.sum("saved").over(from_end))
           .withColumn("n_leaves", F.sum("leaf").over(from_end)))
    done = ends(cut)
    return (got.join(done, F.col("node") == F.col("end"), "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))
