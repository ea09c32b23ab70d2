"""Substring dedup by level-wise doubling.

A window is a run of consecutive words of one document.  The search goes by
levels of window length: a first length of about half the wanted one, then
up to twice the length at each level.  At the first level every window is a
candidate.  A window of a later level is a candidate only if the two shorter
windows that cover it were found repeated, so windows repeated at one length
alone are extended, until the wanted length is reached (``max_words``) or no
candidate survives.

Each level is one exchange (see ``exchange``): a batch of texts asks for its
distinct candidate windows, packed by block of hash space; a block answers
each in the order asked.  Below the wanted length the answer is "held by two
documents or more" and 32-bit keys per block serve, as a chance match only
keeps a candidate alive for the next level.  From the wanted length on, keys
are 64-bit hashes inside blocks dealt by a second, independent 64-bit hash,
and the answer also says whether a document with a smaller id holds it.

Words covered by such a window are removed.  Windows are judged on the input,
not on what is left after removals.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, lean_pair, materialize
from .exchange import answers, block_of, cells, dealt, joined, steps, unsteps
from .textvec import find_words, joined_words, mix, window_hashes, window_starts, word_hashes

U = np.uint64
WINDOW = 13
FIRST_LEVEL = 5
_NO_ID = np.iinfo(np.int64).max
_SMALLER, _ELSEWHERE = 1, 2      # answers: starts in a smaller document / in another batch


def levels_to(window: int, least: int = FIRST_LEVEL) -> list[int]:
    """Lengths up to ``window``, each at most twice the one before; the first
    is the shortest of at least ``least`` words."""
    out = [window]
    while (out[0] + 1) // 2 >= least:
        out.insert(0, (out[0] + 1) // 2)
    return out


class _Batch:
    """Windows of one batch of texts, level by level."""

    def __init__(self, table: pa.Table, window: int, blocks: int):
        self.window, self.blocks = window, blocks
        self.words = find_words(table.column("text"))
        ids = table.column("doc_id").combine_chunks().fill_null(_NO_ID)
        self.ids = ids.to_numpy(zero_copy_only=False).astype(np.int64)
        self.h = word_hashes(self.words)
        self.h2 = None
        self.level, self.alive = 0, None

    def candidates(self, level: int) -> np.ndarray:
        if self.alive is None:
            return window_starts(self.words.first, level)
        at = np.flatnonzero(self.alive)
        shift = level - self.level
        inside = at + shift < len(self.alive)
        at = at[inside]
        at = at[self.alive[at + shift]]
        # both halves lie in the same text
        first = self.words.first
        doc = np.searchsorted(first, at, "right") - 1
        return at[at + level <= first[doc + 1]]

    def ask(self, level: int):
        """(positions, order, run starts, block, key, value) of a level."""
        at = self.candidates(level)
        hashes = window_hashes(self.h, level)[at] if len(at) else np.zeros(0, np.uint64)
        block = block_of(hashes, self.blocks)
        ids = self.ids[np.searchsorted(self.words.first, at, "right") - 1]
        if level < self.window:
            key = mix(hashes) & U(0xFFFFFFFF)
        else:
            if self.h2 is None:
                self.h2 = word_hashes(self.words, seed=1)
            key = window_hashes(self.h2, level)[at] if len(at) else hashes
        order = np.lexsort((key, block))
        block, key = block[order], key[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (block[1:] != block[:-1]) | (key[1:] != key[:-1])
        runs = np.flatnonzero(new)
        if len(runs):
            low = np.minimum.reduceat(ids[order], runs)
            high = np.maximum.reduceat(ids[order], runs)
        else:
            low = high = np.zeros(0, np.int64)
        return at, order, new, block[runs], key[runs], low, high, ids

    def learn(self, level: int, right: pa.Table) -> None:
        """Take in the answers of a level."""
        at, order, new, block, _, low, high, ids = self.ask(level)
        mine = right.filter(pa.compute.equal(right.column("level"), level))
        told = answers(mine, "told", np.uint8, len(block))
        run = np.cumsum(new) - 1
        n = int(self.words.first[-1])
        # repeated: candidates of the next level, the first holder's included
        self.alive = np.zeros(n + 1, dtype=bool)
        self.alive[at[order][((told & _ELSEWHERE) > 0)[run] | (low < high)[run]]] = True
        # also in a document with a smaller id
        self.later = np.zeros(n, dtype=bool)
        if level >= self.window:
            self.later[at[order][((told & _SMALLER) > 0)[run] | (ids[order] > low[run])]] = True
        self.level = level


ASKED = "block int, batch int, key binary, value binary, here boolean"
_ASKED = pa.schema([("block", pa.int32()), ("batch", pa.int32()), ("key", pa.binary()),
                    ("value", pa.binary()), ("here", pa.bool_())])


def _emit(levels: list[int], window: int, blocks: int):
    """Questions of the last level, given answers to those before it."""
    def emit(left: pa.Table, right: pa.Table | None) -> pa.Table:
        state = _Batch(left, window, blocks)
        for level in levels[:-1]:
            state.learn(level, right)
        _, _, _, block, key, low, high, _ = state.ask(levels[-1])
        src = left.column("batch")[0].as_py()
        if levels[-1] < window:
            key, value = key.astype(np.uint32), np.zeros(0, np.uint8)     # the key alone is asked
            pack = steps
        else:
            value, pack = low, np.ndarray.tobytes
        here = low < high                 # held by two documents of this batch
        rows = [(b, src, pack(key[i:j]), value[i:j].tobytes(), bool(here[i:j].any()))
                for b, i, j in cells(block)]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 5, _ASKED)],
                        schema=_ASKED)
    if len(levels) == 1:
        return lambda table: emit(table, None)

    def cogrouped(left: pa.Table, right: pa.Table) -> pa.Table:
        return emit(left, right) if left.num_rows else _ASKED.empty_table()
    return cogrouped


def _answer(level: int, window: int):
    def answer(table: pa.Table) -> pa.Table:
        exact = level >= window
        if exact:
            key, sizes = joined(table.column("key"), np.uint64)
        else:
            parts = [unsteps(x.as_py()) for x in table.column("key")]
            key, sizes = np.concatenate(parts), np.array([len(x) for x in parts])
        value, _ = joined(table.column("value"), np.int64)
        order = np.argsort(key, kind="stable")
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[order][1:] != key[order][:-1]
        runs, run = np.flatnonzero(new), np.cumsum(new) - 1
        told = np.zeros(len(key), dtype=np.uint8)
        if len(runs):
            several = (np.diff(np.append(runs, len(key))) > 1)[run]
            told[order] = several * np.uint8(_ELSEWHERE)
            if exact:
                told[order] |= (value[order] > np.minimum.reduceat(value[order], runs)[run]) * np.uint8(_SMALLER)
        parts = np.split(told, np.cumsum(sizes)[:-1])
        alive = [h or bool(x.any()) for h, x in zip(table.column("here").to_pylist(), parts)]
        n = len(parts)
        return pa.table([table.column("block"), table.column("batch"), pa.array([level] * n, pa.int32()),
                         pa.array([x.tobytes() for x in parts], pa.binary()), pa.array(alive, pa.bool_())],
                        names=["block", "batch", "level", "told", "alive"])
    return answer


def _remove(levels: list[int], window: int, blocks: int, row_type):
    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["doc_id", "n_words", "n_removed", "longest", "spans", "kept"]
        state = _Batch(left, window, blocks)
        words, first = state.words, state.words.first
        n = int(first[-1])
        gone = np.zeros(n, dtype=bool)
        longest = np.zeros(left.num_rows, dtype=np.int32)
        for level in levels:
            state.learn(level, right)
            at = np.flatnonzero(state.later)
            if level == window:
                cover = np.zeros(n + 1, dtype=np.int32)
                cover[at] += 1
                np.subtract.at(cover, at + window, 1)
                gone = np.cumsum(cover[:-1]) > 0
            if level >= window:
                longest[np.searchsorted(first, at, "right") - 1] = level
        total = np.concatenate(([0], np.cumsum(gone)))
        removed = total[first[1:]] - total[first[:-1]]
        edge = np.zeros(n + 1, dtype=bool)      # a run of removed words never crosses a text
        edge[first] = True
        before = np.concatenate(([False], gone[:-1]))
        begin = np.flatnonzero(gone & (~before | edge[:-1]))
        after = np.concatenate((gone[1:], [False]))
        end = np.flatnonzero(gone & (~after | edge[1:])) + 1
        at = np.searchsorted(begin, first)
        base = first[:-1][np.searchsorted(first, begin, "right") - 1]
        pairs = pa.StructArray.from_arrays([pa.array((begin - base).astype(np.int32)),
                                            pa.array((end - base).astype(np.int32))], ["start", "end"])
        data, off = joined_words(words, ~gone)
        kept = pa.LargeStringArray.from_buffers(len(off) - 1, pa.py_buffer(off.astype(np.int64)),
                                                pa.py_buffer(np.ascontiguousarray(data)))
        cols = [left.column("doc_id"), pa.array(np.diff(first), pa.int64()), pa.array(removed, pa.int64()),
                pa.array(longest), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pairs),
                kept.cast(pa.string())]
        if row_type:
            text = pa.compute.if_else(left.column("no_text"), pa.scalar(None, pa.string()),
                                      left.column("text"))
            cols += [left.column("row"), text]
            names += ["row", "text"]
        return pa.table(cols, names=names)

    def cogrouped(left: pa.Table, right: pa.Table) -> pa.Table:
        return remove(left, right)
    return cogrouped


def repeated_words(docs: DataFrame, *, window: int = WINDOW, max_words: int | None = WINDOW,
                   id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per document: (doc_id, n_words long, n_removed long, longest int,
    spans array<struct<start,end>>, kept string).

    ``spans`` are the removed words (word numbers from 0, end exclusive): those
    covered by a window of ``window`` words that also starts in a document with
    a smaller id.  ``kept`` is the other words joined by one space.  ``longest``
    is the longest level whose window is repeated so (0: none): levels go up
    to ``max_words``, or with None on until no candidate survives.  With
    ``carry`` two columns more: ``row`` (struct of the other columns) and the
    unchanged ``text``.

    NULL and wordless texts have no words.  Windows inside one document, and
    rows that repeat an id, do not repeat each other (no smaller id); a NULL id
    is larger than every id.
    """
    batches, blocks = dealt(docs, id_col, text_col, carry=carry)
    levels = levels_to(window)
    todo, done, told = list(levels), [], None
    while todo:
        done.append(todo.pop(0))
        if told is None:
            asked = batches.groupBy("batch").applyInArrow(lean(_emit(list(done), window, blocks)), ASKED)
        else:
            asked = (batches.groupBy("batch").cogroup(told.groupBy("batch"))
                          .applyInArrow(lean_pair(_emit(list(done), window, blocks)), ASKED))
        new = asked.groupBy("block").applyInArrow(
            lean(_answer(done[-1], window)), "block int, batch int, level int, told binary, alive boolean")
        longer = max_words is None or max_words >= 2 * done[-1]
        if done[-1] >= window and longer:
            new = materialize(new, "windows-told")
            if not new.filter("alive").isEmpty():
                todo.append(2 * done[-1])
        told = new if told is None else told.unionByName(new)
    out = ("doc_id long, n_words long, n_removed long, longest int, "
           "spans array<struct<start:int,end:int>>, kept string")
    if carry:
        out += f", row {batches.schema['row'].dataType.simpleString()}, text string"
    return (batches.groupBy("batch").cogroup(told.groupBy("batch"))
                   .applyInArrow(lean_pair(_remove(done, window, blocks, carry)), out))


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id",
                   text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` without the repeated words, columns unchanged in name and order.
    A text that loses words becomes its kept words joined by one space, and
    ``chars_col`` (if the table has it) its new length; other rows, NULL texts
    included, stay as they are.  No row is dropped."""
    got = repeated_words(docs, window=window, id_col=id_col, text_col=text_col, carry=True)
    lost = F.col("n_removed") > 0
    cols = []
    for c in docs.columns:
        if c == text_col:
            col = F.when(lost, F.col("kept")).otherwise(F.col("text"))
        elif c == chars_col:
            col = F.when(lost, F.length("kept").cast("long")).otherwise(F.col("row")[c])
        else:
            col = F.col("row")[c]
        cols.append(col.alias(c))
    return got.select(*cols)
