"""Conversation structure repair: the cheapest edits, as one integer minimum.

A conversation is legal if the initials of its roles match ``(s?(ua)+)?``.  Every
row is kept, gets another role, or is deleted, and empty user / assistant turns may
be inserted; each edit has a cost and a letter (K, R, D, I).  The edits form a
directed acyclic graph over (row, what stands last, turns inserted), and a path's
weight is one integer: the cost in the high digits, below it one base-5 digit for
each audit letter at its fixed place (D < I < K < R, zero for no letter, so a
shorter audit is padded at its end).  The least integer that reaches an accepting
node is the cheapest script and, among these, the ASCII-least audit; cost and
letters are read off its digits, no back pointers are kept.

The graph is walked while a conversation's rows stream past in turn order: four
live nodes, each with its weight and the running hash of the turns it keeps.  To
keep integers short, after every ``BLOCK`` letters the low digits are replaced by
their rank among the live nodes (audits of one length compare the same).  Where an
insertion costs more than two deletions no cheapest script inserts: deleting
the partner of an inserted turn (and the leading system turn, if it stood alone
with that pair) is cheaper.  So with the default costs the layers of inserted turns
are empty; for cheaper insertions they are walked, with integers as wide as the
longest possible audit.

Rows are hash-partitioned by conversation and sorted, never collected: a
conversation of any length passes through its task in bounded memory (its
SHA-256 is a sequential function of all its text, so one task has to read it).

Odd rows: NULL role and text count as one blank; an empty role has no initial, so
its row cannot be kept as it is; a NULL id is a conversation of its own; NULL turns come first; rows of one turn are ordered by role and text;
repeated rows are duplicates.  A conversation without rows has zeros, an empty
audit and the empty string's hash.  Extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTER = {v: k for k, v in DIGIT.items()}
BASE = 5
#: Letters between two replacements of the low digits by their rank.
BLOCK = 256
#: What stands last: nothing, a leading system turn, a user turn, an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (NOTHING, ASSISTANT)
#: The rank of a node's earlier letters among the four live nodes.
RANKS = 4


class Costs(NamedTuple):
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def inserts(self, rows: int) -> int:
        """Most insertions in a cheapest script (deleting every row always works)."""
        return 0 if self.insert > 2 * self.delete else rows * self.delete // max(self.insert, 1)


def turn_after(last: int) -> int:
    """A user or an assistant turn, whichever can stand behind ``last``."""
    return ASSISTANT if last == USER else USER


@functools.lru_cache(maxsize=2)
def _digits(width: int) -> tuple[int, list[int]]:
    """BASE ** width, and the value of a digit at each place."""
    return BASE ** width, [BASE ** (width - 1 - p) for p in range(width)]


class Repair:
    """The walk over one conversation: ``row`` for each row, then ``result``."""

    def __init__(self, costs: Costs, rows: int | None = None):
        self.costs = costs
        self.layers = costs.inserts(rows) if rows else 0
        self.width = rows + self.layers if self.layers else BLOCK
        self.unit, self.place = _digits(self.width)
        self.at = 0                                # row letters since the last fold
        # (insertions, what stands last) -> weight, letters before the fold, hash, is it empty
        self.live = {(0, NOTHING): (0, None, hashlib.sha256(), True)}
        self._insert()

    def _weight(self, cost: int, letter: str, place: int) -> int:
        return cost * RANKS * self.unit + DIGIT[letter] * self.place[place]

    def _insert(self) -> None:
        """Insertions before the next row, layer by layer."""
        for k in range(self.layers):
            for last in range(4):
                if (k, last) in self.live:
                    w, before, h, empty = self.live[k, last]
                    new = turn_after(last)
                    w += self._weight(self.costs.insert, "I", self.at + k)
                    if (k + 1, new) not in self.live or w < self.live[k + 1, new][0]:
                        role = b"user:" if new == USER else b"assistant:"
                        self.live[k + 1, new] = (w, before, _joined(h, empty, role), False)

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        if self.at == self.width and not self.layers:
            self._fold()
        c, best = self.costs, {}
        extra = c.truncated if truncated else 0
        initial = role[:1]
        for (k, last), (w, *_) in self.live.items():
            edits = [(last, c.delete, "D")]
            if not must_go:
                new = turn_after(last)
                edits.append((new, c.rerole + extra, "R"))
                if initial == "ua"[new - USER]:
                    edits.append((new, extra, "K"))
                elif initial == "s" and last == NOTHING:
                    edits.append((SYSTEM, extra, "K"))
            for new, cost, letter in edits:
                got = w + self._weight(cost, letter, self.at + k)
                if (k, new) not in best or got < best[k, new][0]:
                    best[k, new] = (got, (k, last), letter)
        live = {}
        for (k, new), (w, source, letter) in best.items():
            _, before, h, empty = self.live[source]
            if letter != "D":
                name = role if letter == "K" else ("user" if new == USER else "assistant")
                h, empty = _joined(h, empty, f"{name}:{text}".encode()), False
            live[k, new] = (w, before, h, empty)
        self.live = live
        self.at += 1
        self._insert()

    def _fold(self) -> None:
        """Low digits and earlier rank become one new rank; letters go to the list."""
        span = RANKS * self.unit
        order = sorted({w % span for w, *_ in self.live.values()})
        rank = {x: i for i, x in enumerate(order)}
        self.live = {node: ((w // span * RANKS + rank[w % span]) * self.unit, (before, self._letters(w)), h, empty)
                     for node, (w, before, h, empty) in self.live.items()}
        self.at = 0

    def _letters(self, w: int) -> str:
        out, low = [], w % self.unit
        for place in self.place:
            digit, low = divmod(low, place)
            if not digit:
                break
            out.append(LETTER[digit])
        return "".join(out)

    def result(self) -> tuple[int, str, str]:
        """(cost, audit, SHA-256 of the repaired turns)"""
        w, before, h, _ = min((v for (_, last), v in self.live.items() if last in ACCEPTING),
                              key=lambda v: v[0])
        parts = [self._letters(w)]
        while before is not None:
            before, letters = before
            parts.append(letters)
        return w // (RANKS * self.unit), "".join(reversed(parts)), h.hexdigest()


def _joined(h, empty: bool, line: bytes):
    h = h.copy()
    if not empty:
        h.update(b"\n")
    h.update(line)
    return h


def roles_of(audit: str) -> str:
    """The initial that each letter leaves, ``-`` for a deleted row: kept letters
    alternate u, a; an odd number of them begins with s."""
    kept = len(audit) - audit.count("D")
    out, at = [], -(kept % 2)
    for letter in audit:
        if letter == "D":
            out.append("-")
        else:
            out.append("s" if at < 0 else "ua"[at % 2])
            at += 1
    return "".join(out)


# --- streams of sorted rows -----------------------------------------------------

VERDICT = pa.schema([
    ("conv_id", pa.int64()), ("n_rows", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()),
    ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()),
    ("audit", pa.string()), ("roles", pa.string()), ("repaired_sha256", pa.string())])
VERDICT_DDL = ("conv_id long, n_rows long, gaps long, blank long, duplicate long, truncated long, illegal long, "
               "cost long, audit string, roles string, repaired_sha256 string")
LEGAL = ("su", "ua", "au")


class _Conversation:
    def __init__(self, conv_id: int | None, costs: Costs, rows: int | None):
        self.conv_id, self.repair = conv_id, Repair(costs, rows)
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = None
        self.turns, self.initial = 0, None

    def row(self, turn: int | None, role: str, text: str, again: bool) -> None:
        self.rows += 1
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        said = text.rstrip(SPACE)
        blank, dup = not said, bool(said) and again
        cut = bool(said) and not again and said[-1] not in ".!?"
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + dup, self.truncated + cut
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        self.repair.row(role, text, blank or dup, cut)

    def verdict(self) -> tuple:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, 2**63 - 1)
        cost, audit, digest = self.repair.result()
        return (self.conv_id, self.rows, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost,
                audit, roles_of(audit), digest)


def _verdicts(costs: Costs):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []
        for b in batches:
            ids, turns, again, there, rows = (b.column(c).to_pylist()
                                              for c in ("conv_id", "turn", "again", "there", "n"))
            for i, (role, text) in enumerate(zip(b.column("role"), b.column("text"))):
                if now is None or now.conv_id != ids[i]:
                    if now is not None:
                        out.append(now.verdict())
                    now = _Conversation(ids[i], costs, rows[i])
                if there[i]:
                    now.row(turns[i], role.as_py(), text.as_py(), again[i])
            if len(out) >= 1000:
                yield _batch(out)
                out = []
        if now is not None:
            out.append(now.verdict())
        if out:
            yield _batch(out)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), VERDICT)], schema=VERDICT)




def _rows(conversations: DataFrame, there: Column | None) -> DataFrame:
    there = F.lit(True) if there is None else F.coalesce(there, F.lit(False))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
        there.alias("there"))


def repair(conversations: DataFrame, *, there: Column | None = None, costs: Costs = Costs()) -> DataFrame:
    """One row for each conv_id: n_rows, gaps (turns missing between the first and
    the last, at most 2**63 - 1), blank, duplicate, truncated (rows by their first
    fault), illegal (adjacent roles), cost, audit (edit letters in order), roles (the
    initial each letter leaves), repaired_sha256 (``role:text`` lines).  Rows for
    which ``there`` is not true only name their conversation.  One shuffle by
    conversation, two sorts of its partitions."""
    rows = _rows(conversations, there).repartition("conv_id")
    # equal rows stand together in the first order: all but the first are repeats
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    by_same = Window.partitionBy("conv_id").orderBy(F.col("there").desc(), "same", F.col("turn").asc_nulls_first())
    rows = rows.withColumn("same", same).withColumn(
        "again", F.col("there") & F.coalesce(F.lag("same").over(by_same) == F.col("same"), F.lit(False)))
    n = F.lit(0)                                   # the length matters only if insertions can pay
    if costs.inserts(2**40):
        n = F.sum(F.col("there").cast("int")).over(Window.partitionBy("conv_id"))
    rows = rows.drop("same").withColumn("n", n.cast("long"))
    rows = rows.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "again")
    return rows.mapInArrow(_verdicts(costs), VERDICT_DDL)


def repaired(conversations: DataFrame, verdicts: DataFrame, *, there: Column | None = None) -> DataFrame:
    """The turns of the repaired conversations: conv_id, position (from 0), turn
    (NULL if inserted), role, text.  ``verdicts`` is ``repair`` of the same rows."""
    def steps(batches):
        for b in batches:
            for conv, audit, roles in zip(*(b.column(c).to_pylist() for c in ("conv_id", "audit", "roles"))):
                source, position, out = 0, 0, []
                for letter, role in zip(audit, roles):
                    if letter != "D":
                        out.append((conv, None if letter == "I" else source, position, letter, role))
                        position += 1
                    source += letter != "I"
                    if len(out) == 10_000:
                        yield _plan(out)
                        out = []
                if out:
                    yield _plan(out)

    def _plan(out):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                          names=["c", "source", "position", "letter", "initial"])

    plan = verdicts.select("conv_id", "audit", "roles").mapInArrow(
        steps, "c long, source long, position long, letter string, initial string")
    in_turn = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = (_rows(conversations, there).filter("there")
            .withColumn("k", F.row_number().over(in_turn).cast("long") - 1))
    got = plan.join(rows, F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("source") == F.col("k")), "left")
    new = F.when(F.col("initial") == "u", F.lit("user")).otherwise(F.lit("assistant"))
    return got.select(F.col("c").alias("conv_id"), "position", "turn",
                      F.when(F.col("letter") == "K", F.col("role")).otherwise(new).alias("role"),
                      F.coalesce("text", F.lit("")).alias("text"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults drawn by crc32 of ``conv_id:turn`` modulo 20 (NULLs are
    one blank): 0 drops a row (``there`` is false), 1 empties its text, 2 takes its
    sentence marks, 3 repeats it, 4 makes its role user."""
    def blank(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = (F.when(F.col("code") == 1, F.lit("")).when(F.col("code") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    copies = F.array_repeat(F.lit(0), F.when(F.col("code") == 3, 2).otherwise(1))
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"),
                                code.alias("code"))
    return (rows.select("conv_id", "turn",
                        F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                        text.alias("text"), (F.col("code") != 0).alias("there"),
                        F.explode(copies).alias("copy")).drop("copy"))
