"""Conversation repair and prefix trie against plain versions."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pricelens.llm import conversation_repair as cr
from pricelens.llm import conversation_trie as ct
from pricelens.llm.queries import QUERIES
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string"
SF = "/root/testdata/sf0.001"
EMPTY = hashlib.sha256(b"").hexdigest()


# --- repair -----------------------------------------------------------------------

def plain_scripts(rows, costs, most_inserts):
    """(cost, audit, lines) of every script for rows (role, text, must_go, truncated)."""
    out = []

    def go(i, cost, audit, lines, inserts):
        if i == len(rows):
            if re.fullmatch("(s?(ua)+)?", "".join(x[:1] or "?" for x, _ in lines)):
                out.append((cost, audit, lines))
        if inserts < most_inserts:
            for role in ("user", "assistant"):
                go(i, cost + costs.insert, audit + "I", lines + [(role, "")], inserts + 1)
        if i == len(rows):
            return
        role, text, must_go, truncated = rows[i]
        go(i + 1, cost + costs.delete, audit + "D", lines, inserts)
        if not must_go:
            extra = costs.truncated if truncated else 0
            go(i + 1, cost + extra, audit + "K", lines + [(role, text)], inserts)
            for new in ("user", "assistant"):
                go(i + 1, cost + costs.rerole + extra, audit + "R", lines + [(new, text)], inserts)

    go(0, 0, "", [], 0)
    cost, audit, lines = min(out, key=lambda x: (x[0], x[1]))
    text = "\n".join(f"{r}:{t}" for r, t in lines)
    return cost, audit, hashlib.sha256(text.encode()).hexdigest()


def walked(rows, costs):
    r = cr.Repair(costs, len(rows))
    for x in rows:
        r.row(*x)
    return r.result()


@pytest.mark.parametrize("costs", [cr.Costs(), cr.Costs(insert=1), cr.Costs(rerole=2, delete=3, insert=2, truncated=1)])
def test_every_short_conversation(costs):
    kinds = [("system", "a", False, False), ("user", "b", False, False), ("assistant", "c", False, True),
             ("tool", "d", False, False), ("user", "e", True, False)]
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            most = costs.inserts(n) if costs.insert < 5 else 2
            assert walked(rows, costs) == plain_scripts(rows, costs, min(most, 3)), rows


def test_no_cheapest_script_inserts():
    """The layers of inserted turns change nothing at the default costs."""
    class All(cr.Costs):
        def inserts(self, rows):
            return rows * self.delete // self.insert
    kinds = [("system", "a", False, False), ("user", "b", False, False), ("assistant", "c", False, False),
             ("assistant", "c", False, True), ("user", "e", True, False)]
    rng = random.Random(5)
    for _ in range(300):
        rows = [rng.choice(kinds) for _ in range(rng.randint(1, 9))]
        assert walked(rows, cr.Costs()) == walked(rows, All())


def least_pair(rows, costs):
    """Pairs (cost, audit) compared as such, without digits: for long conversations."""
    live = {0: (0, "")}
    for role, _, must_go, truncated in rows:
        new = {}
        for q, (c, a) in live.items():
            steps = [(q, costs.delete, "D")]
            if not must_go:
                extra, to = costs.truncated * truncated, 3 if q == 2 else 2
                steps.append((to, costs.rerole + extra, "R"))
                if role[:1] == "ua"[to - 2]:
                    steps.append((to, extra, "K"))
                if role[:1] == "s" and q == 0:
                    steps.append((1, extra, "K"))
            for to, more, letter in steps:
                new[to] = min(new.get(to, (c + more, a + letter)), (c + more, a + letter))
        live = new
    return min(v for q, v in live.items() if q in (0, 3))


def test_long_conversations_fold():
    rng = random.Random(3)
    for n in (cr.BLOCK - 1, cr.BLOCK, cr.BLOCK + 1, 5 * cr.BLOCK + 7):
        for bias in (0.1, 0.5, 0.9):
            rows, last = [], "assistant"
            for i in range(n):
                last = rng.choice(["user", "assistant", "system"]) if rng.random() < bias else \
                    {"user": "assistant"}.get(last, "user")
                rows.append((last, str(i), rng.random() < 0.1, rng.random() < 0.2))
            cost, audit, digest = walked(rows, cr.Costs())
            assert (cost, audit) == least_pair(rows, cr.Costs())
            kept = [(r, t) for r, t in zip(cr.roles_of(audit), (x[1] for x in rows)) if r != "-"]
            assert re.fullmatch("(s?(ua)+)?", "".join(r for r, _ in kept))
            names = {"s": "system", "u": "user", "a": "assistant"}
            assert digest == hashlib.sha256("\n".join(f"{names[r]}:{t}" for r, t in kept).encode()).hexdigest()


def plain_repairs(rows):
    """The query's columns for rows (conv_id, turn, role, text)."""
    def blank(x):
        return " " if x is None else str(x)
    convs = {}
    for conv, turn, role, text in rows:
        mine = convs.setdefault(conv, [])
        code = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        mine += [(turn, role, text)] * (2 if code == 3 else 1)
    out = {}
    for conv, mine in convs.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, _, _ in mine if t is not None]
        seen, faults, todo = set(), [], []
        for _, role, text in mine:
            said = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = ("blank" if not said else "duplicate" if (role, text) in seen
                     else "truncated" if said[-1] not in ".!?" else "")
            seen.add((role, text))
            faults.append(fault)
            todo.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        best = plain_scripts(todo, cr.Costs(), 0) if mine else (0, "", EMPTY)
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, *best)
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_query_matches_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_conversation_repair"](spark, SF).collect()}
    assert got == plain_repairs(rows)


def odd_rows():
    rng = random.Random(11)
    rows = []
    for conv in [None, *range(-3, 60)]:
        for _ in range(rng.randint(1, 6)):
            rows.append((conv, rng.choice([None, 0, 1, 2, 5, 5]),
                         rng.choice([None, "", "system", "user", "user", "assistant", "assistant", "User", "tool"]),
                         rng.choice([None, "", " \n", "Same.", "Same.", "Ü no mark", "Yes! \t", "what?", "é" * 3000 + "."])))
    return rows


def test_odd_rows(spark):
    rows = odd_rows()
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", again long, `a.b` long")
    damaged = cr.damaged(table.select("*", F.lit(0).alias("there"), F.lit("x").alias("same")))
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in cr.repair(damaged, there=F.col("there")).collect()}
    assert got == plain_repairs(rows)
    none = table.limit(0)
    assert cr.repair(none).count() == 0 and cr.repair(cr.damaged(none), there=F.col("there")).count() == 0


def test_cheap_insertions_in_a_table(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Yes."), (2, 0, "assistant", "No."),
            (3, None, None, None)]
    costs = cr.Costs(rerole=3, delete=3, insert=1)
    got = {r.conv_id: (r.cost, r.audit, r.roles) for r in
           cr.repair(spark.createDataFrame(rows, SCHEMA), costs=costs).collect()}
    assert got == {1: (1, "KIKK", "uaua"), 2: (1, "IK", "ua"), 3: (3, "D", "-")}


def test_repaired_rows_have_the_hash(spark):
    table = spark.createDataFrame(odd_rows(), SCHEMA)
    for costs in (cr.Costs(), cr.Costs(insert=1)):
        verdicts = cr.repair(table, costs=costs)
        want = {r.conv_id: r.repaired_sha256 for r in verdicts.collect()}
        lines = {}
        for r in cr.repaired(table, verdicts).collect():
            lines.setdefault(r.conv_id, []).append((r.position, f"{r.role}:{r.text}"))
        for conv, digest in want.items():
            text = "\n".join(x for _, x in sorted(lines.get(conv, [])))
            assert hashlib.sha256(text.encode()).hexdigest() == digest


# --- trie -------------------------------------------------------------------------

def plain_trie(rows, group=100, heads=6):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    convs = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (c % group if c >= 0 else -(-c % group))
        convs[c] = tuple(own.get(base, [])[:h] + v[h:])
    members = {}
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members.setdefault(v[:d], []).append(c)
    own_sum = {p: (len(m) - 1) * len(p[-1][1]) if p else 0 for p, m in members.items()}
    children, saved, leaves = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p in members:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    for p in members:
        for d in range(len(p) + 1):
            saved[p[:d]] += own_sum[p]
            leaves[p[:d]] += p not in children
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if convs[c] == p)
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children.get(p, 0), leaves[p],
                    saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_trie_query_matches_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(QUERIES["op13_conversation_trie"](spark, SF)) == plain_trie(rows)


@pytest.mark.parametrize("size", [1, 2, 4])
def test_trie_of_odd_rows(spark, size):
    rng = random.Random(size)
    rows = [r for r in odd_rows() if r[0] is None or r[0] < 20]
    # copies, shared heads of every length, long chains whose smallest members alternate
    for c in range(100, 140):
        n = rng.randint(0, 9)
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", "ab"[rng.random() < 0.2] * 3) for t in range(n)]
    for k in range(12):
        rows += [(400 - k, t, "user", "deep" if t < 7 + k else f"end {k}") for t in range(8 + k)]
    table = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA + ", depth long")
    got = ct.trie(ct.rebuilt(ct.entries(ct.turns(table))), size=size)
    assert rows_of(got) == plain_trie(rows)


def test_trie_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert ct.trie(ct.rebuilt(ct.entries(ct.turns(none)))).count() == 0
    only_null = spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)
    assert ct.trie(ct.rebuilt(ct.entries(ct.turns(only_null)))).count() == 0


def test_single_path_blocks_are_not_refined(spark):
    """Twenty conversations that part after ten turns: the two blocks before that
    give their nodes as they stand."""
    rows = [(c, t, "user", "x" if t < 10 else f"{c}") for c in range(20) for t in range(12)]
    cut = ct.blocks(ct.entries(ct.turns(spark.createDataFrame(rows, SCHEMA))), size=4)
    distinct = cut.select("level", "before", "block").distinct()
    assert sorted(r["count"] for r in distinct.groupBy("level").count().collect()) == [1, 1, 20]
    got = ct.nodes(cut, size=4)
    assert got.count() == 10 + 40 and got.filter("n_convs = 20").count() == 10
