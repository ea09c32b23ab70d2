"""N-gram Jaccard join, substring dedup and decontamination against plain versions."""

import random

import pytest

from brute import components, contamination, removed, spaced
from pricelens.llm import components as graph
from pricelens.llm import decontaminate, ngram_join, substring_dedup

VOCAB = [f"w{i}" for i in range(400)] + ["the", "of", "and", "É", "straße"]


def words(rng, n):
    return [rng.choice(VOCAB) for _ in range(n)]


def corpus(seed=1):
    """Near copies in chains and stars, exact copies, shared passages, hot lines,
    short texts, upper case, empty and NULL texts, a repeated and a NULL id."""
    rng = random.Random(seed)
    base = [words(rng, rng.randint(20, 120)) for _ in range(12)]
    passage, line = words(rng, 60), words(rng, 14)
    rows, i = [], 100
    for b in base:
        rows.append((i, " ".join(b)))
        i -= 1
        chain = list(b)
        for _ in range(6):                       # each a few words from the last
            for _ in range(rng.randint(0, 3)):
                chain[rng.randrange(len(chain))] = rng.choice(VOCAB)
            rows.append((i, "  ".join(chain).upper() if rng.random() < 0.2 else "\n".join(chain)))
            i -= 1
    for _ in range(8):
        own = words(rng, 40)
        rows.append((200 + i, " ".join(own[:20] + passage + own[20:] + line)))
        i += 1
    for _ in range(9):
        rows.append((400 + i, " ".join(line)))   # exact copies of a hot line
        i += 1
    rows += [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two three"),
             (7, "one two three four"), (8, "é " * 50), (9, "x" * 100_000), (10, "x" * 100_000 + " y"),
             (rows[0][0], rows[5][1]), (rows[1][0], rows[1][1]), (None, rows[2][1]), (None, "alone is a row")]
    rng.shuffle(rows)
    return rows


def by_row(got, rows, key=lambda r: r.doc_id):
    """Results in a comparable order: rows that repeat an id by their content."""
    return sorted(got, key=repr), sorted(rows, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components(make, seed):
    rows = corpus(seed)
    comp, sets = components(rows)
    got = [(r.doc_id, r.n_shingles, r.component_id)
           for r in ngram_join.near_duplicate_groups(make(rows)).collect()]
    want = [(i, len(s), c) for (i, _), s, c in zip(rows, sets, comp)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_large_group_of_edited_copies(make):
    """Hundreds of copies with one to six edits: links to the original only,
    links among copies, and none; no pair is lost."""
    rng = random.Random(5)
    base = words(rng, 150)
    rows = [(0, " ".join(base))]
    for i in range(1, 250):
        own = list(base)
        for _ in range(rng.randint(1, 6)):
            own[rng.randrange(len(own))] = f"e{i}"
        rows.append((i, " ".join(own)))
    comp, _ = components(rows)
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicate_groups(make(rows)).collect()}
    assert got == {i: c for (i, _), c in zip(rows, comp)}
    assert len(set(comp)) > 1


def test_chain_without_a_centre(make):
    """a-b, b-c, c-d link, a-c does not: one component."""
    base = [f"t{i}" for i in range(120)]
    rows = []
    for k in range(8):
        own = list(base)
        for j in range(k):
            own[10 * j + 5] = f"x{j}"
        rows.append((50 - k, " ".join(own)))
    comp, _ = components(rows)
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicate_groups(make(rows)).collect()}
    assert got == {i: c for (i, _), c in zip(rows, comp)} and set(comp) == {43}


def test_one_per_group_keeps_columns(make, spark):
    rows = corpus(1)
    comp, _ = components(rows)
    docs = make(rows)
    kept = ngram_join.one_per_group(docs)
    assert kept.columns == docs.columns
    gone = {i for (i, _), c in zip(rows, comp) if i is not None and c != i}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(i) for i, _ in rows if i not in gone)
    # columns named like the operator's own
    odd = docs.withColumnsRenamed({"lang": "ent", "source": "gone_id", "n_chars": "component_id"})
    assert ngram_join.one_per_group(odd).count() == kept.count()


def test_one_row_per_group(make):
    """Rows with NULL and repeated ids: one row of each component stays."""
    copy, other, alone = (" ".join(f"{p}{k}" for k in range(60)) for p in "abc")
    rows = [(1, copy), (1, copy), (2, copy.upper()), (None, copy), (None, copy), (2, alone),
            (None, other), (None, other), (None, other + " z"), (5, None), (None, None), (5, ""), (None, "")]
    docs = make(rows).withColumnsRenamed({"lang": "md5", "source": "row_id", "n_chars": "stays"})
    kept = ngram_join.one_row_per_group(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    rest = [r for r in got if r[1] not in (other, other + " z")]
    assert rest == sorted([(1, copy), (2, alone), (5, None), (None, None), (5, ""), (None, "")], key=repr)
    assert len(got) == len(rest) + 1


def test_rows_are_decontaminated_alone(make, spark):
    """A clean row stays beside a contaminated one of its id or of no id."""
    item = " ".join(f"q{k}" for k in range(20))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    clean = " ".join(f"c{k}" for k in range(100))
    rows = [(None, item), (None, clean), (None, clean + " more"), (7, item + " x"), (7, clean), (8, item), (8, item),
            (9, None), (None, None)]
    kept = decontaminate.remove_contaminated(make(rows), bench).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted(
        [(None, clean), (None, clean + " more"), (7, clean), (9, None), (None, None)], key=repr)
    got = decontaminate.contamination(make(rows), bench)
    assert {r.text_len: r.n_hit for r in got.filter("doc_id IS NULL").selectExpr("n_words AS text_len", "n_hit").collect()} == {
        20: 20, 100: 0, 101: 0, 0: 0}
    own = decontaminate.contamination(make(rows), bench).filter("doc_id = 7").collect()
    assert sorted((r.n_words, r.n_hit) for r in own) == [(21, 20), (100, 0)]


def test_components_of_graphs(spark):
    rng = random.Random(3)
    for n, m in ((30, 20), (200, 150)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        parent = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        for a, b in edges:
            if a != b:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
        got = graph.components(spark.createDataFrame(edges, "a long, b long"))
        assert {r.node: r.comp for r in got.collect()} == {x: find(x) for x in parent}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_words(make, seed):
    rows = corpus(seed)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in
           substring_dedup.repeated_words(make(rows)).collect()]
    want = []
    for (i, _), (w, mask) in zip(rows, removed(rows)):
        want.append((i, len(w), sum(mask), " ".join(x for x, m in zip(w, mask) if not m)))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_levels_double_until_no_candidate_survives(make):
    assert substring_dedup.levels_to(13) == [7, 13] and substring_dedup.levels_to(40) == [5, 10, 20, 40]
    rng = random.Random(7)
    passage = words(rng, 110)
    rows = [(1, " ".join(words(rng, 30) + passage)), (2, " ".join(passage[:60] + words(rng, 30))),
            (3, " ".join(words(rng, 40) + passage + words(rng, 5))), (4, " ".join(words(rng, 12)))]
    got = {r.doc_id: r for r in substring_dedup.repeated_words(make(rows), max_words=None).collect()}
    assert {i: r.longest for i, r in got.items()} == {1: 0, 2: 52, 3: 104, 4: 0}
    assert [(s.start, s.end) for s in got[3].spans] == [(40, 150)] and got[2].n_removed == 60


def test_remove_repeats_leaves_other_rows_alone(make, spark):
    rows = corpus(2)
    docs = make(rows).withColumnsRenamed({"lang": "row", "source": "batch"})
    out = substring_dedup.remove_repeats(docs)
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    want = []
    for (i, t), (w, mask) in zip(rows, removed(rows)):
        text = " ".join(x for x, m in zip(w, mask) if not m) if any(mask) else t
        want.append((i, text, None if text is None else len(text)))
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in out.collect()), key=repr) == sorted(want, key=repr)


def benchmark():
    rng = random.Random(11)
    items = [(k, " ".join(words(rng, rng.randint(13, 40)))) for k in range(6)]
    return items + [(20, "two words"), (21, "Two, words!"), (22, None), (23, ""), (24, "..."),
                    (None, "no id here"), (3, items[3][1])]


def contaminated_corpus():
    rng = random.Random(12)
    items, rows = benchmark(), []
    for i in range(40):
        own = words(rng, rng.randint(5, 200))
        if i % 3 == 0:
            w = items[i % 6][1].split()
            lo = rng.randrange(0, max(1, len(w) - 13))
            own[len(own) // 2:len(own) // 2] = w[lo:lo + rng.randint(10, 30)]
        if i % 5 == 0:
            own += ["TWO", "words;", "two", "words"]
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(own)))
    return rows + [(90, None), (91, ""), (92, "?!"), (93, "two words"), (94, "two"), (None, "two words"),
                   (95, "x " * 5000 + items[0][1])]


def test_contamination(make, spark):
    rows, items = contaminated_corpus(), benchmark()
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = [(i, *c) for (i, _), c in zip(rows, contamination(rows, items))]
    for kw in ({}, {"slice_rows": 20}):           # one slice, several slices
        got = [(r.doc_id, r.n_words, r.n_hit, sorted(r["items"]), r.contaminated)
               for r in decontaminate.contamination(make(rows), bench, **kw).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    docs = make(rows).withColumnsRenamed({"lang": "items", "source": "bad_id"})
    kept = decontaminate.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(w[0]) for w in want if not w[4])


def test_empty_tables(make, spark):
    none = make([])
    assert ngram_join.near_duplicate_groups(none).count() == 0
    assert substring_dedup.repeated_words(none).count() == 0
    assert substring_dedup.remove_repeats(none).columns == none.columns
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(none, bench).count() == 0
    docs = make([(1, "a b c"), (2, None)])
    got = decontaminate.contamination(docs, bench).collect()
    assert {(r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in got} == {(1, 3, 0, False), (2, 0, 0, False)}
    assert ngram_join.near_duplicate_groups(make([(1, None), (2, "")])).count() == 2


def test_plain_words_agree_with_the_vectorised(make):
    import numpy as np
    import pyarrow as pa
    from pricelens.llm.textvec import find_words, joined_words
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab É\t\n\x0b\x1c　ß ") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += [None, "", "x" * (3 << 20), "y " * 1000]
    w = find_words(pa.array(texts, pa.string()))
    got = [[bytes(w.data[s:e]).decode() for s, e in zip(w.start[a:b], w.end[a:b])]
           for a, b in zip(w.first[:-1], w.first[1:])]
    assert got == [spaced(t) for t in texts]
    data, off = joined_words(w, np.ones(len(w.start), bool))
    assert [bytes(data[a:b]).decode() for a, b in zip(off[:-1], off[1:])] == [" ".join(spaced(t)) for t in texts]
