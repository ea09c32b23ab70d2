"""Licence scan against plain versions."""

import random

import pytest
from brute import alnum
from pricelens.llm import license_scan as ls
from pricelens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LONGEST = max(p.count(" ") + 1 for p in {**ls.BASE, **ls.NOTICES, **ls.TAGS})


def plain_places(words, phrases):
    out = []
    for phrase in phrases:
        p = phrase.split()
        out += [(i, len(p), phrase) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    return sorted(out)


def base_columns(text):
    words = alnum(text)
    found = plain_places(words, ls.BASE)
    labels = ",".join(sorted({ls.BASE[p] for _, _, p in found}))
    return (len(words), len(found), found[0][0] if found else None, found[-1][0] if found else None, labels)


def test_query_matches_plain_version(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op11_license_scan"](spark, SF).collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        r = got[doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_columns(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1


@pytest.mark.parametrize("piece", [1, 7, 40, 1 << 20])
def test_places_in_pieces(monkeypatch, piece):
    monkeypatch.setattr(ls, "PIECE", piece)
    rng, a = random.Random(piece), ls.automaton()
    phrases = {**ls.BASE, **ls.NOTICES, **ls.TAGS}
    parts = [w for p in phrases for w in p.split()] + list(phrases) + ["Ünder", "x", "\x00", "mit\nlicense"]
    for _ in range(200):
        text = "".join(rng.choice(parts) + rng.choice([" ", "-", ". ", " ", "\n", ""])
                       for _ in range(rng.randint(0, 40)))
        n, found = ls.places(text.encode().lower(), a, LONGEST)
        words = alnum(text)
        assert n == len(words)
        assert sorted(map(tuple, found)) == plain_places(words, phrases)


def plain_value(tokens):
    """Evaluation by recursive descent over a well-formed expression."""
    def either(i):
        v, i = both(i)
        while i < len(tokens) and tokens[i] == "or":
            w, i = both(i + 1)
            v = (max(v[0], w[0]), v[1] | w[1])
        return v, i

    def both(i):
        v, i = one(i)
        while i < len(tokens) and tokens[i] == "and":
            w, i = one(i + 1)
            v = (min(v[0], w[0]), v[1] | w[1])
        return v, i

    def one(i):
        if tokens[i] == "(":
            v, i = either(i + 1)
            return v, i + 1
        name = ls.family(tokens[i])
        v, i = (ls.FAMILIES[name], {name}), i + 1
        while i < len(tokens) and tokens[i] == "with":
            v = (max(v[0], ls.WEAK) if tokens[i + 1].startswith(ls.LINKING) else v[0], v[1])
            i += 2
        return v, i
    return either(0)[0]


def test_expressions():
    rng = random.Random(2)

    def make(depth):
        if depth == 0 or rng.random() < 0.3:
            name = rng.choice(["mit", "apache-2.0", "gpl-3.0-only", "agpl-3.0+", "lgpl-2.1", "cc-by-nc-4.0", "x-1"])
            return [name] + rng.choice([[], [], ["with", "classpath-exception-2.0"], ["with", "odd-exception"]])
        inner = make(depth - 1) + [rng.choice(["and", "or"])] + make(depth - 1)
        return ["(", *inner, ")"] if rng.random() < 0.6 else inner
    for _ in range(500):
        tokens = make(4)
        v = ls.evaluate(ls.postfix(tokens))
        assert (v.allows, set(v.labels)) == plain_value(tokens)
        again = v.text.replace("(", "( ").replace(")", " )").split()
        assert ls.evaluate(ls.postfix(again)) == v


@pytest.mark.parametrize("tokens, text", [
    ([], None), (["("], None), (["or"], None), (["(", ")"], None), (["mit", "or"], "mit"),
    (["mit", "or", "(", "gpl"], "mit or gpl"), (["mit", ")", "and", "isc"], "mit and isc"),
    (["(", "mit", "or", ")", "and", "isc"], "mit and isc"), (["and", "mit", "with"], "mit"),
    (["mit", "or", "(", ")"], "mit"), (["mit", "isc"], "mit")])
def test_broken_expressions(tokens, text):
    v = ls.evaluate(ls.postfix(tokens))
    assert (v and v.text) == text


@pytest.mark.parametrize("text, labels, score, expressions", [
    ("// SPDX-License-Identifier: MIT OR GPL-2.0-only", ["gpl", "mit"], 1.0, ["mit or gpl-2.0-only"]),
    ("# SPDX-License-Identifier: (MIT AND GPL-3.0-or-later)\ncode", ["gpl", "mit"], 0.4, ["mit and gpl-3.0-or-later"]),
    ("SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0 */", ["gpl"], 0.7,
     ["gpl-2.0 with classpath-exception-2.0"]),
    ("SPDX-License-Identifier: LicenseRef-Acme", ["other"], 0.0, ["licenseref-acme"]),
    ('{"license": "Apache-2.0", "x": 1}', ["apache"], 1.0, ["apache-2.0"]),
    ("The license: see the file.", [], 0.0, []),
    ("under the MIT License or the Apache License, Version 2.0", ["apache", "mit"], 1.0, ["mit or apache"]),
    ("MIT License. Other parts: GNU General Public License", ["gpl", "mit"], 0.4, ["gpl", "mit"]),
    ("GNU Lesser General Public License", ["gpl", "lgpl"], 0.7, ["lgpl"]),
    ("CC BY-NC-SA 4.0", ["cc-by-nc-sa"], 0.2, ["cc-by-nc-sa"]),
    ("", [], 0.0, []), (None, [], 0.0, []), ("no words of that kind", [], 0.0, [])])
def test_labels_and_scores(text, labels, score, expressions):
    got = ls.scan(text, ls.automaton(), LONGEST)
    assert (got["labels"], got["score"], got["expressions"]) == (labels, score, expressions)


def test_odd_tables(spark, make):
    long = "word " * 300_000 + "mit license " + "x" * 1_500_000 + " apache license"
    rows = [(1, "MIT license"), (1, "MIT license"), (None, "the apache license, apache license"), (2, None), (3, ""),
            (4, long)]
    docs = make(rows).selectExpr("*", "1 AS labels", "2 AS score", "3 AS `s.n`")
    got = sorted(((r.doc_id, r.n_words, len(r.places), r.base_labels) for r in ls.license_scan(docs).collect()), key=repr)
    want = sorted(((i, b[0], b[1], b[4].split(",") if b[4] else []) for i, t in rows for b in [base_columns(t)]), key=repr)
    assert got == want
    assert ls.license_scan(docs.limit(0)).count() == 0
