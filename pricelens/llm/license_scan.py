"""License scan: Aho-Corasick notices and tags, expressions by shunting-yard.

A text is cut into words of ASCII letters, digits and all non-ASCII characters
(A-Z lower-cased).  One Aho-Corasick automaton over the words finds the notice
phrases (``NOTICES``) and the words of identifier tags (``TAGS``).  Behind a tag
and its colon or equals sign the text up to the line's end is read as a licence
expression: identifiers, parentheses and and / or / with, put in postfix order by
a shunting-yard parser and evaluated.  Notices with only linking words and one
"and" or "or" between them ("the MIT License or the Apache License") are one
expression too.

Evaluation: each licence family has a number between 0 and 1 that says how freely
a text under it can be used (``FAMILIES``); "or" leaves the choice and takes the
larger, "and" binds both and takes the smaller, "with" one of ``LINKING`` raises
the left side to weak copyleft.  All notices and expressions of a text hold
together, so the text's score is the least; a text without any scores 0.

Odd rows: NULL and empty texts have no words; repeated rows stay; overlapping
places all count as places; an expression behind a plain ``license:`` counts only
if it names known families alone (prose follows such words), behind an SPDX tag
unknown identifiers give the label ``other``; a dangling operator or an unclosed
parenthesis is left out.  Long texts are scanned in pieces with the last words of
one carried into the next, so nothing is cut.  Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Notice phrases beyond the base ones.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "lesser general public license": "lgpl",
    "library general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "boost software license": "bsl",
    "zlib license": "zlib",
    "released into the public domain": "public-domain",
    "dedicated to the public domain": "public-domain",
    "creative commons zero": "cc0",
    "creative commons attribution": "cc-by",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc": "cc-by-nc",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "all rights reserved": "proprietary",
}

#: Words of identifier tags; True: whatever follows is an expression.
TAGS = {"spdx license identifier": True, "license expression": True,
        "license": False, "licence": False, "licenses": False}

#: How freely a text under a licence family can be used.
FAMILIES = {
    "public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0, "0bsd": 1.0, "mit": 1.0, "bsd": 1.0,
    "isc": 1.0, "zlib": 1.0, "bsl": 1.0, "psf": 1.0, "apache": 1.0, "cc-by": 0.9,
    "mpl": 0.7, "epl": 0.7, "cddl": 0.7, "lgpl": 0.7, "cc-by-sa": 0.6,
    "gpl": 0.4, "agpl": 0.3, "cc-by-nc": 0.2, "cc-by-nc-sa": 0.2, "cc-by-nd": 0.2,
    "cc-by-nc-nd": 0.1, "proprietary": 0.0, "other": 0.0,
}
WEAK = 0.7
LINKING = ("classpath-exception", "gcc-exception", "llvm-exception", "font-exception", "openssl-exception")
#: Words that may stand between two notices of one expression.
LINKS = {"the", "a", "an", "either", "under", "version", "and", "or", "1", "2", "3", "0"}
PIECE = 1 << 20

_SEPARATORS = bytes(c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122))
_TO_WORDS = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_BEHIND_TAG = re.compile(rb"[\"']?[ \t]*(?:::|[:=])[ \t]*[\"'\[]?")
_TOKEN = re.compile(rb"[ \t]*([()]|[a-z0-9][a-z0-9.+:-]*)")
RANK = {"or": 1, "and": 2, "with": 3}


class Place(NamedTuple):
    """A phrase's occurrence: words ``start`` to ``start + n - 1``."""
    start: int
    n: int
    phrase: str


# --- expressions --------------------------------------------------------------

def family(identifier: str) -> str:
    """The longest known family that the identifier is or begins with."""
    name = identifier.rstrip("+")
    while name and name not in FAMILIES:
        name = name.rpartition("-")[0]
    return name or "other"


def postfix(tokens: list[str]) -> list[str]:
    """Operands and operators in postfix order (``with`` binds closest, then
    ``and``, then ``or``).  Parentheses that do not pair and operators without
    operands are left out."""
    out, stack, operand_next = [], [], True
    for t in tokens:
        if t == "(":
            if operand_next:
                stack.append(t)
        elif t == ")":
            if operand_next and stack and stack[-1] in RANK:
                stack.pop()                       # "(mit or)": the operator has no right side
                operand_next = False
            if "(" in stack and not (operand_next and stack[-1] == "("):
                while stack[-1] != "(":
                    out.append(stack.pop())
                stack.pop()
                operand_next = False
            elif operand_next and stack and stack[-1] == "(":
                stack.pop()                       # "()"
        elif t in RANK:
            if operand_next:
                continue
            while stack and stack[-1] != "(" and RANK[stack[-1]] >= RANK[t]:
                out.append(stack.pop())
            stack.append(t)
            operand_next = True
        else:
            if not operand_next:
                break                             # two operands in a row: prose begins
            out.append(t)
            operand_next = False
    while operand_next and stack:
        if stack.pop() in RANK:
            break
    return out + [t for t in reversed(stack) if t != "("]


class Value(NamedTuple):
    text: str
    allows: float
    labels: frozenset
    rank: int


def evaluate(order: list[str]) -> Value | None:
    """The value of an expression in postfix order; None without operands."""
    stack: list[Value] = []
    for t in order:
        if t not in RANK:
            name = family(t)
            stack.append(Value(t, FAMILIES[name], frozenset([name]), 4))
            continue
        if len(stack) < 2:
            break
        b, a = stack.pop(), stack.pop()
        if t == "with":
            allows = max(a.allows, WEAK) if b.text.startswith(LINKING) else a.allows
            labels = a.labels
        else:
            allows, labels = (max if t == "or" else min)(a.allows, b.allows), a.labels | b.labels
        sides = [f"({x.text})" if x.rank < RANK[t] else x.text for x in (a, b)]
        stack.append(Value(f" {t} ".join(sides), allows, labels, RANK[t]))
    return stack[0] if stack else None


def expression_at(raw: bytes, at: int) -> list[str]:
    """Tokens of the expression that begins at ``at``, up to the line's end."""
    out, last = [], ""
    while m := _TOKEN.match(raw, at):
        t, at = m[1].decode().rstrip(".:"), m.end()
        operand = t not in RANK and t not in "()"
        if operand and last not in ("", "(", *RANK):
            break
        out.append(t)
        last = t
    return out


# --- places -------------------------------------------------------------------

def automaton():
    """All phrases and tags, each between blanks, over words joined by blanks."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for phrase in {**BASE, **NOTICES, **TAGS}:
        a.add_word(f" {phrase} ", (phrase, phrase.count(" ") + 1))
    a.make_automaton()
    return a


def places(low: bytes, a, longest: int) -> tuple[int, list[Place]]:
    """Number of words of a lower-cased text, and every place of every phrase by
    its end; scanned in pieces that share ``longest - 1`` words."""
    norm, found, n_words, carried, at = low.translate(_TO_WORDS), [], 0, [], 0
    while at < len(norm):
        to = norm.find(b" ", at + PIECE)
        to = len(norm) if to < 0 else to
        words = carried + norm[at:to].split()
        hay = f" {b' '.join(words).decode('latin-1')} "
        first, blanks, seen = n_words - len(carried), 0, 0
        for end, (phrase, n) in a.iter(hay):
            blanks += hay.count(" ", seen, end + 1)
            seen = end + 1
            if blanks - 1 > len(carried):         # ends behind the words of the piece before
                found.append(Place(first + blanks - 1 - n, n, phrase))
        n_words, carried, at = first + len(words), words[-(longest - 1):], to
    return n_words, found


def _tagged(low: bytes, tags: list[Place]) -> Iterator[tuple[Place, list[str]]]:
    """Each tag with the expression behind it."""
    ends = {}
    for p in tags:
        ends.setdefault(p.start + p.n - 1, []).append(p)
    for k, m in enumerate(_WORD.finditer(low)):
        for p in ends.pop(k, ()):
            if sign := _BEHIND_TAG.match(low, m.end()):
                tokens = expression_at(low, sign.end())
                if tokens:
                    yield p, tokens
        if not ends:
            return


def _linked(low: bytes, notices: list[Place]) -> list[list[str]]:
    """Notices in order as expressions: neighbours with linking words and one
    operator between them share one."""
    wanted = {k for a, b in zip(notices, notices[1:]) if 0 < b.start - a.start - a.n <= 5
              for k in range(a.start + a.n, b.start)}
    words = {}
    if wanted:
        last = max(wanted)
        for k, m in enumerate(_WORD.finditer(low)):
            if k in wanted:
                words[k] = m[0].decode()
            if k >= last:
                break
    label = {**NOTICES, **BASE}
    out: list[list[str]] = []
    for i, p in enumerate(notices):
        between = [words.get(k) for k in range(notices[i - 1].start + notices[i - 1].n, p.start)
                   if k in words] if i else []
        signs = [w for w in between if w in ("and", "or")]
        if out and len(signs) == 1 and set(between) <= LINKS:
            out[-1] += [signs[0], label[p.phrase]]
        else:
            out.append([label[p.phrase]])
    return out


def scan(text: str | None, a, longest: int) -> dict:
    """Everything found in one text."""
    low = (text or "").encode().lower()           # bytes.lower changes A-Z alone
    n_words, found = places(low, a, longest)
    base = [p for p in found if p.phrase in BASE]
    labels, values = {BASE[p.phrase] for p in base}, []
    if found:
        notices = [p for p in found if p.phrase not in TAGS]
        widest = _widest(notices)
        values += [evaluate(postfix(t)) for t in _linked(low, widest)]
        for tag, tokens in _tagged(low, _widest([p for p in found if p.phrase in TAGS])):
            v = evaluate(postfix(tokens))
            if v is not None and (TAGS[tag.phrase] or "other" not in v.labels):
                values.append(v)
    values = [v for v in values if v is not None]
    labels = labels.union(*[v.labels for v in values])
    return {"n_words": n_words, "places": [p._asdict() for p in base],
            "base_labels": sorted({BASE[p.phrase] for p in base}), "labels": sorted(labels),
            "expressions": sorted({v.text for v in values}),
            "score": min((v.allows for v in values), default=0.0)}


def _widest(found: list[Place]) -> list[Place]:
    """Places not inside a longer one, by start."""
    out: list[Place] = []
    for p in sorted(found, key=lambda p: (p.start, -p.n)):
        if not out or p.start + p.n > out[-1].start + out[-1].n:
            out.append(p)
    return out


SCAN = ("n_words long, places array<struct<start:long,n:long,phrase:string>>, "
        "base_labels array<string>, labels array<string>, expressions array<string>, score double")


def license_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, places (every place of a
    base phrase), base_labels, labels (base and method, sorted), expressions
    (as evaluated, sorted), score in 0..1.  No shuffle."""
    kind = pa.struct([
        ("n_words", pa.int64()),
        ("places", pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int64()), ("phrase", pa.string())]))),
        ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())),
        ("expressions", pa.list_(pa.string())), ("score", pa.float64())])
    longest = max(p.count(" ") + 1 for p in {**BASE, **NOTICES, **TAGS})
    kept: dict = {}

    def run(texts: pa.Array) -> pa.Array:
        if "a" not in kept:
            kept["a"] = automaton()
        return pa.array([scan(t.as_py(), kept["a"], longest) for t in texts], kind)

    got = F.arrow_udf(run, SCAN)(F.col(f"`{text_col}`"))
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), got.alias("s")).select("doc_id", "s.*")
