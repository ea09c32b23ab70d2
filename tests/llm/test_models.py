"""Language ID, language model, toxicity and top-k search."""

import math
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from brute import spaced
from pricelens.llm import exact_topk, langid, lattice_lm, toxicity
from pricelens.llm.common import held_out, table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


# --- language ID ----------------------------------------------------------------------

def test_language_held_out(spark):
    docs = table(spark, SF, "documents")
    out = held_out("doc_id", 4, 2)
    model = langid.fit(docs, ~out)
    got = langid.identify(docs, model).filter(out).collect()
    assert sum(r.langid.lang_pred == r.lang for r in got) >= 0.97 * len(got)
    assert all(0 <= r.langid.score <= 1 for r in got)
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns and kept.count() >= 0.99 * docs.count()


def test_language_edges(spark, make):
    fr, en = "le chat est sur la table et il dort " * 20, "the cat is on the table and it sleeps " * 20
    rows = [(i, fr, "fr", "s", 1) for i in range(5)] + [(i, en, "en", "s", 1) for i in range(5, 9)]
    rows += [(20, None, "fr", "s", 0), (21, "123 ... !!", "xx", "s", 0), (22, en, None, "s", 0), (None, fr, "fr", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, langid string, n_chars long")
    model = langid.fit(docs)
    assert set(model.dictionaries) == {"en", "fr"}        # neither NULL nor letterless texts teach
    texts = [(1, "il dort sur la table"), (2, "it sleeps on the table"), (3, None), (4, ""), (5, "12 !"),
             (6, "Ω" * 5), (7, en * 500)]
    got = {r.doc_id: r.langid for r in langid.identify(make(texts), model).collect()}
    assert got[1].lang_pred == "fr" and got[2].lang_pred == "en" and got[7].lang_pred == "en"
    assert all(got[i].lang_pred == "und" and got[i].rejected and got[i].score == 0 for i in (3, 4, 5))
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {0, 1, 5, 22, None}
    empty = langid.fit(docs.limit(0))
    assert {r.langid.lang_pred for r in langid.identify(make(texts), empty).collect()} == {"und"}
    assert langid.identify(make([]), model).count() == 0


def test_language_learns_beyond_a_common_head(spark):
    """Texts of all languages begin with one long header, or with no letters."""
    words = {"fr": "le chat dort sur la table pendant que les enfants jouent dans le jardin avec leurs amis".split(),
             "en": "the cat sleeps on the table while those children play in the garden with their friends".split()}
    rng, rows = random.Random(3), []
    head = "Copyright notice and licence terms of the site, all rights reserved. " * 20
    for i in range(120):
        lang = ("fr", "en")[i % 2]
        body = " ".join(rng.choice(words[lang]) for _ in range(600))
        rows.append((i, (head if i % 3 else "1234 ... " * 200) + body, lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert sum(map(len, model.dictionaries.values())) <= 2 * langid.DICT_BYTES
    for lang, data in model.dictionaries.items():
        assert len(set(words[lang]) & {w.decode() for w in data.split()}) >= 0.9 * len(set(words[lang]))
    test = [(i, " ".join(rng.choice(words[k]) for _ in range(60)), k) for i, k in enumerate(("fr", "en") * 20)]
    got = langid.identify(spark.createDataFrame(test, "doc_id long, text string, lang string"), model).collect()
    assert all(r.langid.lang_pred == r.lang and not r.langid.rejected for r in got)


def test_signs_that_are_no_letters_have_no_language():
    import pyarrow as pa

    model = langid.Model({"de": b"der die das und ist nicht", "en": b"the and of to in is not"})
    told = langid._predictor(model, 0.0)(pa.array(["²", "½ Ⅷ", "①②③", "12_34", "a", "日本"]))
    assert [x == "und" for x in told.field("lang_pred").to_pylist()] == [True] * 4 + [False] * 2


def test_language_margin_is_learnt(spark, make):
    """The margin keeps nearly all labelled texts and rejects most letter junk."""
    docs = table(spark, SF, "documents")
    out = held_out("doc_id", 4, 2)
    model = langid.fit(docs, ~out)
    assert len(model.min_margin) == len(langid.LENGTHS) + 1 and max(model.min_margin) > 0
    rng = random.Random(5)
    junk = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(60)) for _ in range(200)]
    got = langid.identify(make(list(enumerate(junk))), model).filter("langid.rejected").count()
    assert got >= 100
    # one language: no other to lose to, so the margin is that to no dictionary
    one = langid.fit(docs.filter("lang = 'en'"))
    told = langid.identify(make(list(enumerate(junk)) + [(900, "the people of the city and the water")]), one)
    told = {r.doc_id: r.langid for r in told.collect()}
    assert not told[900].rejected and sum(told[i].margin < told[900].margin for i in range(200)) >= 190


def test_language_common_length():
    assert langid.common_length([10, 20, 30], 60) == 30 and langid.common_length([10, 100, 100], 90) == 40
    assert langid.common_length([100] * 9, 4) == 1 and langid.common_length([], 5) == 1


def test_language_slices():
    raw = b" " + b" ".join(b"w%d" % i for i in range(5000)) + b" "
    got = langid.drawn(raw, 256, 7)
    assert got == langid.drawn(raw, 256, 7) != langid.drawn(raw, 256, 8)
    assert len(got) == langid.SLICES and sum(map(len, got)) <= 256 and all(x in raw for x in got)
    assert langid.drawn(b" ab ", 256, 1) == [b" ab "] and langid.drawn(b"\xe6\xbc\xa2" * 100, 1, 1)


def test_language_sizes_are_plain_compression():
    """The predictor against one compressor call for each block and language."""
    model = langid.Model({"a": b" alpha beta gamma delta " * 50, "b": b" uno dos tres cuatro " * 50})
    import pyarrow as pa
    texts = ["alpha gamma delta " * 2000, "dos tres " * 40]
    got = langid._predictor(model, 0.001)(pa.array(texts))
    for t, lang in zip(texts, got.field("lang_pred").to_pylist()):
        raw = langid.normalised(t)
        size = {k: sum(len(c.compress(raw[i:i + langid.BLOCK])) for i in range(0, len(raw), langid.BLOCK))
                for k, c in model.compressors().items()}
        assert lang == min(size, key=size.get)


# --- language model --------------------------------------------------------------------

def all_segmentations(word, logp):
    if not word:
        return 1.0
    return sum(math.exp(logp[word[:n]]) * all_segmentations(word[n:], logp)
               for n in range(1, len(word) + 1) if word[:n] in logp)


def test_lattice_sums_all_segmentations():
    rng = random.Random(2)
    pieces = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))).encode() for _ in range(40)}
                    | {b"a", b"b", b"c"})
    logp = np.log(np.random.default_rng(3).dirichlet(np.ones(len(pieces))))
    lattice, by = lattice_lm.Lattice(pieces, logp), dict(zip(pieces, logp.tolist()))
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 12))).encode() for _ in range(200)] + [b"d", b"ad"]
    got = lattice.log_marginals(words)
    for w, g in zip(words, got):
        p = all_segmentations(w, by)
        assert g == -math.inf if p == 0 else abs(g - math.log(p)) < 1e-9
    long = b"abc" * 200
    assert abs(lattice.log_marginals([long])[0] - lattice._scalar(long)) < 1e-6
    twice = lattice_lm.Lattice([b"a", b"a"], np.log([0.25, 0.5]))      # two pieces for one string
    assert abs(math.exp(twice.log_marginals([b"a"])[0]) - 0.75) < 1e-12


@pytest.mark.parametrize("batch_bytes", [1 << 23, 100])
def test_scores(make, batch_bytes):
    rng = random.Random(4)
    vocab = ["the", "Cat", "sat", "on", "mat", "zebra", "naïve", "x" * 300]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 30)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "unseen-word qqq"), (5, "the mat"), (None, "the\tcat\x0bsat")]
    docs = make(rows)
    train = [i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    got = lattice_lm.scores(docs, P.path("piece_bpe_32k.model"),
                            F.col("doc_id").isNotNull() & ~held_out("doc_id", 7, 2),
                            batch_bytes=batch_bytes).collect()
    count = {}
    for (_, t), learn in zip(rows, train):
        if learn:
            for w in [*spaced(t, lower=True), None]:
                count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    want = []
    for i, t in rows:
        toks = [*spaced(t, lower=True), None]
        want.append((i, len(toks), sum(w in count for w in toks),
                     round(sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in toks), 6)))
    assert sorted([(r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got], key=repr) == sorted(want, key=repr)
    assert all(r.train_tokens == n and r.score < 0 and math.isfinite(r.score) for r in got)
    assert all(r.score >= r.lattice_score + math.log10(0.01) * r.n_tokens for r in got)


def test_scores_are_probabilities(make):
    """The whole-word path and the pieces add up by their weight."""
    docs = make([(1, "aa bb aa"), (2, "aa cc")])
    got = {r.doc_id: r for r in lattice_lm.scores(docs, P.path("piece_bpe_32k.model")).collect()}
    n, ends, once = 7, 2, 2                       # aa 3, bb 1, cc 1, two ends
    weight = 1 - once / n
    pieces = lattice_lm.Pieces(P.path("piece_bpe_32k.model"))
    ids = [i for w in ("aa", "bb", "cc") for i in pieces.sp.encode(w)]
    c = np.array([ids.count(i) + 1 for i in pieces.ids], float)
    share = (ends + 1) / (n + 4 + 2)
    lattice = lattice_lm.Lattice(pieces.bytes, lattice_lm.with_end(pieces.bytes, c / c.sum(), share))
    m = dict(zip(("aa", "bb", "cc"), np.exp(lattice.log_marginals([b"\xffaa", b"\xffbb", b"\xffcc"]))))
    end = weight * ends / n + (1 - weight) * share

    def p(word, k):
        return weight * k / n + (1 - weight) * m[word]
    assert abs(got[1].score - math.log10(p("aa", 3) ** 2 * p("bb", 1) * end)) < 1e-4
    assert abs(got[2].score - math.log10(p("aa", 3) * p("cc", 1) * end)) < 1e-4
    none = lattice_lm.scores(docs, P.path("piece_bpe_32k.model"), F.lit(False)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in none)
    assert lattice_lm.scores(make([]), P.path("piece_bpe_32k.model")).count() == 0


@pytest.mark.parametrize("end", [0.02, 0.3, 0.9])
def test_words_and_end_sum_to_one(end):
    """All words of a tiny vocabulary, enumerated, and the end."""
    pieces = [b"\xffa", b"\xffb", b"\xffab", b"a", b"b", b"bb"]
    p = np.array([0.3, 0.25, 0.2, 0.1, 0.1, 0.05])
    lattice = lattice_lm.Lattice(pieces, lattice_lm.with_end(pieces, p, end))
    strings = [b""]
    mass = 0.0
    for _ in range(13):
        strings = [s + c for s in strings for c in (b"a", b"b")]
        mass += float(np.exp(lattice.log_marginals([b"\xff" + s for s in strings])).sum())
    assert abs(mass + end - 1) < 1e-4


# --- toxicity ---------------------------------------------------------------------------

def test_nearest_examples_are_exact():
    rng = np.random.default_rng(5)
    idf = rng.uniform(1, 6, 12)
    rows = []
    for i in range(1500):
        at = sorted(rng.choice(12, rng.integers(1, 5), replace=False).tolist())
        rows.append((int(i * 37 % 1501), int(rng.random() < 0.3), at, rng.integers(1, 4, len(at)).tolist()))
    index = toxicity.Index(idf, rows, (1, 10))
    asked = []
    for _ in range(60):
        at = sorted(rng.choice(12, rng.integers(1, 5), replace=False).tolist())
        asked.append((at, rng.integers(1, 4, len(at)).tolist()))
    for (at, tf), (best, cosine) in zip(asked, index.nearest(asked, 15)):
        v = index.vector(at, tf)
        full = sorted(((-round(float(index.vector(r[2], r[3]) @ v), 12), r[0]) for r in rows
                       if index.vector(r[2], r[3]) @ v > 0))[:15]
        assert [(int(index.ids[b])) for b in best] == [i for _, i in full]
        assert np.allclose(-np.array([c for c, _ in full]), cosine)
        assert 0 <= index.vote(best, cosine) <= 1


def test_lists_are_read_once_a_text(monkeypatch):
    """However little the best neighbours stand out, a text reads each list of its
    terms once: no list of bounds before, no second reading after a first floor."""
    read, real = [], toxicity._ranges
    monkeypatch.setattr(toxicity, "_ranges", lambda a, n: read.append(int(n.sum())) or real(a, n))
    rng = np.random.default_rng(8)
    rows = [(i, i % 2, sorted(rng.choice(120, 6, replace=False).tolist()), [1] * 6) for i in range(1000)]
    index = toxicity.Index(np.ones(120), rows, (1, 10))
    asked = [(sorted(rng.choice(120, 8, replace=False).tolist()), [1] * 8) for _ in range(70)]
    assert all(len(best) == 15 for best, _ in index.nearest(asked, 15))
    held = np.bincount(np.concatenate([r[2] for r in rows]), minlength=120)
    assert sum(read) == sum(int(held[at].sum()) for at, _ in asked)


def test_toxicity_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = toxicity.toxicity(docs, labels, ~held_out("doc_id", 5, 0)).collect()
    assert len(got) == docs.count()
    seen = [r for r in got if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(r.predicted == truth[r.doc_id] for r in seen) >= 0.95 * len(seen)
    assert all(len(r.evidence) <= 3 and (r.predicted == 1) == (r.score >= 0.5) for r in got)


def test_toxicity_edges(spark, make):
    bad, good = "you stupid moron go away", "a calm and pleasant afternoon walk"
    rows = [(i, bad if i % 4 == 0 else good + f" number {i}") for i in range(80)]
    rows += [(100, None), (101, ""), (102, "!!! 123"), (103, "STUPID moron " * 2000), (104, "unrelated words"),
             (0, bad), (None, bad)]
    labels = spark.createDataFrame(
        [(i, int(i % 4 == 0), 1) for i in range(80)] + [(0, 0, 1), (None, 1, 1), (50, None, 1), (999, 1, 1)],
        "doc_id long, toxic int, label int")
    got = toxicity.toxicity(make(rows).withColumnRenamed("lang", "label"), labels).collect()
    assert len(got) == len(rows)
    score = {r.doc_id: r.score for r in got}
    assert score[103] > 0.8 and score[4] > 0.8 and max(score[i] for i in (1, 100, 101, 102, 104)) < 0.2
    assert score[100] == score[101] == score[102]
    none = toxicity.toxicity(make(rows), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert toxicity.toxicity(make([]), labels).count() == 0


def plain_toxicity(docs, labels, learn, k=toxicity.K):
    """All cosines of all texts, term by term: (doc_id, score, nearest examples)."""
    def bag(text):
        raw = (text or "").lower()
        out = {}
        for w in "".join(c if ord(c) > 127 or c.isalpha() else " " for c in raw).split():
            out[w] = out.get(w, 0) + 1
        return out
    bags = [(i, bag(t)) for i, t in docs]
    df = {}
    for _, b in bags:
        for w in b:
            df[w] = df.get(w, 0) + 1
    label = {}
    for i, y in labels:
        if learn(i):
            label[i] = max(label.get(i, 0), y)
    examples = {i: b for i, b in bags if i in label}
    pos = sum(label[i] for i in examples)
    neg = len(examples) - pos
    known = {w for b in examples.values() for w in b}
    lean = {}
    for w in known:
        a = sum(label[i] for i, b in examples.items() if w in b)
        b_ = sum(w in b for b in examples.values()) - a
        c, d = pos - a, neg - b_
        chi = 0.0
        if a * neg > b_ * pos and (a + b_) * (c + d) * pos * neg:
            chi = (pos + neg) * (a * d - b_ * c) ** 2 / ((a + b_) * (c + d) * pos * neg)
        lean[w] = math.sqrt(max(chi - toxicity.CHANCE, 0) / len(examples))

    def vector(b):
        v = {w: (1 + math.log(n)) * (math.log((1 + len(docs)) / (1 + (df[w] if w in known else 0))) + 1)
             * (toxicity.BASE + lean.get(w, 0)) for w, n in b.items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {w: x / norm for w, x in v.items()}
    rest = [label[i] for i, b in examples.items() if not any(lean[w] > 0 for w in b)]
    prior = (sum(rest) + 0.5) / (len(rest) + 1.0)
    rows = {i: vector(b) for i, b in examples.items()}
    out = []
    for i, b in bags:
        v = vector(b)
        near = sorted((-round(sum(x * e[w] for w, x in v.items() if w in e), 12), j) for j, e in rows.items())
        near = [(-c, j) for c, j in near[:k] if -c > 1e-12]
        score = (prior * toxicity.SHRINK + sum(c * label[j] for c, j in near)) / (
            toxicity.SHRINK + sum(c for c, _ in near))
        out.append((i, score, [j for _, j in near[:3]]))
    return out


def test_toxicity_is_a_full_cosine_scan(spark):
    """Scores and evidence of the whole query against all cosines of all texts."""
    def learn(i):
        return zlib.crc32(str(i).encode()) % 5 != 0
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    labels = [(r.doc_id, r.toxic) for r in table(spark, SF, "labels").collect()]
    docs, ids = docs[:400], {i for i, _ in docs[:400]}
    labels = [x for x in labels if x[0] in ids]
    assert 0 < sum(y for i, y in labels if learn(i)) < len(labels)
    got = toxicity.toxicity(spark.createDataFrame(docs, "doc_id long, text string"),
                            spark.createDataFrame(labels, "doc_id long, toxic int"),
                            ~held_out("doc_id", 5, 0)).collect()
    want = {i: (s, near) for i, s, near in plain_toxicity(docs, labels, learn)}
    assert len(got) == len(docs)
    for r in got:
        assert abs(r.score - want[r.doc_id][0]) < 1e-9
        assert [e.doc_id for e in r.evidence] == want[r.doc_id][1]


def test_toxicity_bounds_its_examples(make):
    """A labelled text beyond the byte bound teaches nothing but is scored whole."""
    docs = make([(1, "bad bad words"), (2, "fine words"), (3, "x " * 500 + "bad")])
    labels = docs.sparkSession.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels, example_bytes=100).collect()}
    assert {e.doc_id for r in got.values() for e in r.evidence} == {1, 2}
    assert [e.doc_id for e in got[3].evidence] == [1]


# --- top-k search ------------------------------------------------------------------------

def plain_topk(rows, k, scale=64):
    vecs = [(i, [math.floor(float(np.float32(c)) * scale) for c in v]) for i, v in rows
            if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    queries = {}
    for i, v in vecs:
        if i % 20 == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, x in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(x, v)), i) for i, v in vecs if i != q and len(v) == len(x))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [24 << 20, 2000])
def test_topk(spark, block_bytes):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(-2, 2) for _ in range(5)]) for i in range(300)]
    same = [0.5, -0.25, 1.0, 0.0, 2.0]
    rows += [(i, same) for i in range(300, 380)]                      # many ties
    rows += [(400, None), (401, [1.0, None, 0.0, 0.0, 0.0]), (402, [float("nan")] * 5), (403, [float("inf")] * 5),
             (404, []), (420, []), (421, [1.0, 2.0]), (440, [3.0, 4.0]), (None, same), (20, same), (7, same),
             (460, [1e6] * 5), (461, [3e30] * 5)]
    vectors = exact_topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(9))
    got = exact_topk.topk(vectors.filter("vec_id % 20 = 0"), vectors, k=20, block_bytes=block_bytes).collect()
    want = [w for w in plain_topk([r for r in rows if r[0] != 461], 20)]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)
    # the vector beyond 64 bits: its scores stop at the ends of the range
    plain = exact_topk.quantised(spark.createDataFrame([r for r in rows if r[0] != 461],
                                                       "vec_id long, embedding array<float>"))
    exact = exact_topk.topk(plain.filter("vec_id % 20 = 0"), plain, k=20, block_bytes=block_bytes)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in exact.collect()) == want
    assert len(got) >= len(want)


def test_topk_of_no_rows(spark):
    none = exact_topk.quantised(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert exact_topk.topk(none, none).count() == 0
    one = exact_topk.quantised(spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>"))
    assert exact_topk.topk(one, one).count() == 0


def test_products_beyond_floating_point():
    q = np.array([[2**40, 1], [2**62, 2**62]], dtype=np.int64)
    x = np.array([[2**20, 1], [2**62, 2**62], [-2**62, -2**62]], dtype=np.int64)
    got = exact_topk.products(q, x)
    assert got[0, 0] == 2**60 + 1 and got[1, 1] == 2**63 - 1 and got[1, 2] <= -2**63 + 2
    assert exact_topk.products(np.array([[2**30, 1]]), np.array([[2**30, 1]])).tolist() == [[2**60 + 1]]
