"""Queries of the operators over the whole driver tables, and their SQL."""

from __future__ import annotations

import functools
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (byte_bpe, conversation_repair, conversation_trie, decontaminate, exact_topk, langid, lattice_lm,
               license_scan, ngram_join, substring_dedup, token_counts, token_store, toxicity)
from .common import held_out, ship, table


def _ranks() -> byte_bpe.Vocabulary:
    return byte_bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document: section -1 holds the document's
    unattributed tokens (0 for lines, which cover the text)."""
    got = token_counts.section_tokens(table(spark, sf_dir, "documents"), _ranks())
    none = F.struct(F.lit("-1").alias("name"), F.lit(0).alias("start"), F.lit(0).alias("end"),
                    F.col("unattributed").alias("n_tokens"))
    rows = got.select("doc_id", F.col("n_tokens").alias("doc_tokens"),
                      F.explode(F.concat(F.array(none), "sections")).alias("s"))
    return rows.select("doc_id", "doc_tokens", F.col("s.name").cast("int").alias("section"),
                       F.col("s.start").alias("start_char"), F.col("s.end").alias("end_char"),
                       F.col("s.n_tokens").alias("n_tokens"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    store = token_store.write_store(docs, scratch_path(spark, f"token-store/{uuid.uuid4().hex}"),
                                    public_tokenizers.path("byte_bpe_50k.json"), end_id=2,
                                    added_tokens=True)
    got = token_store.lookup(store, docs)
    return got.select(F.col("key").alias("doc_id"), "start", "n_tokens",
                      F.crc32("ids").alias("ids_crc32"))


def op3_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = held_out("doc_id", 7, 2)
    got = lattice_lm.scores(table(spark, sf_dir, "documents"),
                            public_tokenizers.path("piece_bpe_32k.model"), ~out)
    return got.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score", "lattice_score")


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = exact_topk.quantised(table(spark, sf_dir, "embeddings"))
    return exact_topk.topk(vectors.filter("vec_id % 20 = 0"), vectors)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(table(spark, sf_dir, "documents"),
                                      table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      digest.alias("items_sha256"), "contaminated")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicate_groups(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.repeated_words(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed",
                      F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out("doc_id", 4, 2)
    model = langid.fit(docs, ~out)
    got = langid.identify(docs.select("doc_id", "text"), model)
    return got.select("doc_id", out.alias("held_out"), "langid.lang_pred", "langid.score",
                      "langid.margin", "langid.rejected")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = held_out("doc_id", 5, 0)
    got = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~out)
    near = F.transform("evidence", lambda e: F.format_string("%d:%.4f:%d", e["doc_id"], e["cosine"], e["label"]))
    return got.select("doc_id", out.alias("held_out"), "score", "predicted",
                      F.array_join(near, " ").alias("nearest"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = byte_bpe.encode_decode(table(spark, sf_dir, "documents"), _ranks())
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return out.select("doc_id", "n_tokens", F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = license_scan.license_scan(table(spark, sf_dir, "documents"))
    starts = F.transform("places", lambda p: p["start"])
    return got.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
                      F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                      F.array_join("base_labels", ",").alias("base_labels"),
                      F.array_join("labels", ",").alias("labels"), "score",
                      F.array_join("expressions", "; ").alias("expressions"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    got = conversation_repair.repair(rows, there=F.col("there"))
    return got.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                      "repaired_sha256")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_trie.entries(conversation_trie.turns(table(spark, sf_dir, "conversations")))
    return conversation_trie.trie(conversation_trie.rebuilt(rows))


def _shipped(query):
    """The query, once the executors can import this package."""
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)
    return run


QUERIES = {q.__name__: _shipped(q) for q in (
    op1_token_counts, op2_token_store, op3_lattice_lm, op4_exact_topk, op5_substring_dedup,
    op6_decontaminate, op7_ngram_join, op8_language_id, op9_toxicity, op10_byte_bpe, op11_license_scan,
    op12_conversation_repair, op13_conversation_trie)}

# --- DuckDB SQL ----------------------------------------------------------------

OP6_SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, ws[i:i + 12] AS win, least(len(ws), 13) AS k
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i
        FROM items WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT k FROM wins),
dwin AS (
  SELECT r, k, i, ws[i:i + k - 1] AS win
  FROM (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM w, lens WHERE len(ws) >= k)),
occ AS (SELECT d.r, d.i, d.k, x.item_id FROM dwin d JOIN wins x ON d.win = x.win AND d.k = x.k),
hit AS (SELECT r, count(DISTINCT p) AS n_hit
        FROM (SELECT r, unnest(range(i, i + k)) AS p FROM occ) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT r, item_id FROM occ) GROUP BY r)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w.ws) AS contaminated
FROM w LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""

OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i
        FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
           FROM sh x JOIN sh y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
          WHERE 100 * c >= 80 * (p.n + q.n - c)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION
          SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       least(w.doc_id, coalesce((SELECT min(b) FROM reach WHERE reach.a = w.doc_id), w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id)
"""

OP5_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
least_doc AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
         FROM win JOIN least_doc USING (g) WHERE doc_id > m),
word AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept
         FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""

OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_sum(list_transform(list_zip(q.x, v.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.x) = len(v.x) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20
"""

def _crc32_sql(text: str) -> str:
    """crc32 of an ASCII string, bit by bit."""
    bits = (f"flatten(list_transform(range(1, length({text}) + 1), lambda i: list_transform(range(8), "
            f"lambda b: CAST((ascii(substr({text}, CAST(i AS INTEGER), 1)) >> CAST(b AS INTEGER)) & 1 AS BIGINT))))")
    step = "lambda s, b: xor(s >> 1, CASE WHEN (s & 1) <> b THEN 3988292384 ELSE 0 END)"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}), {step}), 4294967295)"


def _edit(node: str, cost: str, letter: str, when: str, role: str | None) -> str:
    """A script of ``node`` with one more edit; its text with one more line."""
    text = f"{node}.txt" if role is None else f"concat({node}.txt || chr(10), {role}, ':', r.text)"
    return (f"CASE WHEN {node} IS NOT NULL AND {when} THEN "
            f"{{cost: {node}.cost + {cost}, audit: {node}.audit || '{letter}', txt: {text}}} END")


def _least(last: int, *into: str) -> str:
    gone = _edit(f"n{last}", "2", "D", "true", None)
    return f"list_min([{', '.join([gone, *into])}])"


def _turn(sources: tuple[int, ...], role: str) -> list[str]:
    keep = [_edit(f"n{q}", "r.extra", "K", f"NOT r.gone AND left(r.role, 1) = '{role[0]}'", "r.role") for q in sources]
    return keep + [_edit(f"n{q}", "1 + r.extra", "R", "NOT r.gone", f"'{role}'") for q in sources]


_SCRIPT = "STRUCT(cost BIGINT, audit VARCHAR, txt VARCHAR)"
OP12_SQL = rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32_sql("key")} % 20 AS code
  FROM (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
        FROM conversations)),
damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN code = 1 THEN '' WHEN code = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy
  FROM raw WHERE code <> 0),
ordered AS (
  SELECT *, row_number() OVER w AS i, lag(role) OVER w AS role_before,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
faults AS (
  SELECT *, NOT regexp_matches(text, '[^ 	-
]') AS blank,
         regexp_matches(text, '[^ 	-
]') AND again AS dup,
         NOT again AND regexp_matches(text, '[^.!? 	-
][ 	-
]*\z') AS cut
  FROM ordered),
rows AS (SELECT conv_id, i, role, text, blank OR dup AS gone, CASE WHEN cut THEN 5 ELSE 0 END AS extra FROM faults),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (i > 1 AND left(role_before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id),
scripts AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, CAST({{cost: 0, audit: '', txt: NULL}} AS {_SCRIPT}) AS n0,
         CAST(NULL AS {_SCRIPT}) AS n1, CAST(NULL AS {_SCRIPT}) AS n2, CAST(NULL AS {_SCRIPT}) AS n3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT s.conv_id, r.i, {_least(0)},
         {_least(1, _edit("n0", "r.extra", "K", "NOT r.gone AND left(r.role, 1) = 's'", "r.role"))},
         {_least(2, *_turn((0, 1, 3), "user"))},
         {_least(3, *_turn((2,), "assistant"))}
  FROM scripts s JOIN rows r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1),
done AS (SELECT s.conv_id, list_min([n0, n3]) AS best
         FROM scripts s LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM s.conv_id WHERE s.i = coalesce(c.n, 0))
SELECT d.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, best.cost AS cost, best.audit AS audit,
       sha256(coalesce(best.txt, '')) AS repaired_sha256
FROM done d LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
"""

OP13_SQL = f"""
WITH own AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS d
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, {_crc32_sql("CAST(c AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT c FROM own)),
heads AS (SELECT i.c, o.d, o.r, o.t FROM ids i JOIN own o ON o.c = i.c - i.c % 100 AND o.d <= i.h),
taken AS (SELECT c, count(*) AS n FROM heads GROUP BY c),
turned AS (
  SELECT * FROM heads UNION ALL
  SELECT i.c, o.d - i.h + coalesce(k.n, 0), o.r, o.t
  FROM ids i JOIN own o ON o.c = i.c AND o.d > i.h LEFT JOIN taken k ON k.c = i.c),
whole AS (SELECT i.c, coalesce(s, []) AS s FROM ids i LEFT JOIN
          (SELECT c, list({{r: r, t: t}} ORDER BY d) AS s FROM turned GROUP BY c) USING (c)),
member AS (SELECT c, d, s[1:d] AS p, d = len(s) AS last FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM whole)),
node AS (SELECT d, p, min(c) AS conv_id, count(*) AS n, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last) AS ends
         FROM member GROUP BY d, p),
path AS (SELECT m.c, m.d, n.conv_id FROM member m JOIN node n ON m.d = n.d AND m.p = n.p),
linked AS (SELECT n.*, a.conv_id AS parent, CASE WHEN n.d = 0 THEN 0 ELSE (n.n - 1) * length(n.p[n.d].t) END AS v
           FROM node n LEFT JOIN path a ON a.c = n.conv_id AND a.d = n.d - 1),
child AS (SELECT d - 1 AS d, parent AS conv_id, count(*) AS k FROM linked WHERE d > 0 GROUP BY ALL),
full_node AS (SELECT l.*, coalesce(k, 0) AS k FROM linked l LEFT JOIN child USING (d, conv_id)),
subtree AS (SELECT a.d, a.conv_id, sum(f.v) AS saved, count(*) FILTER (f.k = 0) AS leaves
            FROM full_node f JOIN path a ON a.c = f.conv_id AND a.d <= f.d GROUP BY ALL)
SELECT f.conv_id, f.d AS depth, f.parent AS parent_conv_id, f.n AS n_convs, f.k AS n_children,
       leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM full_node f JOIN subtree USING (d, conv_id)
"""

ORACLES = {
    "op4_exact_topk": OP4_SQL,
    "op5_substring_dedup": OP5_SQL,
    "op7_ngram_join": OP7_SQL,
    "op6_decontaminate": OP6_SQL,
    "op12_conversation_repair": OP12_SQL,
    "op13_conversation_trie": OP13_SQL,
}
