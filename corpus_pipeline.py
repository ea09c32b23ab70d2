"""Corpus pipeline: five stages from raw documents to token ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and reread as the next
one's ``docs``.  All but the last return the columns of ``documents``.

1. language_id: documents whose language is not identified go;
2. near_duplicates: one row of each group of near copies stays (the least
   id; rows with a NULL or repeated id are rows like others);
3. substring_dedup: words of passages that an earlier document has go, the
   documents stay;
4. decontaminate: rows contaminated with benchmark items go;
5. byte_bpe: token ids of what is left, with digests of ids and of the
   decoded bytes.

NULL texts and texts without letters have no language and go in the first
stage; an empty table passes all stages empty.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm import byte_bpe, decontaminate, langid, ngram_join, substring_dedup
from pricelens.llm.common import held_out, ship, table
from pricelens.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    model = langid.fit(docs, ~held_out("doc_id", 4, 2))
    return langid.keep_identified(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return ngram_join.one_row_per_group(docs)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return substring_dedup.remove_repeats(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    vocab = byte_bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    out = byte_bpe.encode_decode(docs, vocab)
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return out.select("doc_id", "n_tokens", F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring),
    ("decontaminate", decontaminated),
    ("byte_bpe", tokens),
]

#: Compression sizes and byte-pair merges have no SQL; the tests hold the
#: pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is a written table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline/{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.mode("errorifexists").parquet(path)
        docs = spark.read.parquet(path)
    return docs
