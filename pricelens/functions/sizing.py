"""Size-checked broadcast for derived (aggregated) join sides.

A derived side such as "mean per region" or "latest date per product" has
one row per group, and the number of groups is data-dependent, so it has
no static size bound.  ``broadcast_if_small`` materialises it once as a
Parquet table in the shared checkpoint folder, checks its rows against
``max_rows`` and its size against ``max_bytes``, and only then hints a
broadcast; above the bound the join is
left to the planner (sort-merge, with AQE skew splitting).  The count reads
the materialised copy, so the aggregate is computed once either way.

``materialize`` is the lineage cut used throughout: a Parquet table under
``spark.checkpoint.dir`` (shared storage on a cluster), written in one pass
and read back with file statistics the planner can use.  Unlike an RDD
checkpoint it does not recompute the plan for the write, and a lost
executor re-reads files instead of recomputing upstream stages.
"""

from __future__ import annotations

import uuid

from contextlib import contextmanager
from typing import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

DEFAULT_MAX_ROWS = 200_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024


#: Whether a query's shuffle files go at its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def brief_shuffles(spark: SparkSession):
    """Within it, a query's shuffle files are deleted as soon as the query has ended.
    Else they stay until the driver happens to collect its garbage: a job of several
    writes then holds the shuffles of all of them at once."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, name: str = "table", observation: Observation | None = None,
                metrics: Sequence[Column] = (), compression: str | None = None) -> DataFrame:
    """Write ``df`` and read it back; ``metrics`` are aggregates that ``observation``
    collects from the rows as they are written.  ``compression`` is the files' codec
    (default: the session's)."""
    spark = df.sparkSession
    if metrics:
        df = df.observe(observation, *metrics)
    path = scratch_path(spark, f"materialized/{name}-{uuid.uuid4().hex}")
    w = df.write.mode("errorifexists")
    (w.option("compression", compression) if compression else w).parquet(path)
    return spark.read.parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``materialize`` wrote, once no plan that
    reads it will run again.  Any other table raises."""
    spark = df.sparkSession
    folders = {unquote(f).rsplit("/", 1)[0] for f in df.inputFiles()}     # listed as URIs
    base = scratch_path(spark, "materialized/").split(":", 1)[-1].lstrip("/")
    for folder in folders:
        if base not in folder:
            raise ValueError(f"{folder} is not an intermediate table")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                       max_bytes: int = DEFAULT_MAX_BYTES, name: str = "small") -> DataFrame:
    """Materialise ``df``; hint a broadcast only if it has at most ``max_rows``
    rows and at most ``max_bytes`` by its rows' text and 16 bytes a field (NULL
    fields have no text but a slot).  The check reads at most ``max_rows + 1`` rows of
    the materialised copy and returns one row of two numbers."""
    materialised = materialize(df, name)
    head = materialised.limit(max_rows + 1)
    row_text = (F.octet_length(F.to_json(F.struct(*[F.col(c) for c in materialised.columns])))
                + 16 * len(materialised.columns))
    n, size = head.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_text), F.lit(0))).first()
    small = n <= max_rows and size <= max_bytes
    return F.broadcast(materialised) if small else materialised


def scalar_struct(one_row: DataFrame):
    """A one-row DataFrame (a global aggregate) as a struct-valued scalar
    subquery: ``s = scalar_struct(stats); df.select(..., s["lo"])``.

    Attaches scalar statistics to every row without any join: Spark runs
    the subquery once (repeated field reads reuse it) and the big side keeps
    its partitioning and whole-stage code generation.  More than one row is
    an error at run time; none gives NULL fields.
    """
    return one_row.select(F.struct(*one_row.columns).alias("_s")).scalar()
