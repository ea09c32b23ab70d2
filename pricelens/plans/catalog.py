"""Registered queries: one Spark plan and one DuckDB oracle per operator.

Each entry reads the driver tables (through ``bindings``) so its work grows
with the data.  Spark results and oracle results are compared after
rounding every double column to ``digits`` places on both sides (sums run
in a different order in the two engines).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import rounded
from .sqltext import rnd


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: Sequence[str] = field(default_factory=tuple)
    digits: int = 4

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(self.build(spark, sf_dir), self.digits)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        if not self.doubles:
            return self.sql.strip()
        repl = ", ".join(f"{rnd(f'{c} * {NUDGE!r}', self.digits)} AS {c}"
                         for c in self.doubles)
        return f"SELECT * REPLACE ({repl}) FROM (\n{self.sql.strip()}\n) AS q"


CATALOG: dict[str, Query] = {}

# Relative nudge applied before the comparison rounding (both sides).
NUDGE = 1.00000000001


def register(name: str, sql: str | None, doubles: Sequence[str] = (), digits: int = 4):
    def deco(fn):
        if name in CATALOG:
            raise ValueError(f"duplicate query name {name}")
        CATALOG[name] = Query(name, fn, sql, tuple(doubles), digits)
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    doubles = double_columns(df)
    if not doubles:
        return df
    # Spark rounds the shortest decimal form of the double half-up; the oracle
    # side does the same through VARCHAR (see sqltext.rnd).  The nudge moves
    # exact ties (a mean of a few two-decimal values is often exactly x.xxxx5)
    # off the tie in both engines alike, so a last-bit difference between their
    # sums cannot flip it.
    values = rounded([F.col(c) * F.lit(NUDGE) for c in doubles], digits).alias("__rounded")
    return df.select("*", values).select(*[
        F.col("__rounded")[doubles.index(c)].alias(c) if c in doubles else F.col(c) for c in df.columns])


def double_columns(df: DataFrame) -> list:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def load_all() -> dict:
    """Import every module that registers queries, return the catalog."""
    from . import (queries_clean, queries_core, queries_dashboard,  # noqa: F401
                   queries_features, queries_increments, queries_io, queries_job, queries_pipeline,
                   queries_stream)
    return CATALOG
