"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import math
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sizing import materialize

__all__ = ["materialize", "ship", "release", "lean", "lean_pair", "table", "keyed_text", "text_bytes", "block_count", "held_out"]


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the executors' Python import this package: once per application the
    package's sources are added with ``addPyFile`` (what ``--py-files`` does),
    unless it runs from an archive already."""
    sc, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if sc.applicationId in _SHIPPED or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def release() -> None:
    """Give this Python worker's freed memory back to the system.  Workers serve one
    task after the other; what the allocators keep of a large group would add up
    with what the next task needs."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim      # glibc; other systems have none
    except (AttributeError, OSError):
        return None


_TRIM = _trim()


def lean(of_group):
    """A function of one group's table that releases memory behind itself."""
    def run(table):
        out = of_group(table)
        release()
        return out
    return run


def lean_pair(of_groups):
    """``lean`` for a function of two cogrouped tables."""
    def run(left, right):
        out = of_groups(left, right)
        release()
        return out
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) of every row; a NULL text becomes empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of a text column: one aggregate, one row."""
    return int(docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0)


def block_count(spark: SparkSession, n_bytes: int, bytes_per_block: int) -> int:
    """Blocks of about ``bytes_per_block`` each, and at least one for every
    shuffle partition, so the size of one block does not grow with the input."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(n_bytes / bytes_per_block), 1)


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """crc32 of the id's decimal text leaves ``remainder``; false for a NULL id."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))
