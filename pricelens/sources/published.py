"""Tables published together: new folders, then one manifest that names them.

A writer puts its tables into folders that no reader knows yet and then adds one
small manifest file; readers take the newest manifest.  So a job that stops
between two tables leaves the old set readable, and readers never see a mixture.
A manifest maps names (``by_region``, or ``latest/2025-01`` for one partition of
a table) to folders and schemas; names that a writer does not mention keep theirs.

The manifest's number is taken by a rename that fails if the number is there, so
of two writers that began from the same set one raises instead of undoing the
other.  (A store whose rename replaces files needs one writer at a time.)
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .files import write_table

FOLDER = "_published"


class Entry(NamedTuple):
    """A published table or the table that holds a published partition: its folder
    below the base, and its schema as JSON."""
    folder: str
    schema: str


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _manifests(spark: SparkSession, base: str) -> list[int]:
    fs, p = _fs(spark, f"{base.rstrip('/')}/{FOLDER}/*.json")
    return sorted(int(s.getPath().getName()[:-5]) for s in (fs.globStatus(p) or ()))


def _read(spark: SparkSession, base: str, number: int) -> dict[str, Entry]:
    path = f"{base.rstrip('/')}/{FOLDER}/{number:010d}.json"
    text = spark.read.text(path, wholetext=True).first()[0]
    return {k: Entry(**v) for k, v in json.loads(text).items()}


def current(spark: SparkSession, base: str) -> tuple[int, dict[str, Entry]]:
    """(number, entries) of the newest manifest; (0, {}) before the first."""
    numbers = _manifests(spark, base)
    return (numbers[-1], _read(spark, base, numbers[-1])) if numbers else (0, {})


def new_folder() -> str:
    """A folder name, below a base, that nobody has used."""
    return f"data/{uuid.uuid4().hex}"


def publish(spark: SparkSession, base: str, entries: dict[str, Entry | None], since: int) -> int:
    """Add a manifest: that of number ``since`` with ``entries`` in place of those
    of the same names (None takes a name out).  Raises if another has been
    published since."""
    base, old = base.rstrip("/"), (_read(spark, base, since) if since else {})
    merged = {k: v for k, v in {**old, **entries}.items() if v is not None}
    text = json.dumps({k: v._asdict() for k, v in sorted(merged.items())})
    fs, tmp = _fs(spark, f"{base}/{FOLDER}/.new-{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    out.write(bytearray(text.encode()))
    out.close()
    _, final = _fs(spark, f"{base}/{FOLDER}/{since + 1:010d}.json")
    if fs.exists(final) or not fs.rename(tmp, final):
        fs.delete(tmp, False)
        raise RuntimeError(f"another writer has published to {base} since {since}")
    return since + 1


def write(df: DataFrame, base: str, folder: str, *, fmt: str = "parquet", partition_by=None,
          cluster_by=(), rebalance: bool = True) -> Entry:
    """Write a table into a folder of its own, for an entry of ``publish``."""
    write_table(df, f"{base.rstrip('/')}/{folder}", fmt=fmt, mode="errorifexists", partition_by=partition_by,
                cluster_by=cluster_by, rebalance=rebalance)
    return Entry(folder, df.schema.json())


def load(spark: SparkSession, base: str, entry: Entry) -> DataFrame:
    """A published table, in its own types (codes such as ``01`` stay text)."""
    schema = StructType.fromJson(json.loads(entry.schema))
    return spark.read.schema(schema).parquet(f"{base.rstrip('/')}/{entry.folder}")


def load_parts(spark: SparkSession, base: str, entries: dict[str, Entry], table: str,
               only: set[str] | None = None) -> DataFrame | None:
    """The partitions ``<table>/<period>`` of a manifest as one table (None without
    any): each folder is read once, and of it only the periods that still count."""
    wanted: dict[Entry, list[str]] = {}
    for name, entry in entries.items():
        head, _, period = name.partition("/")
        if head == table and period and (only is None or period in only):
            wanted.setdefault(entry, []).append(period)
    out = None
    for entry, periods in wanted.items():
        df = load(spark, base, entry).filter(F.col("period").isin(periods))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def publish_marts(spark: SparkSession, marts: dict, base: str) -> dict[str, str]:
    """S9, all at once: write each mart, then publish the set; name -> path."""
    since, _ = current(spark, base)
    folder = new_folder()
    entries = {name: write(df, base, f"{folder}/{name}") for name, df in marts.items()}
    publish(spark, base, entries, since)
    return {name: f"{base.rstrip('/')}/{e.folder}" for name, e in entries.items()}


def load_published(spark: SparkSession, base: str, name: str) -> DataFrame:
    """S10 from a published set."""
    _, entries = current(spark, base)
    if name not in entries:
        raise ValueError(f"{name!r} is not published in {base}")
    return load(spark, base, entries[name])


def expire(spark: SparkSession, base: str, keep: int = 2) -> int:
    """Delete all but the last ``keep`` manifests and every data folder that these do
    not name; returns the number of folders deleted.  Not while a writer runs."""
    base, numbers = base.rstrip("/"), _manifests(spark, base)
    if not numbers:
        return 0
    used = {e.folder.split("/")[1] for n in numbers[-keep:] for e in _read(spark, base, n).values()}
    for n in numbers[:-keep]:
        fs, p = _fs(spark, f"{base}/{FOLDER}/{n:010d}.json")
        fs.delete(p, False)
    fs, data = _fs(spark, f"{base}/data/*")
    gone = [s.getPath() for s in (fs.globStatus(data) or ()) if s.getPath().getName() not in used]
    for p in gone:
        fs.delete(p, True)
    return len(gone)
