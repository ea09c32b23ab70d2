"""Landed snapshots as a file stream.

The published job re-reads every daily snapshot on each run.  Here new
files are picked up by a Structured Streaming file source: each file is
parsed and cleaned once (P1-P8 are stateless projections and filters, plus
a broadcast join to the fixed department dimension) and lands in a long
Parquet table.  The stream's checkpoint records which files are done, and a
batch that is run again replaces its own folder, so a restart - or a lost
executor - neither skips nor duplicates a snapshot.  The batch plans (E1/E2)
then read that table.

The stream itself carries the paths of new files only; a batch of them is read
by the batch scan (``sources.files``), with its checks of array files and its
splitting of line files.

``trigger(availableNow=True)`` processes whatever has landed and stops,
which fits a daily schedule; a processing-time trigger keeps it running.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schema as S
from ..operators import clean
from ..session import scratch_path
from ..sources.files import read_table, snapshot_glob

#: Columns of the ``binaryFile`` source; only the path is ever read.
LISTED = "path string, modificationTime timestamp, length long, content binary"


def landed_files(spark: SparkSession, landing_dir: str, glob: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the paths of new files (no contents)."""
    r = spark.readStream.format("binaryFile").schema(LISTED).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(landing_dir).select("path")


def start_incremental_clean(spark: SparkSession, landing_dir: str, out_path: str, *,
                            checkpoint_location: str | None = None,
                            low: float = 0.0, high: float = 5.0,
                            glob: str | None = None, available_now: bool = True,
                            schema=S.RAW_OBSERVATION, fmt: str = "json", on_corrupt: str = "fail",
                            max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Clean newly landed snapshots into the long Parquet table ``out_path``.

    ``checkpoint_location`` must be shared storage; by default it lives
    under ``spark.checkpoint.dir``, in a folder of its own for each pair of
    landing folder and output, so another output starts from the beginning.
    Each batch of files is a folder ``batch=<n>`` of the table.  A corrupt file
    or record fails the stream; with ``on_corrupt`` "report" its row has no keys
    and goes in P2.
    """
    pair = hashlib.sha256(f"{landing_dir}\n{out_path}".encode()).hexdigest()[:32]
    ckpt = checkpoint_location or scratch_path(spark, f"streams/incremental_clean-{pair}")
    if fmt not in ("json", "jsonl"):
        raise ValueError(f"snapshots stream as json or jsonl, not {fmt!r}")

    def land(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.collect()]          # the files that just landed
        if paths:
            raw = read_table(batch.sparkSession, paths, fmt, schema, on_corrupt=on_corrupt).drop(S.CORRUPT)
            cleaned = clean.clean_observations(raw, low=low, high=high)
            cleaned.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch={number}")

    files = landed_files(spark, landing_dir, glob or snapshot_glob(fmt), max_files_per_trigger)
    w = files.writeStream.foreachBatch(land).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    return w.start()
