"""Spark session construction and cluster-level settings."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Session defaults the operators rely on.  AQE re-plans joins against
# aggregated sides at run time (broadcast when the measured size is under
# the threshold, sort-merge with skew splitting above it) and coalesces
# small shuffle partitions; partition-column type inference is off so
# codes such as "01" or "2A" come back from a partitioned table as strings.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "pricelens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    ``master`` is only set when given, so spark-submit on a cluster keeps the
    cluster's master.  ``shuffle_partitions`` should follow the data size
    (about 128-256 MB of shuffle data per partition); AQE coalesces the
    rest.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = dict(DEFAULT_CONF)
    if shuffle_partitions:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update(conf or {})
    for key, value in merged.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is.
    Only when it is unset on a local master (tests) a scratch folder is
    created; on a cluster an unset folder is an error, never a folder on
    one machine's disk.
    """
    sc = spark.sparkContext
    # the setting is applied by SparkContext at start-up
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    local = sc.master.startswith("local")
    if current:
        shared = local or spark.conf.get("spark.pricelens.sharedFileSystem", "false") == "true"
        if not shared and (current.startswith("file:") or current.startswith("/tmp")):
            raise RuntimeError(f"spark.checkpoint.dir {current} is a folder of one machine; set a "
                               "shared one, or spark.pricelens.sharedFileSystem=true for a mount "
                               "that all machines share")
        return current
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the "
                           "cluster's distributed file system); lineage cuts are written there")
    # spark.checkpoint.dir is a core setting and cannot be changed on a
    # running session; the context's checkpoint folder can.
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="pricelens-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def shuffle_partitions_for(input_bytes: int, cores: int, *,
                           bytes_per_partition: int = 256 * 1024 * 1024,
                           min_per_core: int = 2) -> int:
    """Shuffle partition count for a job reading ``input_bytes``.

    About ``bytes_per_partition`` of input per shuffle partition, so a
    partition's sort and aggregation buffers fit in an executor core's
    memory whatever the input, and at least ``min_per_core`` for each of the
    cluster's cores (AQE merges partitions that turn out small, but never
    splits a large one outside skew joins).
    """
    by_size = -(-max(input_bytes, 0) // bytes_per_partition)
    return int(max(by_size, min_per_core * cores, 1))
