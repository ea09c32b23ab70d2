"""File scans and sinks.

Scans take an explicit schema: no inference pass over the data, stable
types (codes stay strings).  A malformed value becomes NULL; a malformed
record or file never vanishes: it fails the read, or is reported in the
corrupt column, as the caller says.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from .. import schema as S

FORMATS = ("json", "jsonl", "csv", "parquet")


def check_format(fmt: str) -> str:
    """Unknown formats are rejected before any plan is built."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; expected one of {FORMATS}")
    return fmt


ON_CORRUPT = ("fail", "report")


def _struct(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def settled(df: DataFrame, on_corrupt: str, probe: str) -> DataFrame:
    """What happens to corrupt input: ``report`` leaves its text in the corrupt
    column (other columns NULL); ``fail`` raises when such a row is read and
    drops the column.  ``probe`` is a data column that the check reads too, as
    a scan of the corrupt column alone is not allowed."""
    if on_corrupt not in ON_CORRUPT:
        raise ValueError(f"on_corrupt must be one of {ON_CORRUPT}")
    if on_corrupt == "report":
        return df
    text = F.concat(F.lit("corrupt input record: "), F.substring(S.CORRUPT, 1, 200),
                    F.coalesce(F.col(probe).cast("string"), F.lit("")))
    # not deterministic, so that no later filter is evaluated before it: one on the
    # keys would drop the corrupt rows, which have none, without a word
    ok = F.when(F.col(S.CORRUPT).isNotNull(), F.raise_error(text).cast("boolean")) \
        .otherwise(F.spark_partition_id() >= 0)
    return df.filter(ok).drop(S.CORRUPT)


def scan_json(spark: SparkSession, path, schema: StructType | str | None = S.RAW_OBSERVATION,
              glob: str | None = None, on_corrupt: str = "fail",
              source_col: str | None = None) -> DataFrame:
    """Files holding one JSON array of objects.

    A file that is no array is corrupt as a whole: a truncated array, JSON Lines,
    a single object, or more behind the array's end.  ``on_corrupt`` "fail" raises
    when it is read; "report" gives one row for it, with the beginning of its text
    in the corrupt column.  A value of the wrong type is NULL.

    The array reader of the JSON source reads the first value of a file and stops
    without a word, so files are first checked at their ends (``broken_arrays``:
    one splittable text scan, eager).  Those that pass are parsed once, by that
    reader; files that do not are left out of it by their paths.  The reader
    streams a file's bytes and holds the rows of one file in a task, never its
    text; the list of broken files is the only thing that reaches the driver.
    """
    if schema is None:
        r = spark.read.option("multiLine", True).option("mode", "FAILFAST")
        return (r.option("pathGlobFilter", glob) if glob else r).json(path)
    fields = _struct(schema)
    broken = broken_arrays(spark, path, glob)
    # every field as a variant: the reader then marks syntax errors only, and a
    # value of the wrong type becomes NULL below.  (As strings, numbers would be
    # read a second time from the file, each by its place.)
    anything = StructType([*[T.StructField(f.name, T.VariantType()) for f in fields.fields],
                           T.StructField(S.CORRUPT, T.StringType())])
    r = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    df = (r.option("multiLine", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", S.CORRUPT).schema(anything).json(path))
    if broken:
        df = df.filter(~F.col("_metadata.file_path").isin(list(broken)))
    more = [F.col("_metadata.file_path").alias(source_col)] if source_col else []
    out = df.select(*[_typed(f).alias(f.name) for f in fields.fields], *more,
                    F.substring(S.CORRUPT, 1, 1000).alias(S.CORRUPT))
    if broken:
        rows = spark.createDataFrame(list(broken.items()), f"file string, {S.CORRUPT} string")
        out = out.unionByName(rows.withColumnRenamed("file", source_col) if source_col else rows.drop("file"),
                              allowMissingColumns=True)
    return settled(out, on_corrupt, fields.fields[0].name)


def _typed(field: T.StructField) -> Column:
    """A field read as a variant, in its own type (NULL where it is none)."""
    return F.try_variant_get(F.col(f"`{field.name}`"), "$", field.dataType.simpleString())


def broken_arrays(spark: SparkSession, path, glob: str | None = None) -> dict[str, str]:
    """Files that are no JSON array, with the beginning of their text.

    The text scan is cut at ``}`` instead of line ends, so a task never holds more
    than an object, whatever the file's size and however it is laid out, and large
    files are read by many tasks.  A file's first piece has to open an array and
    its last one to close it, by the pieces' order within the file's blocks.  A
    value behind a closing bracket is looked for outside of strings; as a piece
    can begin inside a string that holds a ``}``, files with such a piece are
    looked at whole before they are called broken.
    """
    r = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    blank = F.lit(" \t\r\n")
    pieces = (r.option("lineSep", "}").text(path)
              .select("value", F.col("_metadata.file_path").alias("file"),
                      F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("at")))
    value = F.col("value")
    ends = (pieces.filter(F.length(F.trim(value, F.lit(" \t\r\n\x0b\f"))) > 0)
            .groupBy("file", "block")
            .agg(F.min_by(F.startswith(F.ltrim(value, blank), F.lit("[")), "at").alias("opens"),
                 F.max_by(F.endswith(F.rtrim(value, blank), F.lit("]")), "at").alias("closes"),
                 F.bool_or(_more_behind(value)).alias("more"))
            .groupBy("file")
            .agg(F.min_by("opens", "block").alias("opens"), F.max_by("closes", "block").alias("closes"),
                 F.bool_or("more").alias("more"))
            .filter("NOT opens OR NOT closes OR more").collect())
    broken = [e["file"] for e in ends if not (e["opens"] and e["closes"])]
    doubtful = [e["file"] for e in ends if e["opens"] and e["closes"]]
    if doubtful:
        whole = r.text(path, wholetext=True).filter(F.col("_metadata.file_path").isin(doubtful))
        broken += [x["file"] for x in whole.filter(_more_behind(value))
                   .select(F.col("_metadata.file_path").alias("file")).collect()]
    if not broken:
        return {}
    order = F.struct("block", "at")
    heads = (pieces.filter(F.col("file").isin(broken) & value.rlike(r"\S"))
             .groupBy("file").agg(F.min_by(F.substring(value, 1, 1000), order).alias("head")))
    return {x["file"]: x["head"] for x in heads.collect()}


def _more_behind(text: Column) -> Column:
    """A ``]`` with another value behind it, outside of strings."""
    behind = r"\]\s*[\[{\"0-9a-z-]"
    bare = F.regexp_replace(F.regexp_replace(text, r"\\.", ""), '"[^"]*"', '"')
    # most pieces have no bracket, and a byte search is cheaper than a pattern
    return F.when(F.contains(text, F.lit("]")) & text.rlike(behind), bare.rlike(behind)).otherwise(F.lit(False))


def scan_jsonl(spark: SparkSession, path, schema: StructType | str | None = S.RAW_OBSERVATION,
               glob: str | None = None, on_corrupt: str = "fail",
               source_col: str | None = None) -> DataFrame:
    """JSON Lines (one object per line; splittable, the format to land at
    scale).  A line that is no object of the schema is corrupt: ``on_corrupt``
    as in ``scan_json`` (the lines of an array file are corrupt here)."""
    r = spark.read.option("multiLine", False)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if schema is None:
        return r.option("mode", "FAILFAST").json(path)
    fields = _struct(schema)
    both = StructType([*fields.fields, T.StructField(S.CORRUPT, T.StringType())])
    df = (r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", S.CORRUPT)
           .schema(both).json(path))
    if source_col:
        df = df.withColumn(source_col, F.col("_metadata.file_path"))
    return settled(df, on_corrupt, fields.fields[0].name)


def scan_csv(spark: SparkSession, path, schema: StructType | str | None = None,
             header: bool = True, glob: str | None = None, on_corrupt: str = "fail",
             source_col: str | None = None) -> DataFrame:
    """S3: CSV with a header line (schema given, or inferred when None).

    With a schema, columns are taken by their header name, whatever their order;
    missing ones are NULL, values that do not parse are NULL.  A struct field
    ``geom`` comes from the flat columns ``geom_lat``, ``geom_lon``.  All files
    must share one header; a line with another number of fields is corrupt
    (``on_corrupt`` as in ``scan_json``).
    """
    r = spark.read.option("header", header)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if schema is None:
        return r.option("inferSchema", True).csv(path)
    fields = _struct(schema)
    names = r.csv(path).columns if header else [f.name for f in fields.fields]   # reads one header
    text = StructType([*[T.StructField(n, T.StringType()) for n in names],
                       T.StructField(S.CORRUPT, T.StringType())])
    df = (r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", S.CORRUPT)
           .option("enforceSchema", not header).schema(text).csv(path))

    def column(name: str, kind) -> Column:
        if isinstance(kind, StructType):
            return F.struct(*[column(f"{name}_{f.name}", f.dataType).alias(f.name) for f in kind.fields])
        return (F.col(f"`{name}`").try_cast(kind) if name in names else F.lit(None).cast(kind))

    cols = [column(f.name, f.dataType).alias(f.name) for f in fields.fields]
    more = [F.col("_metadata.file_path").alias(source_col)] if source_col else []
    return settled(df.select(*cols, *more, S.CORRUPT), on_corrupt, fields.fields[0].name)


def scan_parquet(spark: SparkSession, path,
                 string_partitions: Sequence[str] = ()) -> DataFrame:
    """Parquet (schema, statistics and partition columns from the files).

    ``string_partitions`` names Hive partition columns that must come back
    as strings whatever the session's partition type inference says
    (``01`` or ``2A`` are codes, not numbers): the table is read with an
    explicit schema in which they are strings.
    """
    df = spark.read.parquet(path)
    if not set(string_partitions) & set(df.columns):
        return df
    fields = [T.StructField(f.name, T.StringType(), True) if f.name in string_partitions
              else f for f in df.schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def read_table(spark: SparkSession, path, fmt: str = "json",
               schema: StructType | str | None = S.RAW_OBSERVATION, glob: str | None = None,
               on_corrupt: str = "fail", source_col: str | None = None) -> DataFrame:
    """S1-S5 behind one entry point."""
    check_format(fmt)
    if fmt == "parquet":
        df = scan_parquet(spark, path)
        return df.withColumn(source_col, F.col("_metadata.file_path")) if source_col else df
    scan = {"json": scan_json, "jsonl": scan_jsonl, "csv": scan_csv}[fmt]
    return scan(spark, path, schema, glob=glob, on_corrupt=on_corrupt, source_col=source_col)


def snapshot_glob(fmt: str) -> str:
    """File names of daily snapshots in a format."""
    return S.SNAPSHOT_STEM + {"json": ".json", "jsonl": ".json*", "csv": ".csv",
                              "parquet": ".parquet"}[check_format(fmt)]


def scan_snapshots(spark: SparkSession, root: str,
                   schema: StructType | str | None = S.RAW_OBSERVATION,
                   glob: str | None = None, fmt: str = "json",
                   source_col: str | None = "source_file", on_corrupt: str = "fail") -> DataFrame:
    """Every daily snapshot under ``root`` in one scan, in any format.

    The glob (default ``*_YYYY-MM-DD`` with the format's ending) never matches
    the metadata sidecars in the same folder; the source file of each row comes
    from the hidden ``_metadata`` column and is never a pivot key.
    """
    return read_table(spark, root, check_format(fmt), schema, glob=glob or snapshot_glob(fmt),
                      on_corrupt=on_corrupt, source_col=source_col)


def write_table(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, cluster_by: Sequence[str] = (),
                max_records_per_file: int | None = 5_000_000, rebalance: bool = True,
                compression: str | None = None,
                observation: Observation | None = None, metrics: Sequence[Column] = ()) -> None:
    """Write with a save mode and optional Hive partitioning.

    Before a partitioned write the rows are rebalanced on the partition
    keys (a REBALANCE hint: AQE splits a key that holds a large share of the
    rows over several tasks and merges small ones), so each partition
    folder gets a few large files rather than one file per task, and no
    single task writes a whole hot partition.  ``rebalance=False`` is for rows that
    an earlier exchange has dealt out by the partition keys.

    ``compression`` is the files' codec (default: the session's).  A compressed text
    file is read by one task, so ``max_records_per_file`` bounds it.

    ``cluster_by`` sorts the rows of each file by these columns, so that the
    row groups' statistics (and their sizes on disk) shrink and a filter on them
    skips row groups.  ``metrics`` are aggregates that ``observation`` collects
    from the rows on their way into the files, in the writing tasks themselves.
    """
    check_format(fmt)
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    if metrics:
        df = df.observe(observation, *metrics)
    if cluster_by:
        df = df.sortWithinPartitions(*(partition_by or ()), *cluster_by)
    w = df.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    if fmt == "parquet":
        w.parquet(path)
    elif fmt in ("json", "jsonl"):
        w.json(path)
    else:
        w.option("header", True).csv(path)


def write_marts(marts: dict, base: str, *, fmt: str = "parquet", mode: str = "overwrite") -> dict:
    """Write each mart to ``{base}/{name}``; returns name -> path."""
    paths = {}
    for name, mdf in marts.items():
        path = f"{base.rstrip('/')}/{name}"
        write_table(mdf, path, fmt=fmt, mode=mode)
        paths[name] = path
    return paths


#: Partition columns of the detailed table, codes that stay text (01, 2A).
DETAILED_PARTITIONS = ("region_code", "departement")


def load_mart(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One mart by its exact folder (``by_departement`` never picks up
    ``by_departement_date``); partition codes come back as strings in any session."""
    return scan_parquet(spark, f"{base.rstrip('/')}/{name}/", string_partitions=DETAILED_PARTITIONS)


def load_detailed(spark: SparkSession, base: str) -> DataFrame:
    """The detailed table below ``base``."""
    return load_mart(spark, base, "detailed")


def load_all_marts(spark: SparkSession, base: str,
                   names: Sequence[str] = ("by_region", "by_departement", "by_date",
                                           "most_expensive", "least_expensive")) -> dict:
    """The dashboard's marts as a dict (lazy scans)."""
    return {n: load_mart(spark, base, n) for n in names}


def export_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """CSV export with a header line."""
    write_table(df, path, fmt="csv", mode=mode)


def input_bytes(spark: SparkSession, path: str, glob: str | None = None) -> int:
    """Total size of the files under ``path`` (matching ``glob``).

    A distributed listing through the ``binaryFile`` source that reads only
    the ``length`` column, so file contents are never loaded.
    """
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    total = r.load(path).select("length").agg(F.sum("length")).first()[0]
    return int(total or 0)
