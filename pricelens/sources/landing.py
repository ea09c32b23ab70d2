"""Landing-side helpers (S12, S13) and the JSON-array snapshot writer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.columns import pad_code


def landing_enrich(df: DataFrame, ingestion_ts: str, *, postal: str = "cp",
                   width: int = 5, out_ts: str = "ingestion_timestamp") -> DataFrame:
    """Stamp the ingestion time (fixed per run) and zero-pad the
    postal code."""
    out = df.withColumn(out_ts, F.lit(ingestion_ts))
    if postal in out.columns:
        out = out.withColumn(postal, pad_code(postal, width))
    return out


def ingest_audit(df: DataFrame, *, dataset_name: str, source_url: str,
                 ingestion_ts: str, ingestion_date: str | None = None,
                 with_size: bool = True, size_of: Column | None = None) -> DataFrame:
    """One audit row for a landed batch.

    ``record_count`` and the approximate size (MiB of the rows as JSON text)
    come from one aggregate; the landed rows never leave the executors.
    ``size_of`` is another measure of a row's size in bytes.  For a
    scan with the corrupt column ``corrupt_count`` counts corrupt records and
    files (they are part of ``record_count``).
    """
    aggs = [F.count(F.lit(1)).alias("record_count")]
    if S.CORRUPT in df.columns:
        aggs.append(F.count(S.CORRUPT).alias("corrupt_count"))
    if with_size:
        size = F.length(F.to_json(F.struct(*df.columns))) if size_of is None else size_of
        aggs.append((F.sum(size) / (1024.0 * 1024.0)).alias("file_size_mb"))
    out = df.agg(*aggs)
    return out.select(
        F.lit(dataset_name).alias("dataset_name"),
        F.lit(ingestion_ts).alias("ingestion_timestamp"),
        F.lit(ingestion_date or ingestion_ts[:10]).alias("ingestion_date"),
        F.lit(source_url).alias("source_url"),
        "record_count",
        *(["corrupt_count"] if S.CORRUPT in df.columns else []),
        *(["file_size_mb"] if with_size else []))


def write_json_array(df: DataFrame, path: str, rows_per_file: int = 50_000,
                     compression: str | None = None) -> None:
    """Write the rows as files of one JSON array of objects each (the landed
    snapshot format read by ``scan_json``), at most ``rows_per_file`` rows in an
    array.  Files end in ``.txt``, and the codec's ending (``.gz``) with
    ``compression``.

    Each row is a line of its file, the writer begins a new file after
    ``rows_per_file`` of them: no array is ever held, and no row is shuffled.  A
    task's lines get their brackets and commas on the way; the last one of the task
    is known one line later.
    """
    def lines(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        def put(rows, at, last):
            n = len(rows)
            if not n:
                return at
            # places in their arrays, which begin anew in each file
            place = [(at + i) % rows_per_file for i in range(n)]
            head = pa.array(["[" if p == 0 else "" for p in place], pa.string())
            tail = ["]" if p == rows_per_file - 1 else "," for p in place]
            if last:
                tail[-1] = "]"
            out.append(pa.RecordBatch.from_arrays(
                [pc.binary_join_element_wise(head, rows, pa.array(tail, pa.string()), "")], ["value"]))
            return at + n

        out, at, held = [], 0, None
        for b in batches:
            if not b.num_rows:
                continue
            rows = b.column(0).cast(pa.string())
            if held is not None:
                at = put(held, at, False)
            at = put(rows.slice(0, len(rows) - 1), at, False)
            held = rows.slice(len(rows) - 1)
            yield from out
            out.clear()
        if held is not None:
            put(held, at, True)
        yield from out

    rows = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))
    w = rows.mapInArrow(lines, "value string").write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file)
    (w.option("compression", compression) if compression else w).text(path)
