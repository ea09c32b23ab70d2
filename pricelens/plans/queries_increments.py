"""Increments against full builds: the tables after merging cuts of the long table
in odd order and repeatedly, and after removals; the four formats behind the guard;
statistics observed in the job's writes; a set of marts published at once."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import files, published
from . import bindings as B
from . import incremental
from .catalog import register
from .queries_io import LONG_COLS, LONG_SCHEMA
from .queries_job import _FLAGS, _JOB_SQL, MART_KEYS, _land, marts_long, marts_long_sql
from .queries_pipeline import HI, LO, RUN_DATE, RUN_TS
from ..operators import marts
from . import pipeline

P = B.PRODUCTS
LAYOUT = incremental.Layout(keys=B.WIDE_KEYS, order=B.ORDER, products=B.RAW_PRODUCTS, headline=B.HEADLINE)

_JOB_HEAD, _JOB_FROM = _JOB_SQL.rpartition("\nSELECT ")[0], "feat f CROSS JOIN bounds b"
_JOB_FLAGS = ", ".join(f"{x} AS is_outlier_{p}" for p, x in zip(P, _FLAGS)) + f", ({' OR '.join(_FLAGS)}) AS has_any_anomaly"


def _fresh(spark, name):
    return scratch_path(spark, f"roundtrip/{name}-{uuid.uuid4().hex}")


def _merged(spark, sf):
    """All rows in three cuts: the last third first, the first one twice."""
    base, long = _fresh(spark, "increments"), B.obs_long(spark, sf)
    for cut in (2, 0, 1, 0):
        incremental.merge(spark, base, long.filter(F.col("l_orderkey") % 3 == cut), LAYOUT)
    return base


@register("incremental_wide", f"WITH {B.OBS_WIDE_SQL} SELECT * FROM obs_wide", doubles=list(P))
def q_incremental_wide(spark, sf):
    return incremental.wide(spark, _merged(spark, sf), LAYOUT)


@register("incremental_marts", f"WITH {B.OBS_WIDE_SQL} {marts_long_sql()}", doubles=["value"])
def q_incremental_marts(spark, sf):
    return marts_long(incremental.mart_tables(spark, _merged(spark, sf), LAYOUT))


_LEFT = f"WITH {B.OBS_WIDE_SQL}, rest AS (SELECT * FROM obs_wide WHERE id % 7 <> 0)"


@register("incremental_removed", f"{_LEFT} {marts_long_sql('rest')}", doubles=["value"])
def q_incremental_removed(spark, sf):
    """Every seventh entity is taken out again, listed ones among them."""
    base, long = _merged(spark, sf), B.obs_long(spark, sf)
    gone = long.filter("id % 7 = 0").select("id", "prix_maj_date").distinct()
    incremental.remove(spark, base, gone, LAYOUT)
    return marts_long(incremental.mart_tables(spark, base, LAYOUT))


@register("published_marts", f"WITH {B.OBS_WIDE_SQL} {marts_long_sql()}", doubles=["value"])
def q_published_marts(spark, sf):
    base = _fresh(spark, "published")
    built = marts.build_marts(B.obs_wide(spark, sf), P, headline=B.HEADLINE, tiebreak=["id", "prix_maj_date"])
    published.publish_marts(spark, built, base)
    return marts_long({m: published.load_published(spark, base, m) for m in MART_KEYS})


@register("job_statistics", f"""{_JOB_HEAD}, t AS (SELECT region_code, departement, annee, {_JOB_FLAGS}
  FROM {_JOB_FROM})
SELECT 'report rows_in' AS name, CAST((SELECT count(*) FROM raw) AS DOUBLE) AS value
UNION ALL SELECT 'report rows_out', CAST((SELECT count(*) FROM raw) AS DOUBLE)
UNION ALL SELECT 'report rows_corrupt', 0 UNION ALL SELECT 'report rows_removed', 0
UNION ALL SELECT 'report removed_pct', 0
UNION ALL SELECT 'summary total_rows', count(*) FROM t
UNION ALL SELECT 'summary n_regions', count(DISTINCT region_code) FROM t
UNION ALL SELECT 'summary n_departements', count(DISTINCT departement) FROM t
UNION ALL SELECT 'summary first_year', min(annee) FROM t UNION ALL SELECT 'summary last_year', max(annee) FROM t
UNION ALL SELECT 'summary n_years', count(DISTINCT annee) FROM t
UNION ALL SELECT 'summary n_anomalies', count(*) FILTER (has_any_anomaly) FROM t
UNION ALL SELECT 'outliers any', count(*) FILTER (has_any_anomaly) FROM t
{" ".join(f"UNION ALL SELECT 'outliers {p}', count(*) FILTER (is_outlier_{p}) FROM t" for p in P)}""",
          doubles=["value"])
def q_job_statistics(spark, sf):
    """P9, A4 and G7 of the landed job, as observed in its two writes."""
    base = _land(spark, sf, "job")
    got = pipeline.detailed_job(spark, f"{base}/raw", f"{base}/out", fmt="jsonl", glob="part-*", products=P,
                                flagged=B.FLAGGED, price_range=(LO, HI), run_ts=RUN_TS, run_date=RUN_DATE)
    rows = [(f"{k} {n}", float(v)) for k in ("report", "summary", "outliers") for n, v in getattr(got, k).items()]
    return spark.createDataFrame(rows, "name string, value double")


_FORMATS = " UNION ALL ".join(f"SELECT '{f}' AS format, {str(f != 'xml').lower()} AS accepted, "
                              + ("count(*) AS n_rows, sum(prix_valeur) AS total FROM obs_long" if f != "xml"
                                 else "CAST(0 AS BIGINT) AS n_rows, CAST(0 AS DOUBLE) AS total")
                              for f in (*files.FORMATS, "xml"))


@register("format_guard", f"WITH {B.OBS_LONG_SQL} {_FORMATS}", doubles=["total"], digits=2)
def q_format_guard(spark, sf):
    """The long table in every format through one entry point; an unknown one
    is refused before a plan is built."""
    from ..sources import landing

    # the Parquet table first: joined once, and the other formats are written from it;
    # text is written compressed, in files that one task reads
    source, parts = B.obs_long(spark, sf).select(*LONG_COLS), {}
    for fmt in sorted((*files.FORMATS, "xml"), key="parquet".__ne__):
        path, small = _fresh(spark, f"format-{fmt}"), fmt in ("jsonl", "csv")
        try:
            if fmt == "json":
                landing.write_json_array(source, path, compression="gzip")
            else:
                files.write_table(source, path, fmt=fmt, compression="gzip" if small else None,
                                  max_records_per_file=500_000 if small else 5_000_000)
            back = files.read_table(spark, path, fmt, LONG_SCHEMA, glob="part-*.txt.gz" if fmt == "json" else None)
        except ValueError:
            parts[fmt] = spark.sql(f"SELECT '{fmt}' AS format, false AS accepted, 0L AS n_rows, 0D AS total")
            continue
        source = back if fmt == "parquet" else source
        parts[fmt] = (back.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("prix_valeur").alias("total"))
                      .select(F.lit(fmt).alias("format"), F.lit(True).alias("accepted"), "n_rows", "total"))
    return reduce(lambda a, b: a.unionByName(b), [parts[fmt] for fmt in (*files.FORMATS, "xml")])
