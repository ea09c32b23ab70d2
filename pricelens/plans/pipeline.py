"""End-to-end plans (E1-E3) and the batch job entry point.

E1 ``detailed_table``: clean -> pivot -> features -> IQR flags -> stamp.
E2 ``build_marts``: the eight marts, computed from the *written* detailed
   table (re-read), so the long->wide shuffle and the feature windows run
   once, and lineage is cut at a durable table: a lost executor costs a
   re-read of Parquet, not a recomputation from raw JSON.
E3 ``map_slice``: department x date mart -> one year -> long -> optional
   region roll-up -> one product -> latest date -> KPIs, scale, bands.
"""

from __future__ import annotations

import argparse
import logging
from datetime import datetime
from typing import NamedTuple, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import anomaly, clean, dashboard, features, marts, reshape, select
from ..functions.columns import normalized_name
from ..functions.sizing import brief_shuffles, discard, materialize
from ..operators.mapdata import choropleth_bands, choropleth_table
from ..sources import files

log = logging.getLogger(__name__)

DETAILED_PARTITIONS = files.DETAILED_PARTITIONS


def build_wide(long_df: DataFrame, *, raw_products: Sequence[str] | None,
               order: Sequence[str] | None = None,
               keys: Sequence[str] | None = None, materialized: bool = True,
               change: str | None = None, entity: str = "id",
               date: str = "prix_maj_date") -> DataFrame:
    """E1, first half: long -> wide (R1), materialised.

    The wide table is written as Parquet under ``spark.checkpoint.dir``
    before it fans out to the group means, the lag window and the quantile
    pass: the long -> wide shuffle runs once and a lost executor re-reads
    the table instead of re-parsing raw files.

    With ``change``, one of the products, the table also has its change since last
    (F7): rows are dealt out by entity and range of days (``date`` is a date or moment)
    once, for the pivot and for the change behind it.
    """
    if change is None:
        wide = reshape.pivot_wide(long_df, raw_products, order=order, keys=keys)
        return materialize(wide, "wide") if materialized else wide
    keys, order = reshape.wide_keys(long_df, order=order, keys=keys)
    dealt = features.range_key(entity, date, dict(long_df.dtypes)[date])
    # in the order of the window, so that the aggregate's sort is also the window's
    rest = [c for c in keys if c not in (entity, date)]
    wide = reshape.pivot_wide(long_df, raw_products, order=order, keys=[entity, date, *rest], dealt=dealt)
    wide = features.lag_change(wide, change, entity=entity, order=(date,), tiebreak=rest, dealt=reshape.DEALT)
    wide = wide.select(*keys, *[c for c in wide.columns if c not in keys])
    return materialize(wide, "wide", compression="zstd") if materialized else wide


def detailed_from_wide(wide: DataFrame, *, products: Sequence[str],
                       flagged: Sequence[str] = S.FLAGGED_PRODUCTS, entity: str = "id",
                       group: Sequence[str] = ("region_code",), date: str = "prix_maj_date",
                       quantiles: str = "exact", run_ts: str | None = None,
                       run_date: str | None = None, once: bool = False,
                       changed: bool = False, deal_by: Sequence[str] = ()) -> DataFrame:
    """E1, second half: features (F1-F7), IQR flags (A1-A3), stamp (P10).
    ``wide`` is read several times: a written table (else ``once=True``).  ``changed``:
    it has the change since last.  With ``deal_by`` its rows are dealt out by these
    columns for a partitioned write, as ``write_table`` does, but while they are narrow."""
    products = [p for p in products if p in wide.columns]
    wide_keys = [c for c in wide.columns if c not in products]
    tiebreak = [c for c in wide_keys if c not in (entity, date)]
    rows = wide.hint("rebalance", *deal_by) if deal_by else wide
    out = features.add_features(rows, products, flagged=flagged, group=group,
                                entity=entity, date=date, tiebreak=tiebreak, once=once,
                                means_from=wide if deal_by else None, changed=changed)
    out = anomaly.detect_anomalies(out, products, method=quantiles, bounds_from=wide)
    return clean.stamp_processing(out, run_ts=run_ts, run_date=run_date)


def detailed_table(long_df: DataFrame, *, raw_products: Sequence[str] | None = None,
                   products: Sequence[str] | None = None,
                   flagged: Sequence[str] = S.FLAGGED_PRODUCTS,
                   order: Sequence[str] | None = None,
                   keys: Sequence[str] | None = None, entity: str = "id",
                   group: Sequence[str] = ("region_code",), date: str = "prix_maj_date",
                   quantiles: str = "exact", run_ts: str | None = None,
                   run_date: str | None = None, checkpoint: bool = True) -> DataFrame:
    """E1 on an already-cleaned long table: ``build_wide`` then
    ``detailed_from_wide``.  Without ``raw_products`` every product name that
    occurs becomes a column."""
    if raw_products is None:
        raw_products = reshape.product_names(long_df)
    wide = build_wide(long_df, raw_products=raw_products, order=order, keys=keys,
                      materialized=checkpoint)
    products = list(products or dict.fromkeys(normalized_name(n) for n in raw_products))
    return detailed_from_wide(wide, products=products, flagged=flagged, entity=entity,
                              group=group, date=date, quantiles=quantiles, run_ts=run_ts,
                              run_date=run_date, once=not checkpoint)


class Detailed(NamedTuple):
    """What ``run_detailed`` wrote, and the statistics of its two writes."""
    path: str
    report: dict                       # P9
    summary: dict                      # G7
    outliers: dict                     # A4: flagged rows by product, and "any"


def run_detailed(spark: SparkSession, raw_path: str, out_base: str, **options) -> str:
    """``detailed_job``; returns the detailed table's path."""
    return detailed_job(spark, raw_path, out_base, **options).path


def detailed_job(spark: SparkSession, raw_path: str, out_base: str, *, fmt: str = "json",
                 raw_products: Sequence[str] | None = None,
                 products: Sequence[str] | None = None,
                 flagged: Sequence[str] = S.FLAGGED_PRODUCTS,
                 price_range: tuple = (0.0, 5.0), run_ts: str | None = None,
                 run_date: str | None = None, glob: str | None = None, quantiles: str = "exact",
                 max_corrupt: int = 0, schema=S.RAW_OBSERVATION) -> Detailed:
    """E1 with I/O: landed snapshots -> detailed Parquet partitioned by
    region and department.

    Raw text is parsed once: the landed rows are written, and the list of products
    and the pivot read that.  The clean report (P9) is observed in this write, the
    outlier counts (A4) and the run summary (G7) in that of the detailed table, so
    none of them scans anything.  Corrupt records and files are counted; more than
    ``max_corrupt`` of them fail the job before anything is written to
    ``out_base``, and the report is logged in any case.  With ``raw_products`` only
    those become columns, and rows of other products are counted and logged;
    without it all do.  ``quantiles`` "approx" takes the sketch.  Rows are sorted by
    date in each file, so that a filter on it skips row groups.  The job's own
    intermediate tables and shuffle files are deleted as soon as no step reads them.
    """
    files.check_format(fmt)
    with brief_shuffles(spark):
        return _detailed_job(spark, raw_path, out_base, fmt, raw_products, products, flagged, price_range,
                             run_ts, run_date, glob, quantiles, max_corrupt, schema)


def _detailed_job(spark, raw_path, out_base, fmt, raw_products, products, flagged, price_range,
                  run_ts, run_date, glob, quantiles, max_corrupt, schema) -> Detailed:
    """``detailed_job`` in a session that keeps no shuffle files."""
    raw = files.scan_snapshots(spark, raw_path, schema, fmt=fmt, source_col=None, glob=glob,
                               on_corrupt="report")
    if S.CORRUPT not in raw.columns:          # Parquet has no corrupt records
        raw = raw.withColumn(S.CORRUPT, F.lit(None).cast("string"))
    seen = Observation("clean")
    landed = materialize(raw, "landed", seen, clean.clean_metrics(raw), compression="zstd")
    report = seen.get
    report["rows_removed"], report["removed_pct"] = clean.removed(report["rows_in"], report["rows_out"])
    log.info("clean report: %s", report)
    if report["rows_corrupt"] > max_corrupt:
        raise ValueError(f"{report['rows_corrupt']} corrupt records or files in {raw_path} "
                         f"(at most {max_corrupt} admitted): {report}")
    long_df = clean.clean_observations(landed.drop(S.CORRUPT), low=price_range[0], high=price_range[1])
    if raw_products is not None:
        left_out = reshape.unlisted_products(long_df, raw_products).orderBy(F.desc("rows")).limit(20)
        for r in left_out.collect():
            log.warning("product %r is not listed: %d rows have no column", r["name"], r["rows"])
    else:
        raw_products = reshape.product_names(long_df)
    pivoted = list(dict.fromkeys(normalized_name(n) for n in raw_products))
    products = list(products or pivoted)
    change = flagged[0] if flagged and flagged[0] in products and flagged[0] in pivoted else None
    if "prix_maj_date" not in long_df.columns:
        change = None
    wide = build_wide(long_df, raw_products=raw_products, change=change)
    discard(landed)
    detailed = detailed_from_wide(wide, products=products, flagged=flagged, quantiles=quantiles,
                                  run_ts=run_ts or datetime.now().isoformat(), run_date=run_date,
                                  changed=change is not None, deal_by=DETAILED_PARTITIONS)
    path = f"{out_base.rstrip('/')}/detailed"
    written, outliers = Observation("detailed"), anomaly.outlier_metrics(detailed)
    metrics = [*marts.summary_metrics(detailed), *[c.alias(f"outliers {n}") for n, c in outliers.items()]]
    files.write_table(detailed, path, partition_by=list(DETAILED_PARTITIONS), cluster_by=["prix_maj_date"],
                      rebalance=False, observation=written, metrics=metrics)
    found = written.get
    counts = {n: found.pop(f"outliers {n}") for n in outliers}
    log.info("run summary: %s; outliers: %s", found, counts)
    discard(wide)
    return Detailed(path, report, found, counts)


def run_marts(spark: SparkSession, detailed_path: str, out_base: str, *,
              products: Sequence[str] | None = None, extra_cols: Sequence[str] = ("ville",),
              headline: str | None = None) -> dict:
    """E2 with I/O: re-read the detailed table, write the eight marts.  Products
    default to those the detailed table has (their region means name them)."""
    detailed = files.scan_parquet(spark, detailed_path,
                                  string_partitions=DETAILED_PARTITIONS)
    if products is None:
        products = [c[:-len("_moy_region")] for c in detailed.columns if c.endswith("_moy_region")]
    extra = [c for c in extra_cols if c in detailed.columns]
    if headline is None and S.FLAGGED_PRODUCTS[0] in products:
        headline = S.FLAGGED_PRODUCTS[0]
    mdict = marts.build_marts(detailed, products, extra_cols=extra, headline=headline,
                              tiebreak=[c for c in ("id", "prix_maj_date") if c in detailed.columns])
    return files.write_marts(mdict, f"{out_base.rstrip('/')}/aggregations")


def map_slice(dept_date: DataFrame, products: Sequence[str], *, year: int | None,
              product_label: str, level: str = "department",
              areas: DataFrame | None = None, labels: dict | None = None,
              mapping: DataFrame | None = None) -> dict:
    """The map's tables from the department x date mart.

    Returns ``{"slice", "kpi", "scale", "table"}``; ``table`` (needs
    ``areas``) lists every area with its band on the p05-p95 scale.
    """
    df = select.filter_year(dept_date, year, date="date") if year else dept_date
    long = dashboard.mart_long(df, products, ids=["departement", "nombre_stations", "date"],
                               labels=labels)
    code = "departement"
    if level == "region":
        long = dashboard.rollup_region(long, mapping=mapping)
        code = "region"
    # the answer is as small as the areas, its source is the whole mart: the
    # slice's product is written once, and the latest slice again
    one = select.filter_product(long, product_label)
    latest = materialize(select.latest_slice(one, product="fuel_type", date="date"), "map-slice")
    scale = dashboard.price_scale(latest)
    out = {"slice": latest, "kpi": dashboard.kpi_cards(latest), "scale": scale}
    if areas is not None:
        out["table"] = choropleth_bands(choropleth_table(areas, latest, code=code), scale)
    return out


def main(argv=None) -> int:
    from ..session import build_session, shuffle_partitions_for

    ap = argparse.ArgumentParser(description="landed snapshots -> detailed table + marts")
    ap.add_argument("raw_path")
    ap.add_argument("out_base")
    ap.add_argument("--format", default="json", choices=files.FORMATS)
    ap.add_argument("--shuffle-partitions", type=int, default=None)
    ap.add_argument("--glob", default=None, help="snapshot file name pattern")
    ap.add_argument("--quantiles", default="approx", choices=("approx", "exact"),
                    help="IQR bounds from a one-pass sketch or exact")
    ap.add_argument("--max-corrupt", type=int, default=0,
                    help="corrupt records or files to tolerate")
    ap.add_argument("--products", nargs="*", default=None,
                    help="product names to keep (default: all that occur)")
    ap.add_argument("--price-range", type=float, nargs=2, default=(0.0, 5.0))
    args = ap.parse_args(argv)
    spark = build_session("pricelens-transform", shuffle_partitions=args.shuffle_partitions)
    try:
        if args.shuffle_partitions is None:
            # size the shuffles from the landed input instead of a fixed default
            glob = args.glob or files.snapshot_glob(args.format)
            nbytes = files.input_bytes(spark, args.raw_path, glob)
            parts = shuffle_partitions_for(nbytes, spark.sparkContext.defaultParallelism)
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        detailed = detailed_job(spark, args.raw_path, args.out_base, fmt=args.format,
                                glob=args.glob, price_range=tuple(args.price_range),
                                quantiles=args.quantiles, max_corrupt=args.max_corrupt,
                                raw_products=args.products or None)
        run_marts(spark, detailed.path, args.out_base)
        print(f"run summary: {detailed.summary}")
        return 0
    except Exception:  # noqa: BLE001
        log.exception("transform failed")
        return 1


if __name__ == "__main__":
    raise SystemExit(main())
