"""Wide table, marts and rankings kept up to date by increments.

The published job reads every daily snapshot again on each run.  Here a new
snapshot is merged into what is there, and only the periods (months of the
observation date) that it has rows in are read and written:

* ``latest``: one row for each key tuple of the wide table; for each product the
  greatest (order tuple, value) seen.  Merging takes the greater one, so snapshots
  may come repeatedly, in any order and in any cut;
* ``fine``: the marts' state (count, sum, minimum, maximum, squared deviations at
  department, region, date, year) of the period's wide rows.  States of different
  periods add up, so the marts are rolled up from all of them;
* ``most``, ``least``: the n first rows of each region in the period.  The lists of
  all periods hold the n first of all.

A period's state and lists are computed from its rewritten rows, so a value that
was replaced or removed leaves sums, extremes and rankings exactly.  All four are
published by one manifest (``sources.published``): readers see a whole increment or
none of it.  What an increment costs is its own size and that of the periods it
touches, whatever lies before them.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import normalized, normalized_name
from ..functions.sizing import discard, materialize
from ..operators import marts, ranking, reshape
from ..sources import published as pub

PERIOD = "period"
TABLES = ("latest", "fine", "most", "least")
#: An increment with rows in more periods than this is no increment of months.
MAX_PERIODS = 10_000
#: Rows of one period that a task merges and writes.
SLOT_ROWS = 250_000


class Layout(NamedTuple):
    """Columns of the tables.  ``keys`` of the wide table must hold ``date``,
    ``entity``, ``department``, ``region`` and, if there is one, ``year``."""
    keys: tuple
    order: tuple
    products: tuple                    # raw names
    headline: str
    name: str = "prix_nom"
    value: str = "prix_valeur"
    entity: str = "id"
    date: str = "prix_maj_date"
    department: str = "departement"
    region: str = "region_code"
    year: str = "annee"
    extra: tuple = ()                  # further columns of the rankings
    top_n: int = 10

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys(normalized_name(p) for p in self.products))

    @property
    def listed(self) -> list[str]:
        """Columns of ``most`` and ``least``."""
        return [self.entity, *self.extra, self.department, self.region, self.headline]


def observed(long_df: DataFrame, layout: Layout) -> DataFrame:
    """Of each long row its keys, its period, its product and (order tuple, value)."""
    by = reshape.latest_order(long_df, layout.order)
    best = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(by)], F.col(layout.value).alias("v"))
    period = F.coalesce(F.date_format(layout.date, "yyyy-MM"), F.lit("none"))
    return long_df.select(*layout.keys, period.alias(PERIOD), normalized(layout.name).alias("__name"),
                          F.when(F.col(layout.value).isNotNull(), best).alias("__best"))


def _lifted(rows: DataFrame, layout: Layout) -> DataFrame:
    """``observed`` rows with the columns of ``latest``: a row for each, its own
    product's column alone filled."""
    return rows.select(*layout.keys, PERIOD, *[F.when(F.col("__name") == p, F.col("__best")).alias(p)
                                               for p in layout.columns])


def wide_of(state: DataFrame, layout: Layout) -> DataFrame:
    """The wide rows (R1) of ``latest`` rows."""
    return state.select(*layout.keys, PERIOD, *[F.col(p)["v"].alias(p) for p in layout.columns])


def _periods(df: DataFrame) -> set[str]:
    found = {r[0] for r in df.select(PERIOD).distinct().limit(MAX_PERIODS + 1).collect()}
    if len(found) > MAX_PERIODS:
        raise ValueError(f"an increment with rows in more than {MAX_PERIODS} periods")
    return found


def _rewrite(spark: SparkSession, base: str, since: int, touched: set[str], state: DataFrame,
             layout: Layout, dealt: bool = False) -> int:
    """Write the touched periods of all four tables and publish them together.
    ``dealt``: the rows of ``state`` lie by period already."""
    folder = pub.new_folder()
    entries = {"latest": pub.write(state, base, f"{folder}/latest", partition_by=[PERIOD],
                                   cluster_by=[layout.date], rebalance=not dealt)}
    wide = wide_of(pub.load(spark, base, entries["latest"]), layout)
    grain = [c for c in (layout.department, layout.region, layout.date, layout.year) if c in layout.keys]
    entries["fine"] = pub.write(marts.fine_state(wide, layout.columns, [PERIOD, *grain]), base,
                                f"{folder}/fine", partition_by=[PERIOD])
    for table, rank in (("most", ranking.top_n_per_group), ("least", ranking.bottom_n_per_group)):
        rows = rank(wide, group=[PERIOD, layout.region], value=layout.headline, n=layout.top_n,
                    tiebreak=_tiebreak(layout)).select(PERIOD, *dict.fromkeys([*layout.listed, *_tiebreak(layout)]))
        entries[table] = pub.write(rows, base, f"{folder}/{table}", partition_by=[PERIOD])
    named = {f"{table}/{p}": e for table, e in entries.items() for p in touched}
    return pub.publish(spark, base, named, since)


def _tiebreak(layout: Layout) -> list[str]:
    """The row's key: a total order of rows with one value."""
    return list(dict.fromkeys([layout.entity, layout.date, *layout.keys]))


def _greater(both: DataFrame, layout: Layout) -> DataFrame:
    """The greater state of each key, dealt out by period and by slots of at most
    about ``SLOT_ROWS`` rows of it: one exchange serves the aggregate and the write,
    and its one sort, period and date first, serves both as well."""
    largest = both.groupBy(PERIOD).count().agg(F.max("count")).first()[0] or 0
    slot = F.pmod(F.xxhash64(*layout.keys), F.lit(-(-largest // SLOT_ROWS) or 1))
    dealt = both.withColumn("__slot", slot).repartition(PERIOD, "__slot")
    keys = list(dict.fromkeys([layout.date, *layout.keys]))
    return (dealt.groupBy(PERIOD, *keys, "__slot")
            .agg(*[F.max(p).alias(p) for p in layout.columns]).select(*layout.keys, PERIOD, *layout.columns))


def merge(spark: SparkSession, base: str, long_df: DataFrame, layout: Layout) -> int:
    """Merge cleaned long rows into the tables below ``base``; returns the number of
    the manifest that has them.  Rows without a product of the layout or without a
    value still make a wide row, as in R1.  Merging rows again changes nothing."""
    since, entries = pub.current(spark, base)
    # the rows as they come: they meet the old states in one exchange and one aggregate
    new = materialize(observed(long_df, layout), "increment")
    touched = _periods(new)
    if not touched:
        return since
    old, state = pub.load_parts(spark, base, entries, "latest", touched), _lifted(new, layout)
    if old is not None:
        state = old.unionByName(state, allowMissingColumns=True)
    number = _rewrite(spark, base, since, touched, _greater(state, layout), layout, dealt=True)
    discard(new)
    return number


def remove(spark: SparkSession, base: str, gone: DataFrame, layout: Layout) -> int:
    """Take the wide rows out whose values in the columns of ``gone`` (some of the
    layout's keys, ``date`` among them) are among its rows; NULL equals NULL."""
    on = [c for c in gone.columns if c in layout.keys]
    if layout.date not in on:
        raise ValueError(f"rows to remove are named by {layout.date} among others")
    since, entries = pub.current(spark, base)
    period = F.coalesce(F.date_format(layout.date, "yyyy-MM"), F.lit("none"))
    gone = materialize(gone.select(*on, period.alias(PERIOD)).distinct(), "removed")
    touched = _periods(gone) & {n.partition("/")[2] for n in entries}
    old = pub.load_parts(spark, base, entries, "latest", touched)
    if old is None:
        return since
    out = gone.toDF(*[f"__{c}" for c in gone.columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in [*on, PERIOD]])
    number = _rewrite(spark, base, since, touched, old.join(out, same, "left_anti"), layout)
    discard(gone)
    return number


def wide(spark: SparkSession, base: str, layout: Layout, *, since: str | None = None) -> DataFrame | None:
    """The wide table (R1) as merged so far; ``since`` ("2025-01") reads the periods
    from there on alone.  None before the first increment."""
    _, entries = pub.current(spark, base)
    only = None if since is None else {n.partition("/")[2] for n in entries if n.partition("/")[2] >= since}
    state = pub.load_parts(spark, base, entries, "latest", only)
    return None if state is None else wide_of(state, layout).drop(PERIOD)


def mart_tables(spark: SparkSession, base: str, layout: Layout) -> dict:
    """The eight marts (E2) from the states and lists of all periods; the wide
    rows are not read."""
    _, entries = pub.current(spark, base)
    fine = pub.load_parts(spark, base, entries, "fine")
    if fine is None:
        return {}
    out = marts.marts_of(fine, layout.columns, department=layout.department, region=layout.region,
                         date=layout.date, year=layout.year)
    for table, name, rank in (("most", "most_expensive", ranking.top_n_per_group),
                              ("least", "least_expensive", ranking.bottom_n_per_group)):
        rows = pub.load_parts(spark, base, entries, table)
        out[name] = rank(rows, group=layout.region, value=layout.headline, n=layout.top_n,
                         columns=layout.listed, tiebreak=_tiebreak(layout))
    return out
