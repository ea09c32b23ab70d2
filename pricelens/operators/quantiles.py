"""Exact and sketch quantiles per group.

``exact_quantiles`` returns the same values as SQL ``quantile_cont`` /
Spark ``percentile`` (linear interpolation), but never holds a group in one
task.  Spark's ``percentile`` keeps a value->count map per group and merges
a whole group in one task; here the search is narrowed first:

1. one pass of ``percentile_approx`` per group, whose rank error has a bound,
   gives for each wanted rank a bracket that surely holds it: about
   ``6 n / accuracy`` ranks wide, or the whole group if that has fewer than
   ``2 * accuracy`` values;
2. a second pass counts each distinct value inside a bracket, and all values
   below it as one;
3. while a bracket has more than ``bound`` distinct values, they are cut at
   ``CUTS`` of their quantiles, the counts of the parts say in which one the
   wanted ranks lie, and only its values stay; the rows shrink about ``CUTS``
   times a round, whatever the ties;
4. a running count over the at most ``bound`` values left picks those at the
   wanted ranks.

No sort or range partition of the data is needed, and nothing of it goes to
the driver.

``approx_quantiles`` is the mergeable-sketch path (``percentile_approx``):
one pass, bounded memory, rank error ``1/accuracy``.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sizing import broadcast_if_small, discard, materialize, scalar_struct


def _join_ns(left: DataFrame, right: DataFrame, keys: Sequence[str],
             how: str = "inner") -> DataFrame:
    """Join on ``keys`` with NULL-safe equality (a NULL group is a group)."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    out = left.join(r, cond, how)
    if how in ("left_semi", "left_anti"):
        return out
    if how in ("full", "outer", "full_outer"):
        rest = [c for c in out.columns if c not in keys and not c.startswith("__r_")]
        return out.select(*[F.coalesce(F.col(k), F.col(f"__r_{k}")).alias(k) for k in keys],
                          *rest)
    return out.drop(*[f"__r_{k}" for k in keys])


def _qname(value: str, q: float) -> str:
    return f"{value}_p{int(round(q * 100)):02d}" if abs(q * 100 - round(q * 100)) < 1e-9 \
        else f"{value}_p{str(q).replace('.', '_')}"


def approx_quantiles(df: DataFrame, value: str, probs: Sequence[float], *,
                     groups: Sequence[str] = (), accuracy: int = 10000,
                     names: Sequence[str] | None = None) -> DataFrame:
    """Sketch quantiles (a data value, rank error at most n/accuracy)."""
    names = list(names or [_qname(value, q) for q in probs])
    arr = F.percentile_approx(F.col(value).cast("double"), list(probs), accuracy)
    agg = df.groupBy(*groups).agg(arr.alias("_q"))
    return agg.select(*groups, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


#: Parts that a bracket with too many distinct values is cut into.
CUTS = 64


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], *,
                    groups: Sequence[str] = (), names: Sequence[str] | None = None,
                    accuracy: int = 100_000, bound: int | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles of ``value`` per group.

    One row per group that has at least one non-NULL value (one row with
    NULLs when there are no groups and no values).  Runs eagerly: the values
    are written once and read by both passes.  No task orders more than
    ``bound`` distinct values of a bracket (default ``2 * accuracy``).
    """
    g = list(groups)
    names = list(names or [_qname(value, q) for q in probs])
    bound = max(bound or 2 * accuracy, 2)
    global_ = not g
    if global_:
        df, g = df.withColumn("_one", F.lit(0)), ["_one"]
    v = F.col(value).cast("double")
    base = materialize(df.select(*g, v.alias("_v")).filter(F.col("_v").isNotNull()),
                       "quantile-values")

    # brackets: three rank errors to either side; the whole of a small group, one
    # for all its ranks where it needs no narrowing
    whole, shared = F.col("_n") < 2 * accuracy, F.col("_n") < min(2 * accuracy, bound + 1)
    sizes = broadcast_if_small(base.groupBy(*g).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max")))
    large = sizes.filter(~whole)
    if large.isEmpty():
        sketched, sized = False, sizes.withColumn("_q", F.lit(None).cast("array<double>"))
    else:
        sketched = True
        edge = 3.0 / accuracy
        around = [p for q in probs for p in (max(0.0, q - edge), min(1.0, q + edge))]
        sketch = _join_ns(base, large.select(*g), g, "left_semi").groupBy(*g).agg(
            F.percentile_approx("_v", around, accuracy).alias("_q"))
        sized = _join_ns(sizes, sketch, g, "left")

    def at_rank(i):
        return [F.lit(i).alias("_bi"), F.when(whole, F.col("_min")).otherwise(F.get("_q", F.lit(2 * i))).alias("_lo"),
                F.when(whole, F.col("_max")).otherwise(F.get("_q", F.lit(2 * i + 1))).alias("_hi")]
    brackets = F.array(*[F.struct(*at_rank(i)) for i in range(len(probs))])
    sized = sized.withColumn("_b", F.when(shared, F.slice(brackets, 1, 1)).otherwise(brackets))
    sized = sized.select(*g, "_n", "_b")
    if sketched:                       # else still the checked table of sizes, projected
        sized = broadcast_if_small(sized)

    # distinct values inside each bracket with their counts; NULL: all below it
    seen = _join_ns(base, sized.select(*g, "_b"), g).select(*g, "_v", F.explode("_b").alias("_b"))
    cells = (seen.filter(F.col("_v") <= F.col("_b._hi"))
                 .groupBy(*g, F.col("_b._bi").alias("_bi"),
                          F.when(F.col("_v") >= F.col("_b._lo"), F.col("_v")).alias("_v"))
                 .agg(F.count(F.lit(1)).alias("_c")))
    # wanted ranks (1-based): floor(h) + 1 and ceil(h) + 1, h = (n - 1) p
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("_qi"), F.lit(float(q)).alias("_p"))
                                 for i, q in enumerate(probs)]))
    h = (F.col("_n") - 1) * F.col("_w._p")
    ranks = (sized.select(*g, "_n", wanted.alias("_w"))
             .select(*g, F.col("_w._qi").alias("_qi"), F.when(shared, 0).otherwise(F.col("_w._qi")).alias("_bi"),
                     (F.floor(h) + 1).alias("_r1"), (F.ceil(h) + 1).alias("_r2"), (h - F.floor(h)).alias("_frac")))
    cells = materialize(cells, "quantile-cells")
    discard(base)                  # read by the passes above only
    at = _narrowed(cells, ranks, [*g, "_bi"], bound)

    def holds(rank):
        return (F.col("_cum") - F.col("_c") < rank) & (rank <= F.col("_cum"))
    aggs = []
    for i, n in enumerate(names):
        mine = F.col("_qi") == i
        lo = F.max(F.when(mine & holds(F.col("_r1")), F.col("_v")))
        hi = F.max(F.when(mine & holds(F.col("_r2")), F.col("_v")))
        frac = F.max(F.when(mine, F.col("_frac")))
        aggs.append((lo + (hi - lo) * frac).alias(n))
    if global_:
        # a global aggregate has exactly one row (NULLs when there are no values)
        return at.agg(*aggs)
    return at.groupBy(*g).agg(*aggs)


def _running(keys: Sequence[str]) -> Window:
    """From the values below the bracket (NULL) upwards."""
    return (Window.partitionBy(*keys).orderBy(F.col("_v").asc_nulls_first())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _narrowed(cells: DataFrame, ranks: DataFrame, keys: Sequence[str], bound: int) -> DataFrame:
    """``cells`` (keys, _v, _c: a distinct value and its count, NULL for all values
    below) with the running count ``_cum`` and the wanted ``ranks``, once no
    bracket has more than ``bound`` values."""
    while True:
        sizes = cells.groupBy(*keys).agg(F.count("_v").alias("_d"))
        wide = sizes.filter(F.col("_d") > bound)
        if wide.isEmpty():
            break
        # cut the wide brackets at quantiles of their distinct values
        cuts = [(i + 1) / CUTS for i in range(CUTS - 1)]
        at = _join_ns(cells, wide.select(*keys), keys, "left_semi").groupBy(*keys).agg(
            F.percentile_approx("_v", cuts, 20 * CUTS).alias("_cuts"))
        at = broadcast_if_small(at)
        part = F.when(F.col("_v").isNull(), F.lit(-1)).otherwise(
            F.size(F.filter("_cuts", lambda x: x < F.col("_v"))))
        parted = _join_ns(cells, at, keys, "left").withColumn("_part", part)
        sums = (parted.filter(F.col("_cuts").isNotNull()).groupBy(*keys, "_part")
                .agg(F.sum("_c").alias("_s")))
        up_to = (Window.partitionBy(*keys).orderBy("_part")          # at most CUTS + 1 rows
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        found = _join_ns(sums.withColumn("_to", F.sum("_s").over(up_to)), ranks, keys)
        found = found.groupBy(*keys).agg(
            F.min(F.when(F.col("_r1") <= F.col("_to"), F.col("_part"))).alias("_first"),
            F.min(F.when(F.col("_r2") <= F.col("_to"), F.col("_part"))).alias("_last"))
        found = broadcast_if_small(found)
        parted = _join_ns(parted, found, keys, "left")
        # brackets that were not cut stay; of the others only the parts between
        kept = parted.filter(F.col("_first").isNull() | (F.col("_part") <= F.col("_last")))
        below = F.col("_first").isNotNull() & (F.col("_part") < F.col("_first"))
        kept = (kept.select(*keys, F.when(~below, F.col("_v")).alias("_v"), "_c")
                .groupBy(*keys, "_v").agg(F.sum("_c").alias("_c")))
        cells = materialize(kept, "quantile-cells")
    return _join_ns(cells.withColumn("_cum", F.sum("_c").over(_running(keys))), ranks, keys)


def quantile_table(df: DataFrame, columns: Sequence[str], probs: Sequence[float], *,
                   groups: Sequence[str] = (), method: str = "exact",
                   accuracy: int = 10000) -> DataFrame:
    """Quantiles of several columns side by side (joined on the groups)."""
    frames = []
    for c in columns:
        if method == "exact":
            frames.append(exact_quantiles(df, c, probs, groups=groups))
        else:
            frames.append(approx_quantiles(df, c, probs, groups=groups, accuracy=accuracy))
    if not groups:
        # one row each: the first frame carries the others as scalar subqueries
        rest = [(scalar_struct(f), f.columns) for f in frames[1:]]
        return frames[0].select("*", *[s[c].alias(c) for s, cols in rest for c in cols])
    return reduce(lambda a, b: _join_ns(a, b, list(groups), how="full"), frames)
