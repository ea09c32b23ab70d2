"""Scalar expressions shared by the operators.

All helpers build Catalyst expressions from ``pyspark.sql.functions`` so
they stay inside whole-stage code generation; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalized_name(name: str) -> str:
    """Column-name normal form: trimmed, spaces/hyphens to ``_``, lower case."""
    return name.strip().replace(" ", "_").replace("-", "_").lower()


def normalized(c) -> Column:
    """``normalized_name`` of a text column's values."""
    return F.lower(F.translate(F.trim(_col(c)), " -", "__"))


def pad_code(c, width: int) -> Column:
    """Left-pad a code with zeros up to ``width``; longer codes stay whole.

    ``lpad`` alone truncates longer input ("971" -> "97"), so it is applied
    only when the value is shorter than ``width``.
    """
    s = _col(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def tidy_label(c) -> Column:
    """Display label of a measure column: the product's name in upper case,
    without the mark of a mean (``avg_`` before it or ``_moyen`` after it)."""
    return F.upper(F.regexp_replace(_col(c), r"^avg_|_moyen$", ""))


def format_price(c, decimals: int = 3, unit: str = "€") -> Column:
    """``1.234 €`` style text; ``-`` for a missing value.

    ``format_string`` renders NULL as the text ``null``, so NULL is tested
    first.
    """
    v = _col(c)
    suffix = f" {unit}" if unit else ""
    return F.when(v.isNull(), F.lit("-")).otherwise(
        F.format_string(f"%.{decimals}f{suffix}", v))


def rounded(values, digits: int) -> Column:
    """``F.round`` of each of some double columns, as one array.

    Many roundings side by side make a generated method that is too large for the
    JVM to compile; over an array they are one expression that is evaluated for each
    element.  ``F.round`` goes through the decimal text of a number; where a number is
    below a million and clearly not between two results, the nearest multiple of
    ``10 ** -digits`` by floating point is the same double.
    """
    scale = 10.0 ** digits

    def one(x):
        scaled = x * scale
        part = scaled - F.floor(scaled)
        clear = (F.abs(x) < 1e6) & (F.abs(part - 0.5) > 1e-3)
        return F.when(clear, F.floor(scaled + 0.5) / scale).otherwise(F.round(x, digits))
    return F.transform(F.array(*[_col(v) for v in values]), one if digits <= 4 else lambda x: F.round(x, digits))


def format_date_dmy(c) -> Column:
    """Date as ``dd/MM/yyyy`` text."""
    return F.date_format(_col(c), "dd/MM/yyyy")


def clamp01(c) -> Column:
    """Clamp to [0, 1]; NULL stays NULL (``least``/``greatest`` alone skip
    NULL arguments and would turn a missing value into a bound)."""
    v = _col(c)
    return F.when(v.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), v)))


def price_bin(value, lo, width, bins: int) -> Column:
    """Equal-width bin index in ``0 .. bins-1``; the maximum lands in the last bin.

    ``width`` 0 (all values equal) puts everything in bin 0.
    """
    v, lo, width = _col(value), _col(lo), _col(width)
    idx = F.floor((v - lo) / F.when(width > 0, width)).cast("int")
    return F.when(v.isNull(), F.lit(None).cast("int")).otherwise(
        F.least(F.lit(bins - 1), F.coalesce(idx, F.lit(0))))


def sample_hash(keys, seed: int) -> Column:
    """Seeded hash of a row key: lower-case hex MD5 of ``k1|k2|...|seed``.

    Keys are rendered as text (integers, strings and dates have one text
    form in every engine), so the order is reproducible outside Spark, e.g.
    ``md5(concat_ws('|', CAST(k AS VARCHAR), ..., '42'))`` in DuckDB.  The
    hex strings have a fixed width, so text order is numeric order.
    """
    parts = [_col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))
