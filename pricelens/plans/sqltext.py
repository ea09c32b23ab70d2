"""Small helpers that write DuckDB SQL text for the oracle side."""

from __future__ import annotations


def rnd(expr: str, digits: int) -> str:
    """DuckDB twin of Spark's ``round(double, d)``.

    Spark rounds half-up on the shortest decimal text of the double
    (``BigDecimal.valueOf``); DuckDB's DOUBLE -> VARCHAR cast yields that
    same shortest text, which is then rounded as a DECIMAL (half away from
    zero).  Rounding the binary value directly differs at ties such as
    27.97725 (binary 27.977249999...).
    """
    return (f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38, 18)), {digits}) "
            f"AS DOUBLE)")


def csv(items) -> str:
    return ", ".join(items)
