"""Key -> value lookups against small dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions.dims import (department_names_df, department_region_df,
                              region_names_df)


def _dim(dim: DataFrame, code: str, name: str) -> DataFrame:
    """Rename a two-column dimension to (``__code``, ``name``)."""
    c0, c1 = dim.columns[:2]
    return dim.select(F.col(c0).cast("string").alias("__code"), F.col(c1).alias(name))


def lookup(df: DataFrame, dim: DataFrame, *, code: str, out: str,
           default: str | None = None, how: str = "left") -> DataFrame:
    """Attach ``dim``'s value for ``df[code]``.

    ``how="left"`` keeps unmatched rows (value ``default``); ``"inner"``
    drops them.  Dimensions built from the fixed tables carry a broadcast
    hint (their size is fixed); file-based dimensions are broadcast by the
    planner from their statistics when under the threshold.
    """
    d = _dim(dim, code, out)
    joined = df.join(d, F.col(code) == F.col("__code"), how).drop("__code")
    if default is not None:
        joined = joined.withColumn(out, F.coalesce(F.col(out), F.lit(default)))
    return joined


def lookup_region_name(df: DataFrame, names: DataFrame | None = None, *,
                       code: str = "region_code", out: str = "region_name",
                       default: str = schema.UNKNOWN_REGION_NAME) -> DataFrame:
    """Region name ("99" -> "Autres", unknown -> "Inconnu"); no-op
    when the code column is absent."""
    if code not in df.columns:
        return df
    names = names if names is not None else region_names_df(df.sparkSession)
    return lookup(df, names, code=code, out=out, default=default)


def lookup_department_name(df: DataFrame, names: DataFrame | None = None, *,
                           code: str = "departement", out: str = "departement_name",
                           default: str | None = None) -> DataFrame:
    """Department name for the 24 named departments (else ``default``)."""
    if code not in df.columns:
        return df
    names = names if names is not None else department_names_df(df.sparkSession)
    return lookup(df, names, code=code, out=out, default=default)


def map_dept_region(df: DataFrame, mapping: DataFrame | None = None, *,
                    code: str = "departement", out: str = "region") -> DataFrame:
    """Region of each department; rows of unmapped departments dropped."""
    mapping = mapping if mapping is not None else department_region_df(df.sparkSession)
    return lookup(df, mapping, code=code, out=out, how="inner")


def region_names_strict(df: DataFrame, names: DataFrame | None = None, *,
                        code: str = "region_code", out: str = "region_name") -> DataFrame:
    """V4: names of the 13 regions only; "99" and unknown codes get NULL."""
    names = names if names is not None else region_names_df(df.sparkSession,
                                                            include_other=False)
    return lookup(df, names, code=code, out=out)
