"""Small dimension DataFrames built from the fixed tables in ``schema``.

Their size is fixed by the source file (14, 24 and 96 rows), which is the
size bound that makes broadcasting them safe at any data scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema


def _two_col(spark: SparkSession, mapping: dict, k: str, v: str) -> DataFrame:
    rows = sorted(mapping.items())
    return F.broadcast(spark.createDataFrame(rows, f"{k} string, {v} string"))


def region_names_df(spark: SparkSession, code_col: str = "region_code",
                    name_col: str = "region_name",
                    include_other: bool = True) -> DataFrame:
    names = schema.REGION_NAMES
    if not include_other:
        names = {k: v for k, v in names.items() if k != schema.OTHER_REGION}
    return _two_col(spark, names, code_col, name_col)


def department_names_df(spark: SparkSession, code_col: str = "departement",
                        name_col: str = "departement_name") -> DataFrame:
    return _two_col(spark, schema.DEPARTMENT_NAMES, code_col, name_col)


def department_region_df(spark: SparkSession, dept_col: str = "departement",
                         region_col: str = "region_code") -> DataFrame:
    return _two_col(spark, schema.DEPARTMENT_REGION, dept_col, region_col)
