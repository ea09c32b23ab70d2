"""Map-ready tables (J3, V1-V3): the data behind point, heat and area maps."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clamp01
from ..functions.sizing import scalar_struct
from .ranking import bounded_sample
from .select import drop_missing


def station_points(df: DataFrame, *, lat: str = "latitude", lon: str = "longitude",
                   popup_cols: Sequence[str] = ("ville", "adresse", "gazole", "sp95", "sp98"),
                   color_by: str | None = None, anomaly: str = "has_any_anomaly",
                   competitive: str = "competitive_gazole", n: int = 5000, seed: int = 42,
                   key: Sequence[str]) -> DataFrame:
    """V1: points with coordinates, at most ``n`` (seeded hash sample), a
    marker class and a popup text.

    Class: anomaly -> red, else competitive -> green, else blue; all blue
    without ``color_by`` or if the table lacks that column.  ``key`` names a row
    (see ``bounded_sample``).  Popup: ``name: value`` for each non-NULL
    attribute, doubles as ``%.3f €/L``.
    """
    pts = bounded_sample(drop_missing(df, [lat, lon]), n=n, seed=seed, key=key)
    if color_by and color_by in df.columns:
        red = F.coalesce(F.col(anomaly), F.lit(False)) if anomaly in df.columns else F.lit(False)
        green = (F.coalesce(F.col(competitive), F.lit(False))
                 if competitive in df.columns else F.lit(False))
        color = F.when(red, "red").when(green, "green").otherwise("blue")
    else:
        color = F.lit("blue")
    types = dict(df.dtypes)
    parts = []
    for c in popup_cols:
        if c not in df.columns:
            continue
        txt = (F.format_string(f"{c}: %.3f €/L", F.col(c)) if types[c] in ("double", "float")
               else F.concat(F.lit(f"{c}: "), F.col(c).cast("string")))
        parts.append(F.when(F.col(c).isNotNull(), txt))
    popup = F.concat_ws("\n", *parts) if parts else F.lit("")
    return pts.select(*key, lat, lon, color.alias("color"), popup.alias("popup"))


def heat_points(df: DataFrame, *, lat: str = "latitude", lon: str = "longitude",
                weight: str = "gazole") -> DataFrame:
    """V2: (lat, lon, weight) rows with all three present."""
    return drop_missing(df, [lat, lon, weight]).select(lat, lon, weight)


def choropleth_table(areas: DataFrame, prices: DataFrame, *, code: str = "departement",
                     value: str = "mean_price", count: str = "nombre_stations") -> DataFrame:
    """Every area of the dimension with its price and count; areas without
    a price stay, flagged ``has_data = false``.

    ``prices`` is one slice (one product, one date): at most one row per
    area, so it is no larger than the area list itself.
    """
    keep = [code, value] + ([count] if count in prices.columns else [])
    out = areas.join(prices.select(*keep), on=code, how="left")
    return out.withColumn("has_data", F.col(value).isNotNull())


def choropleth_bands(table: DataFrame, scale: DataFrame, *,
                     value: str = "mean_price") -> DataFrame:
    """V3: each area's position on the p05-p95 scale, clamped to [0, 1]
    (NULL for no-data areas or a zero-width scale)."""
    s = scalar_struct(scale.select("vmin", "vmax"))
    pos = F.try_divide(F.col(value) - s["vmin"],
                       F.when(s["vmax"] > s["vmin"], s["vmax"] - s["vmin"]))
    return table.withColumn("band", clamp01(pos))
