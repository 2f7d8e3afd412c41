"""Candidate grid points of the active study areas, from bathymetry pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagrid.functions.grid import nearest_line, site_key
from pelagrid.functions.numeric import rounded

# Areas and pixels meet on whole-degree tiles before the exact box test.
_TILE_DEG = 1.0


def _tile(coord: str):
    return F.floor(F.col(coord) / F.lit(_TILE_DEG))


def pixels_in_areas(raw_bathymetry: DataFrame, areas: DataFrame) -> DataFrame:
    """Pixels tagged with each active area whose box and depth range hold them.

    A range join, made an equi-join by listing the tiles an area touches. Adaptive
    execution chooses the kind of join by the measured size of the tiles.
    """
    boxes = (
        areas.where("active")
        .withColumn("_ty", F.explode(F.sequence(_tile("lat_min"), _tile("lat_max"))))
        .withColumn("_tx", F.explode(F.sequence(_tile("lon_min"), _tile("lon_max"))))
    )
    pixels = raw_bathymetry.where(F.col("elevation_m") <= 0).withColumns(
        {"_ty": _tile("latitude"), "_tx": _tile("longitude")}
    )
    inside = (
        F.col("latitude").between(F.col("lat_min"), F.col("lat_max"))
        & F.col("longitude").between(F.col("lon_min"), F.col("lon_max"))
        & F.col("elevation_m").between(F.col("depth_max_m"), F.lit(0.0))
    )
    return pixels.join(boxes, ["_ty", "_tx"]).where(inside)


def grid_points(raw_bathymetry: DataFrame, areas: DataFrame) -> DataFrame:
    """One row per area and grid line crossing with its average elevation."""
    step = F.col("resolution")
    points = (
        pixels_in_areas(raw_bathymetry, areas)
        .groupBy(
            F.col("name").alias("area"),
            nearest_line(F.col("latitude"), step).alias("lat"),
            nearest_line(F.col("longitude"), step).alias("lon"),
        )
        .agg(rounded(F.avg("elevation_m"), 1).alias("avg_depth"))
    )
    return points.select(
        site_key(F.col("area"), F.col("lat"), F.col("lon")).alias("key"),
        "lat",
        "lon",
        "avg_depth",
        "area",
    )
