"""Rasters reduced to one row per 0.25 degree cell.

Joining sites to pixels first and grouping afterwards would multiply the two
rasters inside each cell: 3,600 x 3,600 pairs at 15 arc seconds. Averages,
minima and maxima do not change under that multiplication, so each raster is
aggregated alone and every pixel is read once. Grouping runs on integer cell
numbers; the md5 key is computed once per cell, not once per pixel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagrid.config import CELL_DEG, DEFAULT, Gates
from pelagrid.functions.grid import cell_index, index_key
from pelagrid.operators.staging import pixel_keys

# Rounding to three decimals moves a coordinate by at most 0.0005 degrees.
_ROUNDING_REACH = 0.0006


def cell_depths(raw_bathymetry: DataFrame) -> DataFrame:
    """Per marine cell: depth average and extremes, and pixel counts."""
    marine = raw_bathymetry.where(F.col("elevation_m") < 0)
    depth = F.abs("elevation_m")
    cells = marine.groupBy(
        cell_index(F.col("latitude")).alias("_gy"), cell_index(F.col("longitude")).alias("_gx")
    ).agg(
        F.avg(depth).alias("depth_m"),
        F.min(depth).alias("depth_min_m"),
        F.max(depth).alias("depth_max_m"),
        F.count_if(F.col("elevation_m") < 0).alias("marine_pixels"),
        F.count(F.lit(1)).alias("bathymetry_pixels"),
    )
    return cells.select(
        index_key(F.col("_gy"), F.col("_gx")).alias("spatial_id"),
        "depth_m",
        "depth_min_m",
        "depth_max_m",
        "marine_pixels",
        "bathymetry_pixels",
    )


def _cells_of_rounded(rounded: str) -> Column:
    """Cells a pixel may lie in, knowing only its rounded coordinate.

    One cell nearly always, two when the rounded value sits on a cell border.
    """
    coord, reach = F.col(rounded), F.lit(_ROUNDING_REACH)
    low, high = cell_index(coord - reach), cell_index(coord + reach)
    return F.when(low == high, F.array(low)).otherwise(F.array(low, high))


def cell_coast_distances(
    raw_coastline: DataFrame, raw_bathymetry: DataFrame, gates: Gates = DEFAULT.gates
) -> DataFrame:
    """Per cell: distance average, minimum and count over the joined pixels.

    Equals grouping ``stg_coastline_distance`` by its cell, but no pixel is joined:
    both rasters go into one aggregation per (pixel key, cell), and a group that
    received pixels from both is a match of ``distances x copies`` pairs. Partial
    aggregation collapses repeated pixels before the one shuffle, and nothing is
    sorted. The bathymetry side lists the cells its rounded key may belong to,
    because matching pixels may fall either side of a cell border.
    """
    keys = ["_plat", "_plon", "_gy", "_gx"]
    km = F.col("distance_to_coast_km")
    coast = pixel_keys(raw_coastline.where(km >= gates.min_pixel_coast_km)).select(
        "_plat",
        "_plon",
        cell_index(F.col("latitude")).alias("_gy"),
        cell_index(F.col("longitude")).alias("_gx"),
        km.alias("_km"),
    )
    marine = (
        pixel_keys(raw_bathymetry.where(F.col("elevation_m") < 0))
        .select("_plat", "_plon", F.explode(_cells_of_rounded("_plat")).alias("_gy"))
        .select("_plat", "_plon", "_gy", F.explode(_cells_of_rounded("_plon")).alias("_gx"))
        .withColumn("_km", F.lit(None).cast("double"))
    )
    pixels = (
        coast.unionByName(marine)
        .groupBy(*keys)
        .agg(
            F.count("_km").alias("_n"),
            F.sum("_km").alias("_sum"),
            F.min("_km").alias("_min"),
            F.count_if(F.col("_km").isNull()).alias("_copies"),
        )
        .where("_n > 0 AND _copies > 0")
    )
    cells = pixels.groupBy("_gy", "_gx").agg(
        F.sum(F.col("_n") * F.col("_copies")).alias("coast_pixels"),
        F.sum(F.col("_sum") * F.col("_copies")).alias("_total"),
        F.min("_min").alias("distance_min_km"),
    )
    return cells.select(
        index_key(F.col("_gy"), F.col("_gx")).alias("spatial_id"),
        (F.col("_total") / F.col("coast_pixels")).alias("distance_to_coast_km"),
        "distance_min_km",
        "coast_pixels",
    )


def cell_depths_by_fan_out(raw_bathymetry: DataFrame, coast: DataFrame) -> DataFrame:
    """The multiplied form, kept only as the yardstick ``bench.py`` measures against."""
    lat, lon = cell_index(F.col("latitude"), CELL_DEG), cell_index(F.col("longitude"), CELL_DEG)
    depth = raw_bathymetry.where(F.col("elevation_m") < 0).select(
        index_key(lat, lon).alias("spatial_id"), F.abs("elevation_m").alias("depth")
    )
    return (
        depth.join(coast.select("spatial_id", "distance_to_coast_km"), "spatial_id")
        .groupBy("spatial_id")
        .agg(
            F.avg("depth").alias("depth_m"),
            F.avg("distance_to_coast_km").alias("distance_to_coast_km"),
            F.count(F.lit(1)).alias("sample_count"),
        )
    )
