"""Raster pixels as files: bathymetry tiles and coast-distance strips."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pelagrid import schemas
from pelagrid.config import FULL_RASTER, RasterGrid
from pelagrid.functions.grid import cell_index
from pelagrid.sources import versions

TILE_DEG = 15.0
STRIP_ROWS = 200
BLOCK_ROWS = 20  # raster rows of a strip that go to one task
PLACE, BLOCK = "place", "block"
BLOCK_BITS = 8  # a folder holds 2 ** 8 cells: a square of 16 by 16, four degrees wide


def clip_marine(pixels: DataFrame, extent: RasterGrid = FULL_RASTER) -> DataFrame:
    """(lat, lon, z) pixels inside the extent and below sea level."""
    inside = F.col("lat").between(extent.lat_min, extent.lat_max) & F.col("lon").between(
        extent.lon_min, extent.lon_max
    )
    return pixels.where(inside & (F.col("z") < 0)).select(
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        F.col("z").alias("elevation_m"),
    )


def write_tiles(bathymetry: DataFrame, root: str, tile_deg: float = TILE_DEG) -> None:
    """One folder per tile; a rerun replaces the tiles it brings and no others.

    Ranges over (tile, latitude, longitude) keep a tile in few tasks and a large
    tile in several.
    """
    row, col = (F.floor(F.col(c) / tile_deg).cast("int") for c in ("latitude", "longitude"))
    (
        bathymetry.withColumns({"tile_row": row, "tile_col": col})
        .repartitionByRange("tile_row", "tile_col", "latitude", "longitude")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("tile_row", "tile_col")
        .parquet(root)
    )


def read_bathymetry(spark: SparkSession, *paths: str) -> DataFrame:
    """The loaded table, or folders of tiles as they are."""
    if len(paths) == 1 and versions.is_versioned(spark, paths[0]):
        return versions.read(spark, paths[0], schemas.RAW_BATHYMETRY)
    return spark.read.schema(schemas.RAW_BATHYMETRY).parquet(*paths)


def load_tiles(tiles: list[DataFrame], path: str) -> None:
    """Make the union of tiles the raw table's next version.

    Truncating with the first tile and appending the rest would show a partial
    table to readers in between, and a failed tile would leave none.
    """
    union = reduce(lambda a, b: a.unionByName(b), tiles)
    versions.replace(union.sparkSession, path, lambda folder: union.write.parquet(folder))


def write_strips(distances: DataFrame, root: str, grid: RasterGrid, strip_rows: int = STRIP_ROWS) -> None:
    """Coast distances in latitude strips named by their first raster row, as the next version.

    Hash partitioning by strip and block of rows: a strip is several tasks and files, and
    range partitioning would run the distance transform twice, once to sample it.
    """
    row = F.floor((F.col("latitude") - grid.lat_min) / grid.res)
    first = (F.floor(row / strip_rows) * strip_rows).cast("int")
    named = (
        distances.withColumn("strip", F.format_string("%05d", first))
        .repartition(F.col("strip"), F.floor(row / BLOCK_ROWS))
        .sortWithinPartitions("strip", "latitude", "longitude")
    )
    versions.replace(
        distances.sparkSession, root, lambda folder: named.write.partitionBy("strip").parquet(folder)
    )


def read_strips(spark: SparkSession, root: str) -> DataFrame:
    """All strips of the version that counts, or a folder of strips as it is."""
    if versions.is_versioned(spark, root):
        return versions.read(spark, root, schemas.RAW_COASTLINE)
    return spark.read.schema(schemas.RAW_COASTLINE).parquet(f"{root}/strip=*")


def _apart(number: Column) -> Column:
    """The bits of a number below 2 ** 16 moved to every second place."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        number = number.bitwiseOR(F.shiftleft(number, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return number


def curve_place(lat: Column, lon: Column) -> Column:
    """Place of a coordinate's cell on a space-filling (Z-order) curve over all cells.

    Every aligned square of cells, of any power of two, is one range of places, so what is
    near on the map is near in the files.
    """
    row, col = (cell_index(c + F.lit(180.0)).cast("long") for c in (lat, lon))
    return F.shiftleft(_apart(row), 1).bitwiseOR(_apart(col))


def write_curve(pixels: DataFrame, path: str, block_bits: int = BLOCK_BITS) -> None:
    """A raster in curve order as the next version of a table.

    Tasks hold ranges of the curve (and of latitudes inside a cell, so that one cell with
    a large share of all pixels is several tasks), folders hold aligned squares of it, and
    rows are sorted by place. A reader of few cells lists few folders, and inside them the
    statistics of places leave out the other row groups. Pixels without a coordinate have no
    place; they are in a folder of their own.
    """
    place = curve_place(F.col("latitude"), F.col("longitude"))
    placed = pixels.withColumn(PLACE, place).withColumn(BLOCK, F.shiftright(PLACE, block_bits))
    laid = placed.repartitionByRange(PLACE, "latitude", "longitude").sortWithinPartitions(PLACE, "latitude", "longitude")
    spark = pixels.sparkSession
    loaded = versions.new_load(spark, path, lambda folder: laid.write.partitionBy(BLOCK).parquet(folder))
    while True:
        base = versions.latest(spark, path)
        gone = {p: [] for p in base.parts}
        if versions.commit_next(spark, path, base, gone | loaded, {"block_bits": block_bits}) is not None:
            return


def read_curve(spark: SparkSession, path: str, schema: StructType, coordinates: Iterable[tuple[float, float]] | None = None) -> DataFrame:
    """A raster written by ``write_curve``: all of it, or the cells that hold the given (lat, lon).

    The places of the coordinates are a filter on folders and on places. Coordinates are
    a list on the driver, such as the sites of one report; for many, join on ``curve_place``.
    """
    held = versions.latest(spark, path)
    declared = StructType([*schema.fields, StructField(PLACE, LongType()), StructField(BLOCK, LongType())])
    rows = versions.read(spark, path, declared, held)
    if coordinates is not None:
        points = spark.createDataFrame(list(coordinates), "lat double, lon double")
        places = sorted({r[0] for r in points.select(curve_place(F.col("lat"), F.col("lon"))).collect()})
        bits = held.notes.get("block_bits", BLOCK_BITS)
        rows = rows.where(F.col(BLOCK).isin(*{p >> bits for p in places}) & F.col(PLACE).isin(*places))
    return rows.select(*schema.fieldNames())
