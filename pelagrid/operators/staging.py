"""Typed, renamed, filtered views of the four raw tables.

These are narrow (no shuffle) apart from the pixel join. Key columns are md5
text; a consumer that does not select them does not pay for them, because
Catalyst prunes the unused projections down to the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagrid.config import DEFAULT, SMOKE_SITES, SMOKE_YEAR, Gates
from pelagrid.functions.classify import pixel_distance_category
from pelagrid.functions.grid import cell_key, snap, surrogate_key, time_text
from pelagrid.functions.numeric import WHOLE_FROM, to_ms, whole_steps
from pelagrid.session import require_utc


def smoke_subset(
    raw: DataFrame, sites: Iterable[str] = SMOKE_SITES, year: int | None = SMOKE_YEAR
) -> DataFrame:
    """Keep a few sites and one year of an hourly table.

    The year is written as a half-open time range, which reaches the Parquet
    scan, and as a month range when the table carries its partition column, which
    prunes directories. ``year(ts) = y`` would do neither.
    """
    kept = raw.where(F.col("location_name").isin(*sites))
    if year is None:
        return kept
    start, end = (F.lit(f"{y}-01-01 00:00:00").cast("timestamp") for y in (year, year + 1))
    kept = kept.where((F.col("observation_time") >= start) & (F.col("observation_time") < end))
    if "obs_month" in raw.columns:
        kept = kept.where(F.col("obs_month").between(f"{year}-01", f"{year}-12"))
    return kept


def _hourly(raw: DataFrame, required: Column, *measures: Column) -> DataFrame:
    # Record keys, years and months are texts and parts of UTC times.
    require_utc(raw.sparkSession)
    lat, lon = F.col("latitude"), F.col("longitude")
    name, time = F.col("location_name"), F.col("observation_time")
    return raw.where(required.isNotNull()).select(
        surrogate_key(name, time_text(time)).alias("record_id"),
        surrogate_key(name).alias("site_id"),
        name,
        time,
        *measures,
        snap(lat).alias("snap_lat"),
        snap(lon).alias("snap_lon"),
        cell_key(lat, lon).alias("spatial_id"),
        F.year(time).alias("year"),
        F.month(time).alias("month"),
    )


def stg_wind(raw_wind: DataFrame) -> DataFrame:
    """One row per site-hour with a measured hub-height speed, in m/s."""
    speed = F.col("wind_speed_100m")
    return _hourly(
        raw_wind,
        speed,
        to_ms(speed).alias("wind_speed_ms"),
        F.col("wind_direction_100m").alias("wind_direction"),
    )


def stg_wave(raw_wave: DataFrame) -> DataFrame:
    """One row per site-hour with a measured wave height."""
    return _hourly(
        raw_wave,
        F.col("wave_height"),
        F.col("wave_height"),
        F.col("wave_direction"),
        F.col("wave_period"),
    )


def stg_bathymetry(raw_bathymetry: DataFrame) -> DataFrame:
    """Marine pixels only, with positive depth and the pixel's cell."""
    lat, lon = F.col("latitude"), F.col("longitude")
    return raw_bathymetry.where(F.col("elevation_m") < 0).select(
        snap(lat).alias("snap_lat"),
        snap(lon).alias("snap_lon"),
        "elevation_m",
        (F.col("elevation_m") * F.lit(-1.0)).alias("depth_m"),
        F.lit(0).alias("is_land"),
        cell_key(lat, lon).alias("spatial_id"),
    )


def _at_thousandths(coord: Column) -> Column:
    """``round(coord, 3)``, by plain arithmetic as long as doubles count thousandths."""
    near = F.abs(coord) < F.lit(WHOLE_FROM / 1000.0)
    return F.when(near, whole_steps(coord, 3) / F.lit(1000.0)).otherwise(F.round(coord, 3))


def pixel_keys(df: DataFrame) -> DataFrame:
    """Coordinates at three decimals, on which two pixel rasters meet.

    A raster step is larger than a thousandth of a degree. Coordinates have no bounds:
    a raster of many rows runs as far as its rows do. The keys stay doubles, since large
    ones fit no integer. A pixel without a coordinate, or with a NaN, equals none.
    """
    lat, lon = F.col("latitude"), F.col("longitude")
    placed = df.where(lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon))
    return placed.withColumns({"_plat": _at_thousandths(lat), "_plon": _at_thousandths(lon)})


def stg_coastline_distance(
    raw_coastline: DataFrame, raw_bathymetry: DataFrame, gates: Gates = DEFAULT.gates
) -> DataFrame:
    """Coast-distance pixels that have a marine bathymetry pixel.

    Both sides carry only the join keys and what is selected. The two inputs of
    the join are bare shuffles, the shape in which adaptive execution can split
    a pixel key that holds far more rows than the others, on either side.
    """
    coast = pixel_keys(raw_coastline.where(F.col("distance_to_coast_km") >= gates.min_pixel_coast_km))
    marine = pixel_keys(raw_bathymetry.where(F.col("elevation_m") < 0)).select("_plat", "_plon")
    lat, lon, km = F.col("latitude"), F.col("longitude"), F.col("distance_to_coast_km")
    return coast.join(marine, ["_plat", "_plon"]).select(
        surrogate_key(lat, lon).alias("raw_pixel_id"),
        lat,
        lon,
        km,
        cell_key(lat, lon).alias("spatial_id"),
        pixel_distance_category(km).alias("distance_category"),
    )
