"""Declared schemas of the raw tables; nothing in the library infers one."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


WIND_VARS = ("wind_speed_100m", "wind_direction_100m", "wind_speed_10m")
WAVE_VARS = ("wave_height", "wave_direction", "wave_period")


def hourly_table(variables: tuple[str, ...]) -> T.StructType:
    """Flat table of one site-hour per row."""
    return _struct(
        ("location_name", T.StringType()),
        ("latitude", T.DoubleType()),
        ("longitude", T.DoubleType()),
        ("observation_time", T.TimestampType()),
        *((v, T.DoubleType()) for v in variables),
    )


def hourly_response(variables: tuple[str, ...]) -> T.StructType:
    """Nested service response: parallel arrays under ``hourly``.

    Values are read as text so that one bad number becomes NULL rather than
    failing the file; ``explode_hourly`` casts them.
    """
    arrays = [T.StructField(v, T.ArrayType(T.StringType()), True) for v in ("time", *variables)]
    return _struct(
        ("latitude", T.DoubleType()),
        ("longitude", T.DoubleType()),
        ("hourly", T.StructType(arrays)),
    )


RAW_WIND = hourly_table(WIND_VARS)
RAW_WAVE = hourly_table(WAVE_VARS)
RAW_BATHYMETRY = _struct(
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("elevation_m", T.DoubleType()),
)
RAW_COASTLINE = _struct(
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("distance_to_coast_km", T.DoubleType()),
)
EXCLUSIONS = _struct(
    ("site_name", T.StringType()),
    ("exclusion_reason", T.StringType()),
    ("excluded_by", T.StringType()),
    ("excluded_date", T.DateType()),
)
AREAS = _struct(
    ("name", T.StringType()),
    ("description", T.StringType()),
    ("lat_min", T.DoubleType()),
    ("lat_max", T.DoubleType()),
    ("lon_min", T.DoubleType()),
    ("lon_max", T.DoubleType()),
    ("resolution", T.DoubleType()),
    ("depth_min_m", T.DoubleType()),
    ("depth_max_m", T.DoubleType()),
    ("active", T.BooleanType()),
)
GRID_POINTS = _struct(
    ("key", T.StringType()),
    ("lat", T.DoubleType()),
    ("lon", T.DoubleType()),
    ("avg_depth", T.DoubleType()),
    ("area", T.StringType()),
)
