"""The provided benchmark tables projected onto the raw schemas.

``events`` stands in for the hourly series, ``orders`` for raster pixels and
``customer`` for coastline vertices; every output row derives from one input row,
so the work grows with the tables.
"""

from __future__ import annotations

from math import ceil, sqrt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagrid.config import Area, RasterGrid
from pelagrid.plans.pipeline import RawTables
from pelagrid.schemas import EXCLUSIONS

# The demo exclusion list.
EXCLUDED = ("GULF_OF_LION_41.25_3.0", "GULF_OF_LION_41.5_3.25")

# The demo's smoke run.
DEMO_SMOKE_SITES = (
    "GULF_OF_LION_41.25_3.0",
    "GULF_OF_LION_41.75_3.75",
    "GULF_OF_LION_42.0_4.5",
)
DEMO_SMOKE_YEAR = 2024

# Study areas over the demo raster; two overlap, one is off.
DEMO_AREAS = (
    Area("gulf_of_lion", 40.5, 44.0, 2.5, 7.0, 0.25, 0.0, -2000.0, True),
    Area("demo_east", 41.3, 45.1, 3.1, 5.9, 0.5, 0.0, -900.0, True),
    Area("demo_off", 41.0, 42.0, 3.0, 4.0, 0.25, 0.0, -2000.0, False),
)

DEMO_RES = 1 / 64


# Columns used, declared so that opening a table costs no job.
TABLES = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double",
    "orders": "o_orderkey long, o_totalprice double",
    "customer": "c_custkey long",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sited_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .selectExpr("*", "pmod(user_id, 60) AS _site", "cast(ts AS timestamp) AS observation_time")
        .selectExpr(
            "*",
            "41.25D + 0.25D * (_site div 12) AS latitude",
            "2.5D + 0.25D * pmod(_site, 12) AS longitude",
        )
        .selectExpr("*", "concat_ws('_', 'GULF_OF_LION', latitude, longitude) AS location_name")
    )


def raw_wind(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    speed = "CASE WHEN event_type != 'error' THEN value * (0.3D + 0.1D * pmod(user_id, 8)) END"
    return _sited_events(spark, sf_dir).selectExpr(
        "location_name",
        "latitude",
        "longitude",
        "observation_time",
        f"{speed} AS wind_speed_100m",
        "cast(pmod(event_id * 37, 360) AS double) AS wind_direction_100m",
        f"{speed} * 0.7D AS wind_speed_10m",
        *keep,
    )


def raw_wave(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return _sited_events(spark, sf_dir).selectExpr(
        "location_name",
        "latitude",
        "longitude",
        "observation_time",
        "value / 40D AS wave_height",
        "cast(pmod(event_id * 53, 360) AS double) AS wave_direction",
        "2D + pmod(_site, 11) + pmod(event_id, 10) / 10D AS wave_period",
        *keep,
    )


def spread_months(hourly: DataFrame, months: int = 18, direction: str = "wind_direction_100m") -> DataFrame:
    """Hourly rows moved over several months by their direction, for the partitioned sinks."""
    moved = F.expr(f"observation_time + make_interval(0, cast(pmod({direction}, {months}) as int))")
    return hourly.withColumn("observation_time", moved)


def _pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .selectExpr("o_orderkey div 128 AS _r", "pmod(o_orderkey, 128) AS _k", "o_totalprice")
        .selectExpr(
            "*",
            "41.015625D + _r * 0.03125D AS latitude",
            "2.515625D + _k * 0.03125D AS longitude",
        )
    )


def raw_bathymetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pixels(spark, sf_dir).selectExpr(
        "latitude",
        "longitude",
        "60D - 12D * _k - 2D * pmod(_r, 40) + o_totalprice % 20D AS elevation_m",
    )


def raw_coastline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pixels(spark, sf_dir).selectExpr(
        "latitude",
        "longitude",
        "abs(_k - 6) * 1.6D + pmod(_r, 40) * 0.4D AS distance_to_coast_km",
    )


def exclusions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(name, None, None, None) for name in EXCLUDED], EXCLUSIONS)


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(
        raw_wind(spark, sf_dir),
        raw_wave(spark, sf_dir),
        raw_bathymetry(spark, sf_dir),
        raw_coastline(spark, sf_dir),
        exclusions(spark),
    )


def coast_raster(spark: SparkSession, sf_dir: str) -> RasterGrid:
    """A square raster whose area is 32 pixels per customer row."""
    side = ceil(sqrt(table(spark, sf_dir, "customer").count() * 32.0))
    return RasterGrid(41.0, 41.0 + side * DEMO_RES, 2.5, 2.5 + side * DEMO_RES, DEMO_RES)


def coast_vertices(spark: SparkSession, sf_dir: str, grid: RasterGrid) -> DataFrame:
    """One (lon, lat) vertex per customer, scattered; some lie out of bounds."""
    key, side = F.col("c_custkey"), F.lit(grid.rows + 3)
    row, col = F.pmod(key * 7919, side), F.pmod(F.floor(key * 104729 / 97), side)
    return table(spark, sf_dir, "customer").select(
        (F.lit(2.5 + DEMO_RES / 2) + col * F.lit(DEMO_RES)).alias("lon"),
        (F.lit(41.0 + DEMO_RES / 2) + row * F.lit(DEMO_RES)).alias("lat"),
    )


def responses(hourly: DataFrame, variables: tuple[str, ...]) -> DataFrame:
    """Hourly rows packed back into service responses, as JSON text.

    ``hourly`` carries ``event_id``: a document holds one site, day and block of
    512 consecutive source rows, so no group depends on how many rows a site has.
    Directions of rows with a low first value are written as text that is not a
    number, and missing first values as NaN.
    """
    first, second, *rest = variables
    text = {
        first: F.coalesce(F.col(first).cast("string"), F.lit("NaN")),
        second: F.when(F.col(first) < 1, F.lit("calm")).otherwise(F.col(second).cast("string")),
        **{v: F.col(v).cast("string") for v in rest},
    }
    entry = F.struct(
        F.date_format("observation_time", "yyyy-MM-dd'T'HH:mm").alias("time"),
        *(column.alias(v) for v, column in text.items()),
    )
    groups = ["location_name", "latitude", "longitude", "_day", "_block"]
    packed = (
        hourly.withColumns(
            {
                "_day": F.to_date("observation_time"),
                "_block": F.floor(F.col("event_id") / 512),
            }
        )
        .groupBy(*groups)
        .agg(F.array_sort(F.collect_list(entry)).alias("_e"))
    )
    document = F.struct(
        "latitude",
        "longitude",
        F.struct(*(F.col(f"_e.{v}").alias(v) for v in ("time", *variables))).alias("hourly"),
    )
    return packed.select("location_name", F.to_json(document).alias("payload"))
