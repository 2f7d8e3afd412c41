"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Columns that a model leaves unrounded are rounded to eight decimals here, and only
here, so that two engines adding in different orders can be compared by value.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagrid.config import DEFAULT, RasterGrid
from pelagrid.operators import cells, gridpoints, raster, summaries
from pelagrid.plans import incremental, materialize, quality_report, reports, validation
from pelagrid.plans.pipeline import Pipeline
from pelagrid.schemas import EXCLUSIONS, RAW_BATHYMETRY, WAVE_VARS, WIND_VARS
from pelagrid.session import scratch_path, stage
from pelagrid.sources import demo, hourly, rasters, reference_data, timeseries, worklist

Query = Callable[[SparkSession, str], DataFrame]

UNROUNDED = {
    "depth_m",
    "depth_min_m",
    "depth_max_m",
    "marine_coverage_pct",
    "distance_to_coast_km",
    "distance_min_km",
    "elevation_m",
    "latitude",
    "longitude",
    "lat",
    "lon",
    "wave_height",
    "wave_period",
    "wind_speed_100m",
    "wind_speed_10m",
    "min_depth",
    "max_depth",
    "min_dist",
    "max_dist",
    "value",
}


# The days that the landed responses were asked for.
LANDED = (dt.date(2024, 1, 1), dt.date(2024, 12, 31))


def comparable(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 8) for c in df.columns if c in UNROUNDED})


def _pipeline(spark: SparkSession, sf_dir: str, shared: bool = False, **changes) -> Pipeline:
    return Pipeline(demo.raw_tables(spark, sf_dir), replace(DEFAULT, **changes), shared)


def _model(name: str, **changes) -> Query:
    return lambda spark, sf_dir: comparable(_pipeline(spark, sf_dir, **changes).model(name))


def _check(check: Callable[[Pipeline], DataFrame], shared: bool = False) -> Query:
    return lambda spark, sf_dir: comparable(check(_pipeline(spark, sf_dir, shared)))


def _approximate(model: str, percents: dict[str, int]) -> Query:
    """A summary by the sketch, whose percentiles are settled by exact counts of their ranks."""
    value = {"wind_summary": "wind_speed_ms", "wave_summary": "wave_height"}[model]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        pipeline = _pipeline(spark, sf_dir, percentiles="approx")
        staged = pipeline.model(f"stg_{model.split('_')[0]}")
        return comparable(summaries.settled(pipeline.model(model), staged, value, percents))

    return query


def _quality(test: str) -> Query:
    return lambda spark, sf_dir: quality_report.run(_pipeline(spark, sf_dir, shared=True), (test,))


def hourly_explode_wind(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = demo.responses(demo.raw_wind(spark, sf_dir, "event_id"), WIND_VARS)
    parsed = hourly.parse_responses(landed, "payload", WIND_VARS)
    return comparable(hourly.explode_hourly(parsed, WIND_VARS))


def hourly_explode_wave(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = demo.responses(demo.raw_wave(spark, sf_dir, "event_id"), WAVE_VARS)
    parsed = hourly.parse_responses(landed, "payload", WAVE_VARS)
    return comparable(hourly.explode_hourly(parsed, WAVE_VARS))


def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request's longer answer, then its final one, which replaces it."""
    root, waves = scratch_path(spark, "landing"), demo.raw_wave(spark, sf_dir)
    later = waves.withColumn("observation_time", F.col("observation_time") + F.expr("INTERVAL 1 DAY"))
    for answer in (waves.unionByName(later), waves):
        hourly.write_landing(answer, root, *LANDED)
    return comparable(hourly.read_landing(spark, root, WAVE_VARS))


def landing_roundtrip_wind(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "landing")
    hourly.write_landing(demo.raw_wind(spark, sf_dir), root, *LANDED)
    return comparable(hourly.read_landing(spark, root, WIND_VARS))


def append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain appends: what is loaded twice is stored twice."""
    path = scratch_path(spark, "wind")
    for _ in range(2):
        timeseries.append_hourly(demo.spread_months(demo.raw_wind(spark, sf_dir)), path)
    return comparable(timeseries.read_hourly(spark, path, WIND_VARS))


def month_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load, then load again: the merge leaves one row per site and time.

    Rows with a direction that 45 divides lose their time: they have no key and no month.
    """
    path = scratch_path(spark, "wind")
    wind = demo.spread_months(demo.raw_wind(spark, sf_dir))
    timed = F.when(F.col("wind_direction_100m") % 45 != 0, F.col("observation_time"))
    wind = wind.withColumn("observation_time", timed)
    timeseries.merge_hourly(wind.where(F.col("wind_speed_100m").isNotNull()), path)
    timeseries.merge_hourly(wind, path)
    return comparable(timeseries.read_hourly(spark, path, WIND_VARS))


def _summary_by_month(read: Callable[..., DataFrame], series: incremental.Series) -> Query:
    """A summary from monthly states: the months up to 2024-09 first, then the rest and a late row of each."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        table, states = scratch_path(spark, "hourly"), scratch_path(spark, "states")
        rows = demo.spread_months(read(spark, sf_dir), direction=series.variables[1])
        early = F.col("observation_time") < F.lit("2024-09-01").cast("timestamp")
        late = F.col(series.variables[1]) % 7 == 0
        for batch in (rows.where(early & ~late), rows.where(~early | late)):
            timeseries.append_hourly(batch, table)
            incremental.refresh(spark, table, states, series)
        return incremental.summary(incremental.read_states(spark, states, series), series)

    return query


def wind_summary_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wind summary from states that a bucketed table gives without a shuffle of its rows."""
    rows = demo.spread_months(demo.raw_wind(spark, sf_dir))
    timeseries.save_bucketed(rows, "raw_wind_bucketed", 8)
    states = incremental.month_states(spark.table("raw_wind_bucketed"), incremental.WIND)
    return incremental.summary(states, incremental.WIND)


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, NULLs and time span of the wind table, counted by the write that loads it."""
    path = scratch_path(spark, "wind")
    report = timeseries.append_hourly(demo.raw_wind(spark, sf_dir), path)
    lines = [(c, report.rows, n, report.first, report.last) for c, n in report.nulls.items()]
    schema = "column_name string, row_count long, null_count long, first_time timestamp, last_time timestamp"
    return spark.createDataFrame(lines, schema)


def backfill_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = demo.spread_months(demo.raw_wind(spark, sf_dir))
    return worklist.missing_hours(_requests(spark, sf_dir), stored)


def smoke_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = demo.raw_tables(spark, sf_dir).smoke(demo.DEMO_SMOKE_SITES, demo.DEMO_SMOKE_YEAR)
    return comparable(Pipeline(raw).model("stg_wind"))


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = demo.raw_wave(spark, sf_dir).select("location_name").distinct()
    return worklist.backfill_requests(registry, 2023, 2026)


def backfill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = demo.spread_months(demo.raw_wind(spark, sf_dir))
    return worklist.missing_requests(_requests(spark, sf_dir), stored)


def load_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = demo.spread_months(demo.raw_wind(spark, sf_dir))
    return timeseries.loaded_rows(_requests(spark, sf_dir), stored)


def load_guard_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request for every site and day of the wave table."""
    day = F.to_date("observation_time")
    waves = demo.raw_wave(spark, sf_dir)
    requests = waves.select("location_name", day.alias("start_date"), day.alias("end_date")).distinct()
    return timeseries.loaded_rows(requests, demo.spread_months(demo.raw_wind(spark, sf_dir)))


def exclusions_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranked table under an exclusion list that was written as CSV and read back."""
    path = scratch_path(spark, "exclusions")
    listed = demo.raw_wave(spark, sf_dir).where(F.col("location_name").endswith("_3.0"))
    rows = listed.select(F.col("location_name").alias("site_name")).distinct()
    empty = {f.name: F.lit(None).cast(f.dataType) for f in EXCLUSIONS if f.name != "site_name"}
    rows.withColumns(empty).select(*EXCLUSIONS.fieldNames()).write.option("header", True).csv(path)
    raw = replace(demo.raw_tables(spark, sf_dir), exclusions=reference_data.read_exclusions(spark, path))
    return comparable(Pipeline(raw, DEFAULT).model("mart_prioritization"))


def truncated_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a raw table before and after it is emptied."""
    table = f"raw_wave_{uuid.uuid4().hex}"
    demo.raw_wave(spark, sf_dir).write.saveAsTable(table)
    before = spark.table(table).agg(F.count(F.lit(1)).alias("rows_before"))
    before = stage(before)
    timeseries.truncate_tables(spark, table, f"{table}_missing")
    after = stage(spark.table(table).agg(F.count(F.lit(1)).alias("rows_after")))
    spark.sql(f"DROP TABLE {table}")
    return before.withColumn("_k", F.lit(1)).join(after.withColumn("_k", F.lit(1)), "_k").drop("_k")


def published_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map export read back from its published table."""
    pipeline = _pipeline(spark, sf_dir, shared=True)
    for _ in range(2):  # published again: the tables are switched over
        materialize.publish_marts(spark, pipeline, database="site_marts_query")
    return comparable(spark.table("site_marts_query.mart_gis"))


def tile_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles written apart, read back together, loaded as one table."""
    extent = RasterGrid(41.0, 45.0, 2.75, 6.25)
    pixels = demo.raw_bathymetry(spark, sf_dir).toDF("lat", "lon", "z")
    tiles, table = scratch_path(spark, "tiles"), scratch_path(spark, "bathymetry")
    rasters.write_tiles(rasters.clip_marine(pixels, extent), tiles, tile_deg=1.0)
    west = rasters.read_bathymetry(spark, tiles).where(F.col("tile_col") < 4)
    east = rasters.read_bathymetry(spark, tiles).where(F.col("tile_col") >= 4)
    columns = ["latitude", "longitude", "elevation_m"]
    rasters.load_tiles([west.select(*columns), east.select(*columns)], table)
    return comparable(rasters.read_bathymetry(spark, table))


def curve_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depths of the smoke sites' cells from a raster laid out along a curve."""
    path = scratch_path(spark, "curve")
    rasters.write_curve(demo.raw_bathymetry(spark, sf_dir), path)
    sites = [tuple(float(x) for x in name.split("_")[-2:]) for name in demo.DEMO_SMOKE_SITES]
    return comparable(cells.cell_depths(rasters.read_curve(spark, path, RAW_BATHYMETRY, sites)))


def grid_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = reference_data.active_areas(spark, demo.DEMO_AREAS)
    return comparable(gridpoints.grid_points(demo.raw_bathymetry(spark, sf_dir), areas))


def site_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid points written as JSON and read back as the site dimension."""
    path = scratch_path(spark, "grid-points")
    areas = reference_data.active_areas(spark, demo.DEMO_AREAS)
    reference_data.write_grid_points(
        gridpoints.grid_points(demo.raw_bathymetry(spark, sf_dir), areas), path
    )
    return comparable(reference_data.read_registry(spark, path))


def coast_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = demo.coast_raster(spark, sf_dir)
    return raster.rasterise_vertices(demo.coast_vertices(spark, sf_dir, grid), grid)


def coast_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = demo.coast_raster(spark, sf_dir)
    return comparable(raster.coast_distances(demo.coast_vertices(spark, sf_dir, grid), grid))


def strip_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = demo.coast_raster(spark, sf_dir)
    root = scratch_path(spark, "strips")
    distances = raster.coast_distances(demo.coast_vertices(spark, sf_dir, grid), grid)
    rasters.write_strips(distances, root, grid, strip_rows=50)
    return comparable(rasters.read_strips(spark, root))


def dashboard_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = _pipeline(spark, sf_dir).model("mart_prioritization")
    return reports.dashboard_slice(mart, "floating", "medium", "high")


def dashboard_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_ranked(_pipeline(spark, sf_dir).model("mart_prioritization"))


QUERIES: dict[str, Query] = {
    "stg_wind": _model("stg_wind"),
    "stg_wave": _model("stg_wave"),
    "stg_bathymetry": _model("stg_bathymetry"),
    "stg_coastline_distance": _model("stg_coastline_distance"),
    "site_centers": _model("site_centers"),
    "spatial_samples": _model("spatial_samples"),
    "spatial_summary": _model("spatial_summary"),
    "spatial_score": _model("spatial_score"),
    "wind_summary": _model("wind_summary"),
    "wind_summary_approx": _approximate("wind_summary", {"p50_wind_speed_ms": 50, "p90_wind_speed_ms": 90}),
    "wind_score": _model("wind_score"),
    "wave_summary": _model("wave_summary"),
    "wave_summary_approx": _approximate("wave_summary", {"p90_wave_height_m": 90, "p95_wave_height_m": 95}),
    "wave_score": _model("wave_score"),
    "composite": _model("composite"),
    "composite_unfiltered": _model("composite_unfiltered"),
    "mart_prioritization": _model("mart_prioritization"),
    "mart_gis": _model("mart_gis"),
    "gis_rank_viable_only": _model("mart_gis", rank_scope="viable"),
    "hourly_explode_wind": hourly_explode_wind,
    "hourly_explode_wave": hourly_explode_wave,
    "landing_roundtrip": landing_roundtrip,
    "landing_roundtrip_wind": landing_roundtrip_wind,
    "append_roundtrip": append_roundtrip,
    "month_partition_roundtrip": month_partition_roundtrip,
    "wind_summary_by_month": _summary_by_month(demo.raw_wind, incremental.WIND),
    "wave_summary_by_month": _summary_by_month(demo.raw_wave, incremental.WAVE),
    "wind_summary_bucketed": wind_summary_bucketed,
    "load_report": load_report,
    "backfill_gaps": backfill_gaps,
    "smoke_subset": smoke_subset,
    "backfill_missing": backfill_missing,
    "load_guard": load_guard,
    "load_guard_daily": load_guard_daily,
    "exclusions_csv": exclusions_csv,
    "truncated_table": truncated_table,
    "published_marts": published_marts,
    "tile_union": tile_union,
    "curve_cells": curve_cells,
    "grid_points": grid_points,
    "site_registry": site_registry,
    "coast_raster": coast_raster,
    "coast_distance": coast_distance,
    "strip_roundtrip": strip_roundtrip,
    "unique_report": _quality("unique"),
    "not_null_report": _quality("not_null"),
    "accepted_values_report": _quality("accepted_values"),
    "v1_site_counts": _check(validation.site_counts, shared=True),
    "v2_viability_breakdown": _check(validation.viability_breakdown),
    "v3_turbine_distribution": _check(validation.turbine_distribution),
    "v4_rank_nulls": _check(validation.rank_nulls),
    "v5_coordinate_bounds": _check(validation.coordinate_bounds),
    "v6_depth_plausibility": _check(validation.depth_plausibility),
    "v7_distance_plausibility": _check(validation.distance_plausibility),
    "v8_gate_boundary": _check(validation.gate_boundary),
    "v9_score_distribution": _check(validation.score_distribution),
    "v10_score_deciles": _check(validation.score_deciles),
    "v11_ceiling_floor": _check(validation.ceiling_floor),
    "v12_wind_wave_correlation": _check(validation.wind_wave_correlation),
    "v13_survivability_distribution": _check(validation.survivability_distribution),
    "v14_penalised_sites": _check(validation.penalised_sites),
    "v15_turbine_consistency": _check(validation.turbine_consistency),
    "v16_top_sites": _check(validation.top_sites),
    "v16_bottom_sites": _check(validation.bottom_sites),
    "v17_weight_sensitivity": _check(validation.weight_sensitivity),
    "v18_gate_violations": _check(validation.gate_violations),
    "v19_summary": _check(validation.summary, shared=True),
    "dashboard_slice": dashboard_slice,
    "dashboard_top10": dashboard_top10,
}
