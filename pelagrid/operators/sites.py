"""Site-grain operators: centres, cell sampling and the score columns.

Each one adds columns to whatever site table it is given, so the pipeline can
run them as one chain in which every summary is consumed exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagrid.config import DEFAULT, Curves, Gates, ModelConfig, Weights
from pelagrid.functions import classify, scoring
from pelagrid.functions.grid import cell_key, site_coordinate, surrogate_key
from pelagrid.functions.numeric import rounded, share


def distinct_sites(hourly: DataFrame) -> DataFrame:
    """Site names and keys of an hourly table."""
    names = hourly.select(F.col("location_name").alias("site_name")).distinct()
    return names.withColumn("site_id", surrogate_key(F.col("site_name")))


def locate_sites(sites: DataFrame, from_last_tokens: bool = False) -> DataFrame:
    """Read coordinates from the site name; names without any are dropped."""
    name = F.col("site_name")
    located = sites.withColumns(
        {
            "center_lat": site_coordinate(name, "lat", from_last_tokens),
            "center_lon": site_coordinate(name, "lon", from_last_tokens),
        }
    ).where(F.col("center_lat").isNotNull())
    return located.withColumn("spatial_id", cell_key(F.col("center_lat"), F.col("center_lon")))


def keep_marine(located: DataFrame, depth_cells: DataFrame) -> DataFrame:
    """Sites whose cell has a marine pixel: a semi join, so nothing multiplies."""
    return located.join(depth_cells.select("spatial_id"), "spatial_id", "left_semi")


def sample_cells(
    centres: DataFrame,
    depth_cells: DataFrame,
    coast_cells: DataFrame,
    marine_only: bool = False,
) -> DataFrame:
    """Attach the cell's raster statistics; sites without any stay, with NULLs.

    ``marine_only`` folds ``keep_marine`` into the same join, so that the depth
    cells are computed once. ``sample_count`` is what a pixel-by-pixel join of
    both rasters would count.
    """
    how = "inner" if marine_only else "left"
    joined = centres.join(depth_cells, "spatial_id", how).join(coast_cells, "spatial_id", "left")
    pairs = F.coalesce("bathymetry_pixels", F.lit(0)) * F.greatest(
        F.coalesce("coast_pixels", F.lit(0)), F.lit(1)
    )
    return joined.withColumns(
        {
            "marine_coverage_pct": share(F.col("marine_pixels"), F.col("bathymetry_pixels")),
            "distance_category": classify.site_distance_category(F.col("distance_to_coast_km")),
            "sample_count": pairs.cast("long"),
            "depth_category": classify.depth_category(F.col("depth_m")),
        }
    ).drop("marine_pixels", "bathymetry_pixels", "coast_pixels")


def keep_covered(samples: DataFrame, gates: Gates = DEFAULT.gates) -> DataFrame:
    """Sites with a depth and enough marine coverage."""
    return samples.where(
        F.col("depth_m").isNotNull() & (F.col("marine_coverage_pct") >= gates.min_marine_coverage)
    )


def score_spatial(
    sites: DataFrame, curves: Curves = DEFAULT.curves, gates: Gates = DEFAULT.gates
) -> DataFrame:
    kind, depth, km = F.col("turbine_type"), F.col("depth_m"), F.col("distance_to_coast_km")
    return (
        sites.withColumn("turbine_type", classify.turbine_type(depth, gates))
        .withColumns(
            {
                "depth_score": scoring.depth_score(kind, depth, curves),
                "coast_score": scoring.coast_score(kind, km, curves),
            }
        )
        .withColumn("spatial_score", scoring.spatial_score(F.col("depth_score"), F.col("coast_score")))
    )


def score_wind(
    sites: DataFrame, curves: Curves = DEFAULT.curves, weights: Weights = DEFAULT.weights
) -> DataFrame:
    avg, p50, p90 = (F.col(f"{p}_wind_speed_ms") for p in ("avg", "p50", "p90"))
    return sites.withColumns(
        {
            "avg_score": rounded(scoring.wind_component(avg, curves.avg_wind_ideal), 4),
            "p50_score": rounded(scoring.wind_component(p50, curves.p50_wind_ideal), 4),
            "p90_score": rounded(scoring.wind_component(p90, curves.p90_wind_ideal), 4),
            "wind_score": scoring.wind_score(avg, p50, p90, curves, weights),
            "wind_potential_class": classify.wind_potential_class(avg),
        }
    )


def score_wave(sites: DataFrame, curves: Curves = DEFAULT.curves) -> DataFrame:
    """Needs the site's turbine type next to its wave summary."""
    return sites.withColumns(
        {
            "wave_score": scoring.wave_score(
                F.col("turbine_type"), F.col("avg_wave_height_m"), curves
            ),
            "survivability_class": classify.survivability_class(F.col("max_wave_height_m")),
            "sea_state_class": classify.sea_state_class(F.col("avg_wave_period_s")),
        }
    )


def score_composite(sites: DataFrame, config: ModelConfig = DEFAULT) -> DataFrame:
    total = scoring.weighted_sum(
        F.col("spatial_score"), F.col("wind_score"), F.col("wave_score"), config.weights
    )
    return sites.withColumns(
        {
            "survivability_multiplier": classify.survivability_multiplier(
                F.col("survivability_class"), config.multipliers
            ),
            "raw_final_score": rounded(total, 4),
        }
    ).withColumn(
        "final_score", rounded(F.col("raw_final_score") * F.col("survivability_multiplier"), 4)
    )
