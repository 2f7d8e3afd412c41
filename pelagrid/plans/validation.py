"""The analyst checklist: what the built tables should look like."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagrid.config import DEFAULT, FLAG_VIABLE, Gates, Weights
from pelagrid.functions.classify import near_gate, violates_gates
from pelagrid.functions.scoring import weighted_sum
from pelagrid.functions.numeric import rounded
from pelagrid.operators import ranking
from pelagrid.plans.pipeline import Pipeline

# Bounds of the study region used by the coordinate check.
LAT_BOUNDS, LON_BOUNDS = (41.0, 44.0), (2.0, 6.5)

# The alternative weightings of the sensitivity check.
ALTERNATIVE_WEIGHTS = {
    "alt_rank_35_45_20": Weights(0.35, 0.45, 0.20),
    "alt_rank_45_35_20": Weights(0.45, 0.35, 0.20),
    "alt_rank_equal": Weights(0.33, 0.34, 0.33),
}


def _count(condition: Column | None = None) -> Column:
    return F.count(F.lit(1)) if condition is None else F.count_if(condition)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def site_counts(p: Pipeline) -> DataFrame:
    """Sites at each layer; drops between layers must be explainable."""
    distinct = p.model("site_centers").agg(F.count_distinct("site_name").alias("site_count"))
    layers = ["composite_unfiltered", "composite", "mart_prioritization", "mart_gis"]
    counted = [p.model(name).agg(_count().alias("site_count")) for name in layers]
    return _union(
        [
            df.select(F.lit(name).alias("layer"), "site_count")
            for name, df in zip(["site_centers", *layers], [distinct, *counted])
        ]
    )


def viability_breakdown(p: Pipeline) -> DataFrame:
    return p.model("mart_gis").groupBy("viability_flag").agg(_count().alias("site_count"))


def turbine_distribution(p: Pipeline) -> DataFrame:
    depth = F.col("depth_m")
    return (
        p.model("composite_unfiltered")
        .groupBy("turbine_type")
        .agg(
            _count().alias("site_count"),
            rounded(F.avg(depth), 2).alias("avg_depth_m"),
            rounded(F.min(depth), 2).alias("min_depth_m"),
            rounded(F.max(depth), 2).alias("max_depth_m"),
        )
    )


def rank_nulls(p: Pipeline) -> DataFrame:
    """Only viable sites may carry a rank."""
    rank = F.col("site_rank")
    return (
        p.model("mart_gis")
        .groupBy("viability_flag")
        .agg(
            _count().alias("total"),
            _count(rank.isNull()).alias("null_rank"),
            _count(rank.isNotNull()).alias("has_rank"),
        )
    )


def coordinate_bounds(
    p: Pipeline,
    lat: tuple[float, float] = LAT_BOUNDS,
    lon: tuple[float, float] = LON_BOUNDS,
) -> DataFrame:
    y, x = F.col("center_lat"), F.col("center_lon")
    return p.model("composite_unfiltered").agg(
        _count().alias("total_sites"),
        _count(y.between(*lat)).alias("lat_in_bounds"),
        _count(x.between(*lon)).alias("lon_in_bounds"),
        F.min(y).alias("min_lat"),
        F.max(y).alias("max_lat"),
        F.min(x).alias("min_lon"),
        F.max(x).alias("max_lon"),
    )


def depth_plausibility(p: Pipeline) -> DataFrame:
    d = F.col("depth_m")
    return p.model("composite_unfiltered").agg(
        _count().alias("total"),
        _count(d < 0).alias("negative_depths"),
        _count(d == 0).alias("zero_depths"),
        _count(d > 3000).alias("implausibly_deep"),
        F.min(d).alias("min_depth"),
        F.max(d).alias("max_depth"),
        rounded(F.avg(d), 2).alias("avg_depth"),
    )


def distance_plausibility(p: Pipeline) -> DataFrame:
    d = F.col("distance_to_coast_km")
    return p.model("composite_unfiltered").agg(
        _count().alias("total"),
        _count(d <= 0).alias("zero_or_negative"),
        _count(d > 200).alias("implausibly_far"),
        F.min(d).alias("min_dist"),
        F.max(d).alias("max_dist"),
        rounded(F.avg(d), 2).alias("avg_dist"),
    )


def gate_boundary(p: Pipeline) -> DataFrame:
    """Viable sites just inside a gate, nearest to the coast first."""
    near = near_gate(F.col("depth_m"), F.col("turbine_type"), F.col("distance_to_coast_km"))
    return (
        p.model("mart_gis")
        .where((F.col("viability_flag") == FLAG_VIABLE) & near)
        .select(
            "site_name",
            "center_lat",
            "center_lon",
            "depth_m",
            "turbine_type",
            "distance_to_coast_km",
            "final_score",
            "viability_flag",
        )
        .orderBy("distance_to_coast_km")
    )


def score_distribution(p: Pipeline) -> DataFrame:
    measures = {"min": F.min, "max": F.max, "avg": F.avg, "stddev": F.stddev_samp}
    return p.model("composite").agg(
        *(
            rounded(measure(f"{score}_score"), 3).alias(f"{score}_{name}")
            for score in ("spatial", "wind", "wave", "final")
            for name, measure in measures.items()
        )
    )


def score_deciles(p: Pipeline) -> DataFrame:
    scores = p.model("composite").select("final_score")
    return (
        ranking.value_tiles(scores, "final_score", 10, "decile")
        .groupBy("decile")
        .agg(
            rounded(F.min("final_score"), 3).alias("min_score"),
            rounded(F.max("final_score"), 3).alias("max_score"),
            F.sum("n").alias("site_count"),
        )
    )


def ceiling_floor(p: Pipeline) -> DataFrame:
    return p.model("composite").agg(
        _count(F.col("wind_score") == 1.0).alias("wind_at_ceiling"),
        _count(F.col("spatial_score") == 1.0).alias("spatial_at_ceiling"),
        _count(F.col("wave_score") == 0.0).alias("wave_at_floor"),
        _count(F.col("wind_score") == 0.0).alias("wind_at_floor"),
        _count().alias("total_sites"),
    )


def wind_wave_correlation(p: Pipeline) -> DataFrame:
    return p.model("composite").agg(
        rounded(F.corr("wind_score", "wave_score"), 3).alias("wind_wave_score_corr"),
        rounded(F.corr("avg_wind_speed_ms", "avg_wave_height_m"), 3).alias(
            "windspeed_waveheight_corr"
        ),
    )


def survivability_distribution(p: Pipeline) -> DataFrame:
    return (
        p.model("composite")
        .groupBy("survivability_class", "turbine_type")
        .agg(
            _count().alias("site_count"),
            rounded(F.avg("raw_final_score"), 3).alias("avg_raw_score"),
            rounded(F.avg("final_score"), 3).alias("avg_final_score"),
            rounded(F.avg("survivability_multiplier"), 3).alias("avg_multiplier"),
        )
    )


def penalised_sites(p: Pipeline) -> DataFrame:
    raw, final = F.col("raw_final_score"), F.col("final_score")
    return (
        p.model("composite")
        .where(F.col("survivability_multiplier") < 1.0)
        .select(
            "site_name",
            "survivability_class",
            "survivability_multiplier",
            rounded(raw, 3).alias("raw_final_score"),
            rounded(final, 3).alias("final_score"),
            rounded(raw - final, 3).alias("score_lost_to_penalty"),
        )
        .orderBy(F.desc("score_lost_to_penalty"))
    )


def turbine_consistency(p: Pipeline) -> DataFrame:
    return (
        p.model("spatial_score")
        .where(F.col("turbine_type") != "not_viable")
        .groupBy("turbine_type")
        .agg(
            _count().alias("site_count"),
            rounded(F.avg("depth_m"), 1).alias("avg_depth_m"),
            rounded(F.avg("distance_to_coast_km"), 1).alias("avg_dist_km"),
            rounded(F.avg("spatial_score"), 3).alias("avg_spatial_score"),
            rounded(F.avg("depth_score"), 3).alias("avg_depth_score"),
            rounded(F.avg("coast_score"), 3).alias("avg_coast_score"),
        )
    )


def _spot_check(mart: DataFrame) -> DataFrame:
    scores = ("spatial_score", "wind_score", "wave_score", "raw_final_score", "final_score")
    return mart.withColumns({s: rounded(F.col(s), 3) for s in scores}).select(
        "site_rank",
        "site_name",
        "center_lat",
        "center_lon",
        "turbine_type",
        "depth_m",
        "distance_to_coast_km",
        "spatial_score",
        "wind_score",
        "wave_score",
        "survivability_class",
        "survivability_multiplier",
        "raw_final_score",
        "final_score",
    )


def top_sites(p: Pipeline, n: int = 10) -> DataFrame:
    return _spot_check(p.model("mart_prioritization")).orderBy(F.asc("site_rank")).limit(n)


def bottom_sites(p: Pipeline, n: int = 10) -> DataFrame:
    last = _spot_check(p.model("mart_prioritization")).orderBy(F.desc("site_rank")).limit(n)
    return last.drop("survivability_multiplier", "raw_final_score")


def weight_sensitivity(p: Pipeline, n: int = 20) -> DataFrame:
    """Ranks under other weightings; stable top ranks mean a robust result.

    The cut keeps the best n; equal ranks at the cut are ordered by name.
    """
    scores = [F.col(f"{s}_score") for s in ("spatial", "wind", "wave")]
    ranked = ranking.rank(
        p.model("composite").select("site_name", "final_score", "spatial_score", "wind_score", "wave_score"),
        {
            "current_rank_40_40_20": F.col("final_score"),
            **{name: weighted_sum(*scores, w) for name, w in ALTERNATIVE_WEIGHTS.items()},
        },
    )
    return (
        ranked.select(
            "site_name",
            "current_rank_40_40_20",
            *ALTERNATIVE_WEIGHTS,
            rounded(F.col("final_score"), 3).alias("final_score"),
        )
        .orderBy(F.asc("current_rank_40_40_20"), F.asc("site_name"))
        .limit(n)
    )


def gate_violations(p: Pipeline, gates: Gates = DEFAULT.gates) -> DataFrame:
    """Ranked sites that break a physical rule; must be empty."""
    depth, kind, km = F.col("depth_m"), F.col("turbine_type"), F.col("distance_to_coast_km")
    return (
        p.model("composite")
        .where(violates_gates(depth, kind, km, gates))
        .select("site_name", "turbine_type", "depth_m", "distance_to_coast_km")
    )


def summary(p: Pipeline, expected_sites: int = 102) -> DataFrame:
    """(check, value, passed) for every line of the checklist that SQL can decide."""
    bounds, depths = coordinate_bounds(p), depth_plausibility(p)
    scores, corr = score_distribution(p), wind_wave_correlation(p)
    stray = p.model("mart_gis").where(
        (F.col("viability_flag") != FLAG_VIABLE) & F.col("site_rank").isNotNull()
    )
    outside = 2 * F.col("total_sites") - F.col("lat_in_bounds") - F.col("lon_in_bounds")

    def row(check: str, df: DataFrame, value: Column, passed: Column) -> DataFrame:
        v = value.cast("double")
        ok = F.coalesce(passed, F.lit(False))
        return df.select(F.lit(check).alias("check_name"), v.alias("value"), ok.alias("passed"))

    def counted(check: str, df: DataFrame, expected: int) -> DataFrame:
        return row(check, df.agg(_count().alias("n")), F.col("n"), F.col("n") == expected)

    return _union(
        [
            counted("sites_in_gis_mart", p.model("mart_gis"), expected_sites),
            counted("sites_in_unfiltered", p.model("composite_unfiltered"), expected_sites),
            row("no_negative_depths", depths, F.col("negative_depths"), F.col("negative_depths") == 0),
            row("coordinates_in_bounds", bounds, outside, outside == 0),
            counted("gate_consistency", gate_violations(p), 0),
            row("score_range_adequate", scores, F.col("final_stddev"), F.col("final_stddev") > 0.05),
            row(
                "wind_wave_correlation",
                corr,
                F.col("wind_wave_score_corr"),
                F.col("wind_wave_score_corr") < 0.7,
            ),
            counted("excluded_have_null_rank", stray, 0),
        ]
    )
