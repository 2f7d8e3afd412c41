"""The model graph: raw tables to ranked sites.

``site_facts`` is the whole scoring as one chain at site grain. Every model of
the scoring layers is a projection or filter of it, or of a prefix of it, so a
mart scans the wind and wave series once each and every raster once per use.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagrid.config import DEFAULT, FLAG_VIABLE, SMOKE_SITES, SMOKE_YEAR, ModelConfig
from pelagrid.functions.classify import passes_gates, viability_flag
from pelagrid.operators import cells, joins, ranking, sites, staging, summaries
from pelagrid.session import stage

SITE_KEYS = ["site_name", "site_id", "spatial_id", "center_lat", "center_lon"]

CENTERS = ["site_name", "site_id", "center_lat", "center_lon", "spatial_id"]
SAMPLES = [
    *SITE_KEYS,
    "depth_m",
    "depth_min_m",
    "depth_max_m",
    "marine_coverage_pct",
    "distance_to_coast_km",
    "distance_min_km",
    "distance_category",
    "sample_count",
    "depth_category",
]
SPATIAL_SUMMARY = [
    *SITE_KEYS,
    "depth_m",
    "depth_min_m",
    "depth_max_m",
    "depth_category",
    "distance_to_coast_km",
    "distance_min_km",
    "distance_category",
    "sample_count",
    "marine_coverage_pct",
]
SPATIAL_SCORE = [
    *SITE_KEYS,
    "depth_m",
    "depth_category",
    "turbine_type",
    "distance_to_coast_km",
    "distance_category",
    "sample_count",
    "depth_score",
    "coast_score",
    "spatial_score",
]
WIND_SCORE = [
    "site_id",
    "site_name",
    "avg_wind_speed_ms",
    "p50_wind_speed_ms",
    "p90_wind_speed_ms",
    "wind_stddev",
    "max_gust_ms",
    "wind_power_potential_index",
    "avg_score",
    "p50_score",
    "p90_score",
    "wind_score",
    "wind_potential_class",
]
WAVE_SCORE = [
    "site_id",
    "site_name",
    "turbine_type",
    "avg_wave_height_m",
    "max_wave_height_m",
    "avg_wave_period_s",
    "wave_score",
    "survivability_class",
    "sea_state_class",
]
COMPOSITE = [
    *SITE_KEYS,
    "depth_m",
    "turbine_type",
    "distance_to_coast_km",
    "spatial_score",
    "avg_wind_speed_ms",
    "wind_power_potential_index",
    "wind_potential_class",
    "wind_score",
    "avg_wave_height_m",
    "max_wave_height_m",
    "avg_wave_period_s",
    "sea_state_class",
    "survivability_class",
    "wave_score",
    "survivability_multiplier",
    "raw_final_score",
    "final_score",
]


def best_first() -> list[Column]:
    """Rank order: final score, then wind, then name, which is unique."""
    return [F.desc("final_score"), F.desc("avg_wind_speed_ms"), F.asc("site_name")]


@dataclass(frozen=True)
class RawTables:
    """The five inputs of the model graph."""

    wind: DataFrame
    wave: DataFrame
    bathymetry: DataFrame
    coastline: DataFrame
    exclusions: DataFrame

    def smoke(self, names: tuple[str, ...] = SMOKE_SITES, year: int | None = SMOKE_YEAR) -> RawTables:
        """Few sites and one year of weather; the rasters stay whole."""
        return replace(
            self,
            wind=staging.smoke_subset(self.wind, names, year),
            wave=staging.smoke_subset(self.wave, names, year),
        )


class Pipeline:
    """Lazily built models, each built once per pipeline object.

    ``shared=True`` checkpoints the four aggregates that many models build on
    (wind and wave summaries, depth and coast cells). Use it when several models
    are run from one pipeline; a single model is cheaper without.
    """

    def __init__(self, raw: RawTables, config: ModelConfig = DEFAULT, shared: bool = False):
        self.raw = raw
        self.config = config
        self.shared = shared
        self._built: dict[str, DataFrame] = {}

    def model(self, name: str) -> DataFrame:
        if name not in MODELS:
            raise KeyError(f"no model named {name!r}; known: {', '.join(MODELS)}")
        return self._once(name, lambda: MODELS[name](self))

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._built:
            self._built[name] = build()
        return self._built[name]

    def _aggregate(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return self._once(name, lambda: stage(build()) if self.shared else build())

    # Aggregates of the large tables.

    def wind_summary(self) -> DataFrame:
        c = self.config
        return self._aggregate(
            "_wind",
            lambda: summaries.wind_summary(self.model("stg_wind"), c.weather, c.percentiles),
        )

    def wave_summary(self) -> DataFrame:
        c = self.config
        return self._aggregate(
            "_wave",
            lambda: summaries.wave_summary(self.model("stg_wave"), c.weather, c.percentiles),
        )

    def depth_cells(self) -> DataFrame:
        return self._aggregate("_depth", lambda: cells.cell_depths(self.raw.bathymetry))

    def coast_cells(self) -> DataFrame:
        raw = self.raw
        return self._aggregate(
            "_coast",
            lambda: cells.cell_coast_distances(raw.coastline, raw.bathymetry, self.config.gates),
        )

    # The site-grain chain.

    def _located(self, named: DataFrame) -> DataFrame:
        return sites.locate_sites(named, self.config.coords_from_last_tokens)

    def _sampled(self, named: DataFrame) -> DataFrame:
        return sites.sample_cells(
            self._located(named), self.depth_cells(), self.coast_cells(), marine_only=True
        )

    def _spatial(self, named: DataFrame) -> DataFrame:
        c = self.config
        return sites.score_spatial(
            sites.keep_covered(self._sampled(named), c.gates), c.curves, c.gates
        )

    def _with_waves(self, spatial: DataFrame) -> DataFrame:
        joined = spatial.join(self.wave_summary().drop("site_name"), "site_id")
        return sites.score_wave(joined, self.config.curves)

    def _names(self) -> DataFrame:
        """All sites with wind rows, from whichever source is already small."""
        if self.shared:
            return self.wind_summary().select("site_name", "site_id")
        return sites.distinct_sites(self.model("stg_wind"))

    def site_facts(self) -> DataFrame:
        """Every score column of every marine site with wind and wave data."""
        c = self.config

        def build() -> DataFrame:
            scored = sites.score_wind(self.wind_summary(), c.curves, c.weights)
            return sites.score_composite(self._with_waves(self._spatial(scored)), c)

        return self._once("_facts", build)

    def composite(self) -> DataFrame:
        gated = passes_gates(
            F.col("depth_m"), F.col("turbine_type"), F.col("distance_to_coast_km"), self.config.gates
        )
        viable = self.site_facts().where((F.col("turbine_type") != "not_viable") & gated)
        return viable.select(*COMPOSITE)

    def composite_unfiltered(self) -> DataFrame:
        flagged = joins.flag_in(self.site_facts(), "site_name", self.raw.exclusions, "_manual")
        flag = viability_flag(
            F.col("_manual"),
            F.col("depth_m"),
            F.col("turbine_type"),
            F.col("distance_to_coast_km"),
            self.config.gates,
        )
        return flagged.select(*COMPOSITE, flag.alias("viability_flag"))

    def mart_prioritization(self) -> DataFrame:
        """Viable sites that are not excluded by hand, ranked."""
        kept = joins.not_in(self.model("composite"), "site_name", self.raw.exclusions)
        return ranking.row_number(kept, best_first(), "site_rank").select("site_rank", *COMPOSITE)

    def mart_gis(self) -> DataFrame:
        """All marine sites with the reason each one is or is not ranked.

        With ``rank_scope="all"`` ranks count every row and are shown for viable
        ones, so they have gaps; with ``"viable"`` they run 1..n.
        """
        unfiltered = self.model("composite_unfiltered")
        viable = F.col("viability_flag") == FLAG_VIABLE
        first = [viable.desc()] if self.config.rank_scope == "viable" else []
        ranked = ranking.row_number(unfiltered, [*first, *best_first()], "_rank").withColumn(
            "site_rank", F.when(viable, F.col("_rank"))
        )
        return ranked.select("site_rank", *COMPOSITE, "viability_flag").orderBy(
            F.asc("viability_flag"), F.desc("final_score")
        )


# Model name to builder, in dependency order. The layer is the name's prefix:
# staging views, intermediate views, and the two tables analysts read.
MODELS: dict[str, Callable[[Pipeline], DataFrame]] = {
    "stg_wind": lambda p: staging.stg_wind(p.raw.wind),
    "stg_wave": lambda p: staging.stg_wave(p.raw.wave),
    "stg_bathymetry": lambda p: staging.stg_bathymetry(p.raw.bathymetry),
    "stg_coastline_distance": lambda p: staging.stg_coastline_distance(
        p.raw.coastline, p.raw.bathymetry, p.config.gates
    ),
    "site_centers": lambda p: sites.keep_marine(p._located(p._names()), p.depth_cells()).select(
        *CENTERS
    ),
    "spatial_samples": lambda p: p._sampled(p._names()).select(*SAMPLES),
    "spatial_summary": lambda p: sites.keep_covered(
        p.model("spatial_samples"), p.config.gates
    ).select(*SPATIAL_SUMMARY),
    "spatial_score": lambda p: p._spatial(p._names()).select(*SPATIAL_SCORE),
    "wind_summary": Pipeline.wind_summary,
    "wind_score": lambda p: sites.score_wind(
        p.wind_summary(), p.config.curves, p.config.weights
    ).select(*WIND_SCORE),
    "wave_summary": Pipeline.wave_summary,
    "wave_score": lambda p: p._with_waves(p._spatial(p._names())).select(*WAVE_SCORE),
    "composite": Pipeline.composite,
    "composite_unfiltered": Pipeline.composite_unfiltered,
    "mart_prioritization": Pipeline.mart_prioritization,
    "mart_gis": Pipeline.mart_gis,
}

STAGING = tuple(m for m in MODELS if m.startswith("stg_"))
MARTS = tuple(m for m in MODELS if m.startswith("mart_"))
INTERMEDIATE = tuple(m for m in MODELS if m not in STAGING + MARTS)
