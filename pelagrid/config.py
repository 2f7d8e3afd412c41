"""Every threshold, weight and extent of the suitability model, as frozen data.

Operators take these objects as arguments, so a sensitivity run is a
``dataclasses.replace`` away. Category bounds stand beside their names in ``functions/classify.py``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import ceil, cos, radians

# Cell size in degrees of the analysis grid.
CELL_DEG = 0.25

# The three smoke-run sites and their year.
SMOKE_SITES = ("GULF_OF_LION_43.0_4.0", "GULF_OF_LION_42.75_3.75", "GULF_OF_LION_42.5_3.5")
SMOKE_YEAR = 2023

# First and last year of the historical backfill.
BACKFILL_YEARS = (2006, 2024)

# The flag texts of the map-export table.
FLAG_VIABLE = "viable"
FLAG_MANUAL = "excluded: manual review — centroid plots on land"
FLAG_SHALLOW = "excluded: depth < 10m"
FLAG_DEEP = "excluded: depth > 1000m"
FLAG_TYPE = "excluded: not viable"
FLAG_FIXED_NEAR = "excluded: fixed < 11km coast"
FLAG_FLOATING_NEAR = "excluded: floating < 5km coast"
VIABILITY_FLAGS = (
    FLAG_VIABLE,
    FLAG_SHALLOW,
    FLAG_DEEP,
    FLAG_TYPE,
    FLAG_FIXED_NEAR,
    FLAG_FLOATING_NEAR,
    FLAG_MANUAL,
)


@dataclass(frozen=True)
class Curves:
    """Shapes of the 0..1 scoring curves (metres, kilometres, m/s)."""

    fixed_depth_span: float = 200.0
    fixed_coast_span: float = 200.0
    floating_depth_peak: float = 180.0
    floating_depth_width: float = 200.0
    floating_coast_peak: float = 35.0
    floating_coast_width: float = 60.0
    avg_wind_ideal: float = 12.0
    p50_wind_ideal: float = 10.0
    p90_wind_ideal: float = 18.0
    fixed_wave_limit: float = 4.0
    floating_wave_limit: float = 6.0


@dataclass(frozen=True)
class Weights:
    """Linear weights of the wind and composite scores."""

    spatial: float = 0.40
    wind: float = 0.40
    wave: float = 0.20
    wind_avg: float = 0.40
    wind_p50: float = 0.40
    wind_p90: float = 0.20


@dataclass(frozen=True)
class Gates:
    """Physical limits a site must meet to be ranked."""

    min_depth_m: float = 10.0
    max_depth_m: float = 1000.0
    fixed_max_depth_m: float = 50.0
    fixed_min_coast_km: float = 11.0
    floating_min_coast_km: float = 5.0
    min_marine_coverage: float = 0.90
    min_pixel_coast_km: float = 2.0


@dataclass(frozen=True)
class Multipliers:
    """Penalty on the final score per survivability class."""

    high: float = 1.0
    medium: float = 0.9
    low: float = 0.7


@dataclass(frozen=True)
class WeatherLimits:
    """Operating windows used by the availability ratios."""

    cut_in_ms: float = 6.0
    cut_out_ms: float = 25.0
    maintenance_wave_m: float = 1.5


@dataclass(frozen=True)
class ModelConfig:
    """Bundle handed to the pipeline."""

    curves: Curves = field(default_factory=Curves)
    weights: Weights = field(default_factory=Weights)
    gates: Gates = field(default_factory=Gates)
    multipliers: Multipliers = field(default_factory=Multipliers)
    weather: WeatherLimits = field(default_factory=WeatherLimits)
    # "exact" counts values per site; "approx" keeps a mergeable quantile sketch.
    percentiles: str = "exact"
    # "all" numbers every row of the map export and hides the excluded ranks,
    # "viable" numbers viable rows only.
    rank_scope: str = "all"
    # Area names of any length: read the coordinates from the last two tokens.
    coords_from_last_tokens: bool = False


DEFAULT = ModelConfig()


@dataclass(frozen=True)
class RasterGrid:
    """A lat/lon raster: half-open extent and pixel size in degrees."""

    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float
    res: float = 15 / 3600

    @property
    def rows(self) -> int:
        return ceil((self.lat_max - (self.lat_min + self.res / 2)) / self.res)

    @property
    def cols(self) -> int:
        return ceil((self.lon_max - (self.lon_min + self.res / 2)) / self.res)

    @property
    def km_per_pixel(self) -> float:
        """Mean of the pixel's height and width at the extent's middle latitude."""
        km_lat = self.res * 111.0
        km_lon = km_lat * cos(radians((self.lat_min + self.lat_max) / 2))
        return (km_lat + km_lon) / 2


# Extents of the full and of the regional raster run.
FULL_RASTER = RasterGrid(30.0, 46.0, -6.0, 37.0)
REGIONAL_RASTER = RasterGrid(41.0, 44.0, 2.0, 6.5)


@dataclass(frozen=True)
class Area:
    """A study area: inclusive bounding box, grid step and depth range."""

    name: str
    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float
    resolution: float = CELL_DEG
    depth_min_m: float = 0.0
    depth_max_m: float = -2000.0
    active: bool = True
    description: str = ""


# The one configured study area.
AREAS = (Area("gulf_of_lion", 40.5, 44.0, 2.5, 7.0, 0.25, 0.0, -2000.0, True, "Gulf of Lion — northern Mediterranean, site of the EFGL floating offshore wind project"),)
