"""Slices of the ranked table that the dashboard shows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHOWN = [
    "site_rank",
    "site_name",
    "center_lat",
    "center_lon",
    "turbine_type",
    "wind_potential_class",
    "survivability_class",
    "spatial_score",
    "wind_score",
    "wave_score",
    "final_score",
]


def dashboard_slice(
    mart: DataFrame,
    turbine_type: str | None = None,
    wind_class: str | None = None,
    survivability: str | None = None,
) -> DataFrame:
    """Ranked sites narrowed by any of the three filters."""
    wanted = {
        "turbine_type": turbine_type,
        "wind_potential_class": wind_class,
        "survivability_class": survivability,
    }
    for column, value in wanted.items():
        if value is not None:
            mart = mart.where(F.col(column) == value)
    return mart.select(*SHOWN)


def top_ranked(mart: DataFrame, n: int = 10) -> DataFrame:
    """The first n sites; sorts and cuts in one step without a full sort."""
    return mart.select(*SHOWN).orderBy("site_rank").limit(n)
