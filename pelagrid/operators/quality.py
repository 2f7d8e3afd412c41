"""Column expectations as data, and the checks that evaluate them.

The single-column checks return failing rows. ``report`` evaluates everything
declared for a model at once: one aggregation answers all ``not_null`` and
``accepted_values`` lines, and the values of all ``unique`` columns, of any number of
models, are counted in one shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagrid.config import VIABILITY_FLAGS


@dataclass(frozen=True)
class Expect:
    """What is declared for one model."""

    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def size(self) -> int:
        return len(self.unique) + len(self.not_null) + len(self.accepted)


# Accepted categories.
DISTANCE_CATEGORIES = ("nearshore", "midshore", "offshore")
DEPTH_CATEGORIES = ("shallow", "transitional", "deep")
TURBINE_TYPES = ("fixed", "floating", "not_viable")
RANKED_TYPES = ("fixed", "floating")
LEVELS = ("high", "medium", "low")
SEA_STATES = ("choppy", "moderate", "swell")

_HOURLY = ("record_id", "site_id", "spatial_id", "location_name")

# The declared expectations per model.
EXPECTATIONS: dict[str, Expect] = {
    "stg_wind": Expect(("record_id",), (*_HOURLY, "wind_speed_ms", "snap_lat", "snap_lon")),
    "stg_wave": Expect(("record_id",), (*_HOURLY, "wave_height", "snap_lat", "snap_lon")),
    "stg_bathymetry": Expect((), ("spatial_id", "depth_m", "snap_lat", "snap_lon")),
    "stg_coastline_distance": Expect(
        (),
        ("spatial_id", "distance_to_coast_km", "distance_category"),
        {"distance_category": DISTANCE_CATEGORIES},
    ),
    "site_centers": Expect(("site_name", "spatial_id"), ("site_name", "spatial_id")),
    "spatial_samples": Expect(("site_name",), ("site_name", "sample_count")),
    "spatial_summary": Expect(
        ("site_name", "spatial_id"),
        (
            "site_name",
            "spatial_id",
            "depth_m",
            "distance_to_coast_km",
            "depth_category",
            "marine_coverage_pct",
        ),
        {"depth_category": DEPTH_CATEGORIES},
    ),
    "wind_summary": Expect(
        ("site_id", "site_name"),
        ("site_id", "site_name", "avg_wind_speed_ms", "p50_wind_speed_ms", "p90_wind_speed_ms"),
    ),
    "wave_summary": Expect(
        ("site_id", "site_name"),
        ("site_id", "site_name", "avg_wave_height_m", "max_wave_height_m", "avg_wave_period_s"),
    ),
    "spatial_score": Expect(
        ("site_name",),
        ("site_name", "depth_score", "coast_score", "spatial_score", "turbine_type"),
        {"turbine_type": TURBINE_TYPES},
    ),
    "wind_score": Expect(
        ("site_name",),
        (
            "site_name",
            "avg_score",
            "p50_score",
            "p90_score",
            "wind_score",
            "wind_potential_class",
        ),
        {"wind_potential_class": LEVELS},
    ),
    "wave_score": Expect(
        ("site_name",),
        ("site_name", "wave_score", "survivability_class", "sea_state_class"),
        {"survivability_class": LEVELS, "sea_state_class": SEA_STATES},
    ),
    "composite": Expect(
        ("site_name",),
        ("site_name", "raw_final_score", "final_score", "survivability_multiplier", "turbine_type"),
        {"turbine_type": RANKED_TYPES},
    ),
    "composite_unfiltered": Expect(
        ("site_name",),
        ("site_name", "final_score", "viability_flag"),
        {"viability_flag": VIABILITY_FLAGS},
    ),
    "mart_prioritization": Expect(
        ("site_rank", "site_name"),
        (
            "site_rank",
            "site_name",
            "raw_final_score",
            "final_score",
            "turbine_type",
            "wind_potential_class",
            "survivability_class",
        ),
        {
            "turbine_type": RANKED_TYPES,
            "wind_potential_class": LEVELS,
            "survivability_class": LEVELS,
        },
    ),
    "mart_gis": Expect(
        ("site_name",),
        ("site_name", "final_score", "viability_flag"),
        {"viability_flag": VIABILITY_FLAGS},
    ),
}


def duplicates(df: DataFrame, *columns: str) -> DataFrame:
    """Values that occur more than once, NULLs aside, with their row counts."""
    present = df.dropna(how="any", subset=list(columns)).select(*columns)
    return present.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unexpected_values(df: DataFrame, column: str, accepted: tuple[str, ...]) -> DataFrame:
    """Values outside the list with their row counts; NULL is not a value."""
    outside = df.where(~F.col(column).isin(*accepted))
    return outside.groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def _line(model: str, test: str, column: str, failures: str):
    return F.struct(
        F.lit(model).alias("model"),
        F.lit(test).alias("test"),
        F.lit(column).alias("column_name"),
        F.col(failures).alias("failures"),
    )


def _finish(lines: DataFrame) -> DataFrame:
    return lines.withColumn("passed", F.col("failures") == 0)


TESTS = ("unique", "not_null", "accepted_values")


def column_report(
    df: DataFrame, model: str, expect: Expect, tests: tuple[str, ...] = TESTS
) -> DataFrame | None:
    """The not_null and accepted_values lines asked for, in one pass; None if there are none."""
    aggregates, lines = [], []
    for column in expect.not_null if "not_null" in tests else ():
        name = f"null_{column}"
        aggregates.append(F.count_if(F.col(column).isNull()).alias(name))
        lines.append(_line(model, "not_null", column, name))
    for column, values in expect.accepted.items() if "accepted_values" in tests else ():
        name = f"odd_{column}"
        aggregates.append(F.count_if(~F.col(column).isin(*values)).alias(name))
        lines.append(_line(model, "accepted_values", column, name))
    if not lines:
        return None
    return _finish(df.agg(*aggregates).select(F.inline(F.array(*lines))))


def unique_values(df: DataFrame, model: str, expect: Expect) -> DataFrame:
    """(model, column_name, value) for every value of a unique column that is not NULL, in one pass."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in expect.unique]
    rows = df.select(F.lit(model).alias("model"), F.inline(F.array(*pairs)))
    return rows.where(F.col("value").isNotNull())


def unique_lines(values: DataFrame, expected: list[tuple[str, str]]) -> DataFrame:
    """One line per expected (model, column): how many of its values repeat.

    One shuffle for the values of all models, combined in the map tasks; what follows has
    one row for each column and partition.
    """
    counted = values.groupBy("model", "column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    repeated = counted.groupBy("model", "column_name").agg(F.count_if(F.col("n") > 1).alias("repeated"))
    lines = values.sparkSession.createDataFrame(expected, "model string, column_name string")
    return _finish(
        lines.join(repeated, ["model", "column_name"], "left").select(
            "model", F.lit("unique").alias("test"), "column_name", F.coalesce("repeated", F.lit(0)).cast("long").alias("failures")
        )
    )


def unique_report(df: DataFrame, model: str, expect: Expect) -> list[DataFrame]:
    """One line per unique column of one model: how many values repeat."""
    if not expect.unique:
        return []
    return [unique_lines(unique_values(df, model, expect), [(model, c) for c in expect.unique])]
