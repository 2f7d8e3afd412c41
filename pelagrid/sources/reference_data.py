"""Small reference inputs: exclusion seed, study areas, site registry."""

from __future__ import annotations

import csv
from collections.abc import Iterable
from dataclasses import asdict
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from pelagrid import schemas
from pelagrid.config import AREAS, Area
from pelagrid.sources import versions

# The packaged exclusion list.
SEED = Path(__file__).with_name("manually_excluded_sites.csv")


def read_exclusions(spark: SparkSession, path: str) -> DataFrame:
    """Manual exclusion list from CSV with a header and a declared schema."""
    return (
        spark.read.schema(schemas.EXCLUSIONS)
        .option("header", True)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def default_exclusions(spark: SparkSession) -> DataFrame:
    """The packaged seed; read on the driver so executors need no local file."""
    with SEED.open(encoding="utf-8", newline="") as lines:
        rows = [
            (*list(r.values())[:3], date.fromisoformat(r["excluded_date"]))
            for r in csv.DictReader(lines)
        ]
    return spark.createDataFrame(rows, schemas.EXCLUSIONS)


def active_areas(spark: SparkSession, areas: Iterable[Area] = AREAS) -> DataFrame:
    """Configured study areas that are switched on."""
    rows = [asdict(a) for a in areas if a.active]
    return spark.createDataFrame(rows, schemas.AREAS)


def read_areas(spark: SparkSession, path: str) -> DataFrame:
    """Active study areas from a file of JSON lines with a declared schema."""
    return spark.read.schema(schemas.AREAS).option("mode", "FAILFAST").json(path).where("active")


def write_grid_points(points: DataFrame, path: str) -> None:
    versions.replace(points.sparkSession, path, lambda folder: points.write.json(folder))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Grid points as the site dimension: (location_name, latitude, longitude)."""
    if versions.is_versioned(spark, path):
        points = versions.read(spark, path, schemas.GRID_POINTS, kind="json", mode="FAILFAST")
    else:
        points = spark.read.schema(schemas.GRID_POINTS).option("mode", "FAILFAST").json(path)
    return points.selectExpr("key AS location_name", "lat AS latitude", "lon AS longitude")
