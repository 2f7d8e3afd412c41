"""Publish the model graph: lazy layers as views, the marts as tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from pelagrid.plans.pipeline import INTERMEDIATE, MARTS, STAGING, Pipeline
from pelagrid.sources import versions

MARTS_DATABASE = "site_marts"


def publish_views(pipeline: Pipeline, names: tuple[str, ...] = STAGING + INTERMEDIATE) -> list[str]:
    """Temporary views named like the models."""
    for name in names:
        pipeline.model(name).createOrReplaceTempView(name)
    return list(names)


def publish_marts(
    spark: SparkSession,
    pipeline: Pipeline,
    names: tuple[str, ...] = MARTS,
    database: str = MARTS_DATABASE,
) -> list[str]:
    """Tables in their own database, each switched to its new files in one step.

    A mart is written beside the files its table shows, and the table's location is changed
    when they are complete: readers find the old mart or the new one, and a failed build
    leaves the old. Only a change of columns makes the table anew. Old files stay until
    ``versions.expire`` on the mart's folder.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    place = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    tables = [f"{database}.{name}" for name in names]
    for name, table in zip(names, tables):
        mart, root = pipeline.model(name), f"{place}/versions_{name}"
        held = versions.replace(spark, root, lambda folder: mart.write.parquet(folder))  # noqa: B023
        (folder,) = versions.folders(root, held)
        present = spark.catalog.tableExists(table)
        if present and spark.table(table).dtypes == mart.dtypes:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
            continue
        if present:
            spark.sql(f"DROP TABLE {table}")
        spark.catalog.createTable(table, path=folder, source="parquet", schema=mart.schema)
    return tables


def build_all(spark: SparkSession, pipeline: Pipeline, database: str = MARTS_DATABASE) -> dict[str, list[str]]:
    """Views first, then tables; pass a pipeline made with ``shared=True``."""
    return {
        "views": publish_views(pipeline),
        "tables": publish_marts(spark, pipeline, database=database),
    }
