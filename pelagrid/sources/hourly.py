"""Landed weather responses and the flat hourly files made from them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagrid.functions.numeric import clean_numeric
from pelagrid.schemas import hourly_response, hourly_table
from pelagrid.session import read_once, require_utc

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def read_responses(spark: SparkSession, path: str, variables: tuple[str, ...]) -> DataFrame:
    """Response files, one JSON document each, partitioned by ``location_name=``."""
    return (
        spark.read.schema(hourly_response(variables))
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(path)
    )


def parse_responses(df: DataFrame, payload: str, variables: tuple[str, ...]) -> DataFrame:
    """The same structure from a text column holding one document per row."""
    parsed = F.from_json(payload, hourly_response(variables), {"mode": "FAILFAST"})
    return df.withColumn("_doc", parsed).select("location_name", "_doc.*")


def _aligned(variable: str) -> Column:
    """The variable's values, one per timestamp; a short array is an error."""
    values, times = F.col(f"hourly.{variable}"), F.size("hourly.time")
    short = F.coalesce(F.size(values) < times, F.lit(True))
    problem = F.raise_error(F.lit(f"hourly.{variable} has fewer values than hourly.time"))
    return F.when(short, problem.cast("array<string>")).otherwise(F.slice(values, F.lit(1), times))


def explode_hourly(responses: DataFrame, variables: tuple[str, ...]) -> DataFrame:
    """One row per site-hour from parallel arrays under ``hourly``.

    Built-in array functions only: the arrays are zipped and unnested in the
    JVM, after a length check because zipping alone would pad with NULLs.
    """
    zipped = F.arrays_zip(
        F.col("hourly.time").alias("time"), *(_aligned(v).alias(v) for v in variables)
    )
    rows = responses.select("location_name", "latitude", "longitude", F.inline(zipped))
    return rows.select(
        "location_name",
        "latitude",
        "longitude",
        F.to_timestamp(F.concat("time", F.lit(":00")), "yyyy-MM-dd'T'HH:mm:ss").alias(
            "observation_time"
        ),
        *(clean_numeric(F.col(v)).alias(v) for v in variables),
    )


def write_landing(hourly: DataFrame, root: str, first_day: dt.date, last_day: dt.date) -> None:
    """Line-delimited JSON in ``location_name=<site>/period=<first day>_<last day>``.

    The period is that of the request, whatever days its answer holds. Landing a period of a
    site again replaces what that request brought and nothing else, so a shorter answer
    leaves no rows of the longer one behind; a site without rows in the answer keeps its files.

    Range partitioning on (site, time) lets several tasks share a large site and
    keeps each task inside few sites, so folders do not fill with small files.
    """
    require_utc(hourly.sparkSession)
    if first_day > last_day:
        raise ValueError(f"no days from {first_day} to {last_day}")
    text = F.date_format("observation_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    with read_once(hourly.withColumn("observation_time", text)) as rows:
        (
            rows.withColumn("period", F.lit(f"{first_day}_{last_day}"))
            .repartitionByRange("location_name", "observation_time")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("location_name", "period")
            .json(root)
        )


def read_landing(spark: SparkSession, root: str, variables: tuple[str, ...]) -> DataFrame:
    """Declared schema, no inference; a malformed line fails the load."""
    require_utc(spark)
    schema = hourly_table(variables)
    return (
        spark.read.schema(schema)
        .option("mode", "FAILFAST")
        .option("timestampFormat", TIME_FORMAT)
        .json(root)
        .select(*schema.fieldNames())
    )
