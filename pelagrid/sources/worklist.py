"""What a historical backfill has to fetch, and what it still misses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pelagrid.config import BACKFILL_YEARS


def backfill_requests(sites: DataFrame, first: int = BACKFILL_YEARS[0], last: int = BACKFILL_YEARS[1]) -> DataFrame:
    """One request per site and calendar year; years are unnested, not joined."""
    if first > last:
        raise ValueError(f"no years from {first} to {last}")
    years = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year")
    return sites.select("location_name", years).select(
        "location_name",
        "year",
        F.make_date("year", F.lit(1), F.lit(1)).alias("start_date"),
        F.make_date("year", F.lit(12), F.lit(31)).alias("end_date"),
    )


def missing_requests(requests: DataFrame, hourly: DataFrame) -> DataFrame:
    """Requests whose site-year has no stored row."""
    stored = hourly.select("location_name", F.year("observation_time").alias("year")).distinct()
    return requests.join(stored, ["location_name", "year"], "left_anti")


def missing_hours(requests: DataFrame, hourly: DataFrame) -> DataFrame:
    """Ranges of hours without a row: (location_name, year, first_hour, last_hour, hours).

    Requests are site-years as ``backfill_requests`` makes them. The hours before the first and after
    the last of a year stand in for its edges, so a range is what lies between two
    neighbours; a year without rows is one range. An hour counts as stored with any row in it,
    and rows are reduced to different hours before they meet the requests, so no window
    has more rows than a year has hours.
    """
    hour = F.date_trunc("hour", "observation_time")
    years = requests.select("location_name", "year").distinct()
    stored = (
        hourly.where(F.col("observation_time").isNotNull())
        .select("location_name", F.year("observation_time").alias("year"), hour.alias("_hour"))
        .distinct()
        .join(years, ["location_name", "year"], "left_semi")
    )
    start = lambda year: F.make_timestamp_ltz(year, *map(F.lit, (1, 1, 0, 0, 0)))
    an_hour = F.expr("INTERVAL 1 HOUR")
    year = F.col("year")
    edges = years.select(
        "location_name", "year", F.explode(F.array(start(year) - an_hour, start(year + 1))).alias("_hour")
    )
    following = F.lead("_hour").over(Window.partitionBy("location_name", "year").orderBy("_hour"))
    first, last = F.col("_hour") + an_hour, F.col("_next") - an_hour
    gaps = stored.unionByName(edges).withColumn("_next", following).where(F.col("_next") > first)
    hours = (F.unix_timestamp("_next") - F.unix_timestamp("_hour")) / 3600 - 1
    return gaps.select(
        "location_name", "year", first.alias("first_hour"), last.alias("last_hour"), hours.cast("long").alias("hours")
    )


def incomplete_requests(requests: DataFrame, hourly: DataFrame, tolerated_hours: int = 0) -> DataFrame:
    """Requests with more missing hours than tolerated, and how many; unlike ``missing_requests``, one
    stored row does not make a year complete."""
    missing = missing_hours(requests, hourly).groupBy("location_name", "year").agg(F.sum("hours").alias("missing_hours"))
    return requests.join(missing.where(F.col("missing_hours") > tolerated_hours), ["location_name", "year"])
