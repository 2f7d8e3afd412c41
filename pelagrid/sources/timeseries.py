"""The raw hourly tables: month-partitioned Parquet in versions, ordered by site inside."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pelagrid.schemas import hourly_table
from pelagrid.session import read_once, require_utc, stage
from pelagrid.sources import versions

MONTH = "obs_month"
KEY = ("location_name", "observation_time")
MERGE_TRIES = 20


class EmptyLoad(RuntimeError):
    """A requested site and period has no rows after its load."""


class Request(NamedTuple):
    """What a load was asked for: a site and its first and last day."""

    location_name: str
    start_date: dt.date
    end_date: dt.date


class LoadReport(NamedTuple):
    """Counted while the batch is written, by the write itself: rows, NULLs of every column, the
    times it spans, and the rows of the request (all rows where none was named)."""

    rows: int
    nulls: dict[str, int]
    first: dt.datetime | None
    last: dt.datetime | None
    requested: int


def with_month(hourly: DataFrame) -> DataFrame:
    return hourly.withColumn(MONTH, F.date_format("observation_time", "yyyy-MM"))


def _wanted(request: Request | None) -> Column:
    if request is None:
        return F.lit(True)
    day = F.to_date("observation_time")
    return (F.col("location_name") == request.location_name) & day.between(request.start_date, request.end_date)


def _observed(hourly: DataFrame, request: Request | None) -> tuple[DataFrame, Observation]:
    seen = Observation()
    columns = hourly.columns
    return (
        hourly.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.min("observation_time").alias("first"),
            F.max("observation_time").alias("last"),
            F.count_if(_wanted(request)).alias("requested"),
            *(F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(columns)),
        ),
        seen,
    )


def _reported(seen: Observation, columns: list[str], request: Request | None) -> LoadReport:
    """The counts of a finished write; an empty one is an error where rows were requested."""
    found = seen.get
    nulls = {c: found[f"null_{i}"] for i, c in enumerate(columns)}
    report = LoadReport(found["rows"], nulls, found["first"], found["last"], found["requested"])
    if request is not None and report.requested == 0:
        raise EmptyLoad(
            f"No rows loaded for {request.location_name} ({request.start_date}..{request.end_date}): 0"
        )
    return report


def append_hourly(hourly: DataFrame, path: str, request: Request | None = None) -> LoadReport:
    """Plain append: loading the same rows twice stores them twice.

    Tasks get contiguous (month, site, time) ranges. Time is part of the key, so a
    month or a site with a large share of the rows is spread over tasks, and each
    task still writes to few months. A request without rows fails before anything is added.
    """
    spark = hourly.sparkSession
    require_utc(spark)
    order = (MONTH, *KEY)
    watched, seen = _observed(hourly, request)
    with read_once(with_month(watched)) as batch:
        report = _reported(seen, hourly.columns, request)
        laid = batch.repartitionByRange(*order).sortWithinPartitions(*order)
        write = lambda folder: laid.write.partitionBy(MONTH).parquet(folder)
        versions.add(spark, path, versions.new_load(spark, path, write))
    return report


def merge_hourly(hourly: DataFrame, path: str, request: Request | None = None) -> LoadReport:
    """Idempotent load: one row per (site, time), the new batch wins.

    Rows without a site or a time have no key: of those only wholly equal rows are one.
    Rows of one batch with the same key are ordered by all their values, so the
    result does not depend on how they arrive.

    Only the months of the batch (no month is one of them) are read back and rewritten.
    Their list comes from an aggregate over the batch, so its size is the number of
    months. The range shuffle that lays the rows out also brings equal keys together,
    hence de-duplication needs no shuffle of its own.

    Any number of writers may merge at once. A merge that finds at its end that another
    changed one of its months meanwhile is done again from what is stored then.
    """
    spark = hourly.sparkSession
    require_utc(spark)
    order = (MONTH, *KEY)
    keyless = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in KEY))
    itself = F.when(keyless, F.struct(*[c for c in hourly.columns if c != MONTH]))
    newest = Window.partitionBy(*order, itself).orderBy(
        F.col("_new").desc(), *(F.col(c).desc_nulls_last() for c in hourly.columns if c not in order)
    )
    watched, seen = _observed(hourly, request)
    with read_once(with_month(watched).withColumn("_new", F.lit(1))) as batch:
        report = _reported(seen, hourly.columns, request)
        touched = [_part(r[0]) for r in batch.select(MONTH).distinct().collect()]
        schema = StructType([f for f in batch.schema if f.name != "_new"])
        for tried in range(1, MERGE_TRIES + 1):
            base = versions.latest(spark, path)
            old = versions.read(spark, path, schema, base, touched).withColumn("_new", F.lit(0))
            rows = batch.unionByName(old) if any(p in base.parts for p in touched) else batch
            merged = (
                rows.repartitionByRange(*order)
                .withColumn("_nth", F.row_number().over(newest))
                .where("_nth = 1")
                .drop("_nth", "_new")
                .sortWithinPartitions(*order)
            )
            loaded = versions.new_load(spark, path, lambda f: merged.write.partitionBy(MONTH).parquet(f))  # noqa: B023
            try:
                versions.commit(spark, path, base, loaded)
                return report
            except versions.Conflict:
                if tried == MERGE_TRIES:
                    raise
    raise AssertionError("not reached")


def _part(month: str | None) -> str:
    return f"{MONTH}={'__HIVE_DEFAULT_PARTITION__' if month is None else month}"


def read_hourly(spark: SparkSession, path: str, variables: tuple[str, ...]) -> DataFrame:
    """Declared columns plus the month to prune on; of the version that counts now."""
    return read_months(spark, path, variables, versions.latest(spark, path))


def read_months(
    spark: SparkSession,
    path: str,
    variables: tuple[str, ...],
    held: versions.Version,
    parts: list[str] | None = None,
) -> DataFrame:
    """A version of the table, or some of its parts. Files without versions are read as they are."""
    # The month is declared too: inference could take "2024-01" for a date.
    declared = StructType(hourly_table(variables).fields).add(MONTH, "string")
    if held.number == 0:
        return spark.read.schema(declared).parquet(path)
    return versions.read(spark, path, declared, held, parts)


def save_bucketed(hourly: DataFrame, table: str, buckets: int) -> None:
    """A catalog table dealt by site and month, ordered by site and time in every bucket.

    What groups by site and month, or by more, reads it without a shuffle. The month is
    part of the bucket, so a site with a large share of the rows is in many. One file each: the
    rows are dealt with the hash that the buckets use.
    """
    require_utc(hourly.sparkSession)
    dealt = with_month(hourly).repartition(buckets, KEY[0], MONTH)
    writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, KEY[0], MONTH)
    writer.sortBy(*KEY).saveAsTable(table)


def truncate_tables(spark: SparkSession, *tables: str) -> list[str]:
    """Empty the named catalog tables that exist; returns those emptied."""
    present = [t for t in tables if spark.catalog.tableExists(t)]
    for table in present:
        spark.sql(f"TRUNCATE TABLE {table}")
    return present


def loaded_rows(requests: DataFrame, hourly: DataFrame) -> DataFrame:
    """Rows stored per request (location_name, start_date, end_date); 0 if none.

    The series is counted per site and day, and the edges of the requests are days with
    no rows of their own. A running count per site then stands at every edge, and a request is
    the difference of two of them, however long it is. A site's running count has one row for
    each of its different days, whatever the number of observations or requests.
    """
    wanted = ["location_name", "start_date", "end_date"]
    asked = requests.select(*wanted).distinct().where("start_date <= end_date")
    before = F.date_sub("start_date", 1)
    edge = lambda day: asked.select("location_name", day.alias("_day"), F.lit(0).cast("long").alias("_n"))
    per_day = hourly.groupBy("location_name", F.to_date("observation_time").alias("_day")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    days = per_day.where("_day IS NOT NULL").unionByName(edge(before)).unionByName(edge(F.col("end_date")))
    upto = Window.partitionBy("location_name").orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    running = (
        days.groupBy("location_name", "_day")
        .agg(F.sum("_n").alias("_n"), F.count_if(F.col("_n") == 0).alias("_edges"))
        .withColumn("_upto", F.sum("_n").over(upto))
        .where("_edges > 0")
    )
    at = lambda name, total: running.select("location_name", F.col("_day").alias(name), F.col("_upto").alias(total))
    counts = (
        asked.withColumn("_before", before)
        .join(at("_before", "_low"), ["location_name", "_before"])
        .join(at("end_date", "_high"), ["location_name", "end_date"])
        .select(*wanted, (F.col("_high") - F.col("_low")).alias("row_count"))
    )
    return (
        requests.join(counts, wanted, "left")
        .withColumn("row_count", F.coalesce("row_count", F.lit(0)).cast("long"))
        .select(*wanted, "row_count", (F.col("row_count") > 0).alias("loaded"))
    )


def require_loaded(requests: DataFrame, hourly: DataFrame) -> None:
    """Raise for the first few requests that loaded nothing."""
    empty = stage(loaded_rows(requests, hourly).where(~F.col("loaded")))
    failed = empty.orderBy("location_name", "start_date").limit(5).collect()
    if failed:
        listed = ", ".join(f"{r.location_name} ({r.start_date}..{r.end_date}): 0" for r in failed)
        raise EmptyLoad(f"No rows loaded for {listed} (requests without rows: {empty.count()})")
