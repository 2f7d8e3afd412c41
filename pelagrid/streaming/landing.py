"""Load each landed file once into a raw hourly table.

The file source remembers in its checkpoint what it has read, and the merge makes
a repeated micro-batch harmless, so a failed load is simply started again.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from pelagrid.schemas import hourly_table
from pelagrid.sources.hourly import TIME_FORMAT
from pelagrid.sources.timeseries import merge_hourly


def load_new_files(
    spark: SparkSession,
    landing_root: str,
    table_path: str,
    variables: tuple[str, ...],
    checkpoint: str,
    files_per_batch: int = 10_000,
) -> None:
    """Merge every landed file not loaded before, then stop."""
    landed = (
        spark.readStream.schema(hourly_table(variables))
        .option("mode", "FAILFAST")
        .option("timestampFormat", TIME_FORMAT)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing_root)
    )
    columns = hourly_table(variables).fieldNames()
    query = (
        landed.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, _: merge_hourly(batch.select(*columns), table_path))
        .start()
    )
    query.awaitTermination()
