"""Session settings, shared storage, and keeping a result for several jobs."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What the operators rely on; set only on sessions this library creates.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Recording a Python call site per Column doubles the cost of building a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(app: str = "pelagrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; keyword keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, from ``spark.checkpoint.dir``.

    A session on one machine that has none (a unit test) gets a folder of its own; on a
    cluster that is an error, because executors do not see each other's disks.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if configured is None:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="pelagrid-ckpt-")
        sc.setCheckpointDir(configured)
    return configured or sc.getCheckpointDir()


_scratch: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    path = f"{shared_dir(spark).rstrip('/')}/pelagrid/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def release_scratch(spark: SparkSession) -> None:
    """Delete what this process wrote to scratch paths; frames that read them end here."""
    while _scratch:
        delete_folder(spark, _scratch.pop())


def _folder(spark: SparkSession, path: str):
    """A path and its file system, whatever store it is in."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return own, own.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    own, store = _folder(spark, path)
    store.delete(own, True)


def require_utc(spark: SparkSession) -> None:
    """Keys, months and days are texts of UTC times; another session zone would change them."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    rules = spark._jvm.java.time.ZoneId.of(zone).getRules()
    epoch = spark._jvm.java.time.Instant.EPOCH
    if not (rules.isFixedOffset() and rules.getOffset(epoch).getTotalSeconds() == 0):
        raise ValueError(f"set spark.sql.session.timeZone to UTC; it is {zone}")


def stage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: runs ``df`` once and survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below the shared folder and read back.

    A checkpoint computes its frame twice, for a count and for its files; this does it once.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def read_once(batch: DataFrame) -> Iterator[DataFrame]:
    """Stage a batch in the shared folder while several jobs read it.

    Range partitioning samples its input first, so without this a landed file
    would be parsed once per pass. The copy is deleted afterwards.
    """
    spark = batch.sparkSession
    path = scratch_path(spark, "batch")
    batch.write.parquet(path)
    try:
        yield spark.read.schema(batch.schema).parquet(path)
    finally:
        delete_folder(spark, path)
