"""Materialised steps and connected components as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pelagrid.session import scratch_path


def written(df: DataFrame, label: str) -> DataFrame:
    """Write once below the shared folder and read back: lineage ends in a file."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _are_stars(edges: DataFrame) -> bool:
    """Whether every edge(u, v) hangs a node on a root: none hangs on two, no root hangs on another."""
    row = lambda node, hangs, holds: F.struct(F.col(node).alias("node"), F.lit(hangs).alias("hangs"), F.lit(holds).alias("holds"))
    nodes = edges.select(F.inline(F.array(row("u", 1, 0), row("v", 0, 1)))).groupBy("node").agg(
        F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")
    )
    return not nodes.agg(F.max(F.expr("hangs > 1 or hangs = 1 and holds = 1"))).first()[0]


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node``, ``root`` (least node reachable) for every node of ``links(a, b)``.

    Alternates the two star steps until only stars are left: hang every larger neighbour on the
    least neighbour, then every node and its smaller neighbours on the least. Both steps
    are an aggregation and a join on a node; a hot node's minimum is combined in the map
    tasks, and the join is left to adaptive skew handling. Links that are stars already take no
    round. ``rounds`` only stops a run that does not converge, with an error.
    """
    edges = written(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        "edges",
    )
    for _ in range(rounds):
        if _are_stars(edges):
            roots = edges.select(F.col("v").alias("node")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                roots.select("node", F.col("node").alias("root"))
            )
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # One row for each edge, some of them equal; the second step's distinct() drops repeats.
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nearest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(nearest, "u")
        small = (
            joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(nearest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = written(small, "edges")
    raise RuntimeError(f"components did not converge in {rounds} rounds")


SLICE, AT = "_slice", "_at"


def sliced(df: DataFrame, keys: list, label: str = "sliced") -> DataFrame:
    """``df`` in range-partitioned sort order, written, with the slice and the place in it.

    Rows with equal keys are told apart by their place in the input, so even a key that
    holds a third of all rows is split over slices.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    ordered = tied.repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
    place = F.monotonically_increasing_id()
    numbered = ordered.withColumns(
        {SLICE: F.shiftright(place, 33), AT: place.bitwiseAND(F.lit((1 << 33) - 1))}
    )
    return written(numbered, label)


def running(ordered: DataFrame, groups: list[str], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over earlier rows of the group, for rows from ``sliced``.

    Sums inside a slice are a window over that slice alone; slices are linked by one
    total for each slice and group.
    """
    keys = [SLICE, *groups]
    totals = ordered.groupBy(*keys).agg(F.sum(value).alias("_total"))
    earlier = W.partitionBy(*groups).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"),
    )
    within = W.partitionBy(*keys).orderBy(AT).rowsBetween(W.unboundedPreceding, -1)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return (
        ordered.withColumn(name, F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(offsets, same)
        .withColumn(name, F.col(name) + F.col("_before"))
        .drop("_before", *[f"_k{i}" for i in range(len(keys))])
    )


#: Rows of short keys that may be broadcast (tens of bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 2_000_000


def matched(rows: DataFrame, keys: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join with a table of short keys, broadcast while its counted rows are bounded."""
    few = keys.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(keys) if few else keys, on, how)
