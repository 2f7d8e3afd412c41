"""Global ranks without a single-task sort of unbounded input.

A window without PARTITION BY moves all rows to one task. Here rows are range-partitioned
on the sort key, numbered inside each slice, and shifted by the number of rows in the
slices before it. Rows are written once before the split, which samples its input, and the
slices once after it: every later use must see the same borders. Small tables are one or two
slices of the same plan.

A range split cannot divide equal keys, so ``row_number`` and ``ntile`` want an order that
is unique per row. ``rank`` and ``value_tiles`` work on counts per distinct value, whatever
number of rows shares one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pelagrid.session import kept


def _running_total(df: DataFrame, order: list[Column], weight: Column, out: str, total: str = "_all") -> DataFrame:
    """Inclusive running sum of ``weight`` in ``order``, and the sum over all rows."""
    sliced = kept(
        kept(df, "to-slice").repartitionByRange(*order).withColumns(
            {"_slice": F.spark_partition_id(), "_weight": weight.cast("long")}
        ),
        "slices",
    )
    # One row per slice: the size of both the window and the broadcast.
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = (
        sliced.groupBy("_slice")
        .agg(F.sum("_weight").alias("_size"))
        .select(
            "_slice",
            F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_size").over(every).alias(total),
        )
    )
    inside = (
        Window.partitionBy("_slice")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        sliced.join(F.broadcast(offsets), "_slice")
        .withColumn(out, F.sum("_weight").over(inside) + F.col("_before"))
        .drop("_slice", "_weight", "_before")
    )


def row_number(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """1..n in ``order``, which must be unique per row to be deterministic."""
    numbered = _running_total(df, order, F.lit(1), out)
    return numbered.withColumn(out, F.col(out).cast("int")).drop("_all")


def _tile(place: Column, rows: Column, tiles: int) -> Column:
    """Tile of the row at ``place`` (from 1) of ``rows``; the first tiles take the remainder."""
    size, larger = F.floor(rows / tiles), F.pmod(rows, F.lit(tiles))
    head = larger * (size + 1)
    late = F.floor((place - 1 - head) / F.greatest(size, F.lit(1))) + larger
    return (F.when(place <= head, F.floor((place - 1) / (size + 1))).otherwise(late) + 1).cast("int")


def ntile(df: DataFrame, tiles: int, order: list[Column], out: str) -> DataFrame:
    """Tile numbers of near-equal size; the first tiles take the remainder."""
    numbered = _running_total(df, order, F.lit(1), "_rn")
    return numbered.withColumn(out, _tile(F.col("_rn"), F.col("_all"), tiles)).drop("_rn", "_all")


def value_tiles(df: DataFrame, value: str, tiles: int, out: str) -> DataFrame:
    """(value, ``out``, n): how many rows of each distinct value, ascending, fall in each tile.

    What NTILE gives when rows of one value are interchangeable, by arithmetic on counts:
    a value that most rows share is one row here.
    """
    counted = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    upto = _running_total(counted, [F.asc(value)], F.col("_n"), "_upto")
    first, last = F.col("_upto") - F.col("_n") + 1, F.col("_upto")
    spread = upto.withColumn(
        out, F.explode(F.sequence(_tile(first, F.col("_all"), tiles), _tile(last, F.col("_all"), tiles)))
    )
    size, larger = F.floor(F.col("_all") / tiles), F.pmod("_all", F.lit(tiles))
    end = F.col(out) * size + F.least(F.col(out), larger)
    start = (F.col(out) - 1) * size + F.least(F.col(out) - 1, larger)
    n = F.least(last, end) - F.greatest(first - 1, start)
    return spread.select(value, out, n.cast("long").alias("n"))


def rank(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """RANK() by descending value, for several values at once.

    ``values`` maps the output column to the expression ranked. Distinct values of all columns of
    one type are counted in one scan and ranked in one running sum, in which every column has as many
    rows as the table; the result is joined back.
    """
    ranked = kept(df.withColumns({f"_v_{out}": value for out, value in values.items()}), "to-rank")
    types: dict[str, list[str]] = {}
    for out in values:
        types.setdefault(ranked.schema[f"_v_{out}"].dataType.simpleString(), []).append(out)
    joined = ranked
    for outs in types.values():
        pairs = [F.struct(F.lit(k).alias("_which"), F.col(f"_v_{out}").alias("_value")) for k, out in enumerate(outs)]
        counted = ranked.select(F.inline(F.array(*pairs))).groupBy("_which", "_value").agg(F.count(F.lit(1)).alias("_n"))
        upto = _running_total(counted, [F.asc("_which"), F.desc("_value")], F.col("_n"), "_upto")
        before = F.col("_which") * (F.col("_all") / len(outs)).cast("long")
        places = kept(
            upto.select("_which", "_value", (F.col("_upto") - before - F.col("_n") + 1).cast("int").alias("_place")),
            "ranks",
        )
        for k, out in enumerate(outs):
            own = places.where(F.col("_which") == k).select(F.col("_value").alias("_key"), F.col("_place").alias(out))
            joined = joined.join(own, F.col(f"_v_{out}").eqNullSafe(F.col("_key")), "left").drop("_key")
    return joined.select(*df.columns, *values)
