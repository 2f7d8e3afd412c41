"""Membership joins with SQL's three-valued logic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_in(df: DataFrame, column: str, listed: DataFrame, listed_column: str | None = None) -> DataFrame:
    """``column NOT IN (SELECT ... FROM listed)``, NULL rules included.

    A NULL in the list empties the result; a NULL probe value is kept only when
    the list is empty. Spark plans the SQL form by broadcasting the whole list
    whatever its size; here a plain anti join leaves that choice to the measured
    size, and a one-row scalar subquery carries the NULL rule.
    """
    values = listed.select(F.col(listed_column or column).alias(column))
    rules = values.agg(
        F.struct(
            F.count(F.lit(1)).alias("size"),
            F.count_if(F.col(column).isNull()).alias("nulls"),
        ).alias("rules")
    ).scalar()
    kept = df.join(values.where(F.col(column).isNotNull()).distinct(), column, "left_anti")
    empty_list = rules.getField("size") == 0
    return kept.where(empty_list | ((rules.getField("nulls") == 0) & F.col(column).isNotNull()))


def flag_in(df: DataFrame, column: str, listed: DataFrame, flag: str, listed_column: str | None = None) -> DataFrame:
    """Boolean ``flag``: true where ``column`` is in the list, false otherwise."""
    values = listed.select(F.col(listed_column or column).alias(column)).distinct()
    marked = df.join(values.withColumn(flag, F.lit(True)), column, "left")
    return marked.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
