"""The declared expectations evaluated over a pipeline."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from pelagrid.operators.quality import EXPECTATIONS, TESTS, column_report, unique_lines, unique_values
from pelagrid.plans.pipeline import Pipeline


def run(p: Pipeline, tests: tuple[str, ...] = TESTS) -> DataFrame:
    """(model, test, column_name, failures, passed), one line per expectation."""
    lines: list[DataFrame] = []
    values: list[DataFrame] = []
    declared: list[tuple[str, str]] = []
    for model, expect in EXPECTATIONS.items():
        asked = {"unique": expect.unique, "not_null": expect.not_null, "accepted_values": expect.accepted}
        if not any(asked[t] for t in tests):
            continue
        df = p.model(model)
        if "unique" in tests and expect.unique:
            values.append(unique_values(df, model, expect))
            declared += [(model, c) for c in expect.unique]
        by_column = column_report(df, model, expect, tests)
        if by_column is not None:
            lines.append(by_column)
    union = lambda parts: reduce(lambda a, b: a.unionByName(b), parts)
    if values:
        lines.append(unique_lines(union(values), declared))
    return union(lines)
