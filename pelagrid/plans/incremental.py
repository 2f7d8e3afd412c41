"""Site summaries kept up to date month by month.

A state table holds one row per site and month: the histogram of its values at the reported
two decimals, with the moments of every bin. Histogram rows of different months are simply
rows of one histogram, so the summary of all months is taken from the states as it is from
a scan, and equals it.

A refresh compares, by their manifests, the months of the raw table with those the states were
made from. It reads the raw rows of months that changed and of no other, writes their states and
commits them with the manifest entries they came from. A refresh that is lost or repeated
changes nothing but work; of two at once the later one starts again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from pelagrid.config import DEFAULT, WeatherLimits
from pelagrid.functions.numeric import to_ms
from pelagrid.operators import summaries
from pelagrid.schemas import WAVE_VARS, WIND_VARS
from pelagrid.sources import timeseries, versions

SOURCE = "made_from"
REFRESH_TRIES = 20


@dataclass(frozen=True)
class Series:
    """What is summarised of an hourly table, and how."""

    variables: tuple[str, ...]
    measure: str
    value: str
    extra: Callable[[WeatherLimits], Mapping[str, Column]]
    summary: Callable[[DataFrame], DataFrame]
    to_value: Callable[[Column], Column] = lambda c: c

    def staged(self, raw: DataFrame) -> DataFrame:
        """Site, month and measures of the rows that have the measure."""
        kept = [v for v in self.variables if v != self.measure]
        measured = raw.where(F.col(self.measure).isNotNull())
        return measured.select(
            summaries.SITE, timeseries.MONTH, self.to_value(F.col(self.measure)).alias(self.value), *kept
        )


WIND = Series(
    WIND_VARS, "wind_speed_100m", "wind_speed_ms", summaries.wind_extra, summaries.wind_summary_of, to_ms
)
WAVE = Series(WAVE_VARS, "wave_height", "wave_height", summaries.wave_extra, summaries.wave_summary_of)


def month_states(raw: DataFrame, series: Series, limits: WeatherLimits = DEFAULT.weather) -> DataFrame:
    """One row per site and month: its bins, each with count and moments.

    Bins are combined in the map tasks. A row has as many bins as its month has different
    hundredths, which the hours of a month and the range of the measure bound.
    """
    staged = series.staged(raw)
    hist = summaries.histogram(staged, series.value, series.extra(limits), timeseries.MONTH)
    bins = F.struct(*(c for c in hist.columns if c not in (summaries.SITE, timeseries.MONTH)))
    return hist.groupBy(summaries.SITE, timeseries.MONTH).agg(F.sort_array(F.collect_list(bins)).alias("bins"))


def summary(states: DataFrame, series: Series) -> DataFrame:
    """The summary of all sites from their monthly states."""
    return series.summary(states.select(summaries.SITE, F.inline("bins")))


def _schema(spark: SparkSession, series: Series, limits: WeatherLimits) -> StructType:
    empty = timeseries.with_month(spark.createDataFrame([], timeseries.hourly_table(series.variables)))
    return month_states(empty, series, limits).schema


def _plain(schema: StructType) -> StructType:
    """The same columns, all nullable, as files give them back."""
    (bins,) = (f.dataType.elementType for f in schema if isinstance(f.dataType, ArrayType))
    out = StructType([f for f in schema if f.name != "bins"])
    nested = StructType()
    for f in bins:
        nested.add(f.name, f.dataType)
    return out.add("bins", ArrayType(nested))


def stale_months(spark: SparkSession, table: str, states: str) -> tuple[versions.Version, versions.Version, list[str]]:
    """The versions of both tables, and the months of the raw table that the states do not show."""
    source, own = versions.latest(spark, table), versions.latest(spark, states)
    made_from = own.notes.get(SOURCE, {})
    return source, own, [p for p in sorted(source.parts.keys() | made_from.keys()) if source.parts.get(p) != made_from.get(p)]


def refresh(
    spark: SparkSession, table: str, states: str, series: Series, limits: WeatherLimits = DEFAULT.weather
) -> list[str]:
    """Bring the states at ``states`` up to the raw table at ``table``; the months that were read.

    The limits are part of the states: other limits need a state table of their own.
    """
    for tried in range(1, REFRESH_TRIES + 1):
        source, own, stale = stale_months(spark, table, states)
        wanted = {"limits": repr(limits), "series": series.measure}
        held = {k: own.notes.get(k, v) for k, v in wanted.items()}
        if held != wanted:
            raise ValueError(f"{states} was made for {held}, not for {wanted}")
        if not stale:
            return []
        raw = timeseries.read_months(spark, table, series.variables, source, stale)
        fresh = month_states(raw, series, limits)
        loaded = versions.new_load(spark, states, lambda f: fresh.write.partitionBy(timeseries.MONTH).parquet(f))  # noqa: B023
        notes = wanted | {SOURCE: {p: loads for p, loads in source.parts.items()}}
        changed = {p: loaded.get(p, []) for p in stale}
        try:
            # The notes speak for all months, so nothing may have been committed in between.
            if versions.commit_next(spark, states, own, changed, notes) is None:
                raise versions.Conflict(f"{states}: another refresh came first")
            return stale
        except versions.Conflict:
            if tried == REFRESH_TRIES:
                raise
    raise AssertionError("not reached")


def read_states(
    spark: SparkSession, states: str, series: Series, limits: WeatherLimits = DEFAULT.weather
) -> DataFrame:
    return versions.read(spark, states, _plain(_schema(spark, series, limits)))
