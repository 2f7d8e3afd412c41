"""Per-site statistics of the hourly series.

A site may hold any share of the rows. The exact form therefore first reduces
the series to a histogram per site at the two decimals the percentiles are
reported in (map-side combined, one row per site and distinct hundredth), and
takes everything else from that histogram: rounding is monotone, so the
percentile of rounded values is the rounded percentile. One scan of the series,
and the wide shuffle carries histogram rows rather than observations.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pelagrid.config import DEFAULT, WeatherLimits
from pelagrid.functions.grid import surrogate_key
from pelagrid.functions.numeric import rounded, share, whole_steps

SITE = "location_name"
ACCURACY = 10_000  # an approximate percentile's rank is off by one part in this many at most


def histogram(staged: DataFrame, value: str, extra: Mapping[str, Column], *keys: str) -> DataFrame:
    """One row per site (and further ``keys``) and distinct hundredth, with its moments."""
    x = F.col(value)
    return staged.groupBy(SITE, *keys, whole_steps(x, 2).alias("_bin")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(x).alias("_sum"),
        F.var_pop(x).alias("_var"),
        F.max(x).alias("_max"),
        *(column.alias(name) for name, column in extra.items()),
    )


def _with_positions(hist: DataFrame) -> DataFrame:
    """Cumulative counts and site totals on every histogram row."""
    whole = Window.partitionBy(SITE)
    upto = whole.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        hist.withColumns(
            {
                "_upto": F.sum("_n").over(upto),
                "_total": F.sum("_n").over(whole),
                "_mean": F.sum("_sum").over(whole),
            }
        )
        .withColumn("_mean", F.col("_mean") / F.col("_total"))
    )


def _percentile(percent: int) -> Column:
    """First value whose cumulative share reaches ``percent``; integer arithmetic."""
    reached = F.col("_upto") * F.lit(100) >= F.col("_total") * F.lit(percent)
    return F.min(F.when(reached, F.col("_bin"))) / F.lit(100.0)


def _stddev() -> Column:
    """Sample deviation from within-bin and between-bin spread; NULL for one row."""
    shift = F.col("_sum") / F.col("_n") - F.col("_mean")
    spread = F.sum(F.col("_n") * (F.col("_var") + shift * shift))
    n = F.sum("_n")
    return F.when(n > 1, F.sqrt(F.try_divide(spread, n - F.lit(1))))


def _name_sites(summary: DataFrame, *columns: Column) -> DataFrame:
    name = F.col(SITE)
    return summary.select(
        surrogate_key(name).alias("site_id"), name.alias("site_name"), *columns
    )


def wind_summary(
    stg_wind: DataFrame,
    limits: WeatherLimits = DEFAULT.weather,
    percentiles: str = "exact",
) -> DataFrame:
    """One row per site: mean, spread, peak, power index, percentiles, availability."""
    v = F.col("wind_speed_ms")
    if percentiles == "approx":
        operating = v.between(limits.cut_in_ms, limits.cut_out_ms)
        cuts = F.percentile_approx(v, [0.5, 0.9], ACCURACY)
        stats = stg_wind.groupBy(SITE).agg(
            F.avg(v).alias("avg"),
            F.stddev_samp(v).alias("stddev"),
            F.max(v).alias("max"),
            F.avg(v * v * v).alias("power"),
            cuts.alias("cuts"),
            share(F.count_if(operating), F.count(F.lit(1))).alias("available"),
        )
        return _wind_columns(stats, F.get("cuts", F.lit(0)), F.get("cuts", F.lit(1)))
    return wind_summary_of(histogram(stg_wind, "wind_speed_ms", wind_extra(limits)))


def wind_extra(limits: WeatherLimits = DEFAULT.weather) -> dict[str, Column]:
    """What the wind summary needs of a histogram row besides its moments."""
    v = F.col("wind_speed_ms")
    return {"_cube": F.sum(v * v * v), "_hits": F.count_if(v.between(limits.cut_in_ms, limits.cut_out_ms))}


def wind_summary_of(hist: DataFrame) -> DataFrame:
    """The wind summary of histogram rows; a hundredth may have any number of rows."""
    n = F.sum("_n")
    stats = _with_positions(hist).groupBy(SITE).agg(
        share(F.sum("_sum"), n).alias("avg"),
        _stddev().alias("stddev"),
        F.max("_max").alias("max"),
        share(F.sum("_cube"), n).alias("power"),
        _percentile(50).alias("p50"),
        _percentile(90).alias("p90"),
        share(F.sum("_hits"), n).alias("available"),
    )
    return _wind_columns(stats, F.col("p50"), F.col("p90"))


def _wind_columns(stats: DataFrame, p50: Column, p90: Column) -> DataFrame:
    return _name_sites(
        stats,
        rounded(F.col("avg"), 2).alias("avg_wind_speed_ms"),
        rounded(F.col("stddev"), 2).alias("wind_stddev"),
        rounded(F.col("max"), 2).alias("max_gust_ms"),
        rounded(F.col("power"), 2).alias("wind_power_potential_index"),
        rounded(p50, 2).alias("p50_wind_speed_ms"),
        rounded(p90, 2).alias("p90_wind_speed_ms"),
        rounded(F.col("available"), 4).alias("operational_availability_pct"),
    )


def wave_summary(
    stg_wave: DataFrame,
    limits: WeatherLimits = DEFAULT.weather,
    percentiles: str = "exact",
) -> DataFrame:
    """One row per site: heights, mean period, percentiles, maintenance window."""
    h = F.col("wave_height")
    if percentiles == "approx":
        calm = h < limits.maintenance_wave_m
        stats = stg_wave.groupBy(SITE).agg(
            F.avg(h).alias("avg"),
            F.max(h).alias("max"),
            F.avg("wave_period").alias("period"),
            F.count(F.lit(1)).alias("n"),
            F.percentile_approx(h, [0.9, 0.95], ACCURACY).alias("cuts"),
            share(F.count_if(calm), F.count(F.lit(1))).alias("calm"),
        )
        return _wave_columns(stats, F.get("cuts", F.lit(0)), F.get("cuts", F.lit(1)))
    return wave_summary_of(histogram(stg_wave, "wave_height", wave_extra(limits)))


def wave_extra(limits: WeatherLimits = DEFAULT.weather) -> dict[str, Column]:
    """What the wave summary needs of a histogram row besides its moments."""
    return {
        "_period": F.sum("wave_period"),
        "_periods": F.count("wave_period"),
        "_hits": F.count_if(F.col("wave_height") < limits.maintenance_wave_m),
    }


def wave_summary_of(hist: DataFrame) -> DataFrame:
    """The wave summary of histogram rows; a hundredth may have any number of rows."""
    n = F.sum("_n")
    stats = _with_positions(hist).groupBy(SITE).agg(
        share(F.sum("_sum"), n).alias("avg"),
        F.max("_max").alias("max"),
        share(F.sum("_period"), F.sum("_periods")).alias("period"),
        n.alias("n"),
        _percentile(90).alias("p90"),
        _percentile(95).alias("p95"),
        share(F.sum("_hits"), n).alias("calm"),
    )
    return _wave_columns(stats, F.col("p90"), F.col("p95"))


def settled(summary: DataFrame, staged: DataFrame, value: str, percents: Mapping[str, int]) -> DataFrame:
    """A summary whose approximate percentiles are exact at the reported decimals.

    ``percents`` names its percentile columns of ``value``. Each is judged by the site's counts below it
    and up to it. Only sites where one is off, which needs more rows than the sketch is accurate to, are
    reduced to a histogram.
    """
    x = whole_steps(F.col(value), 2)
    approximate = {c: whole_steps(F.col(c), 2) for c in percents}
    met = staged.select(SITE, x.alias("_bin")).join(
        summary.select(F.col("site_name").alias(SITE), *(c.alias(f"_{name}") for name, c in approximate.items())), SITE
    )
    counts = met.groupBy(SITE).agg(
        F.count(F.lit(1)).alias("_total"),
        *(F.count_if(F.col("_bin") < F.col(f"_{c}")).alias(f"_below_{c}") for c in percents),
        *(F.count_if(F.col("_bin") <= F.col(f"_{c}")).alias(f"_upto_{c}") for c in percents),
    )
    off = F.lit(False)
    for c, percent in percents.items():
        rank = F.col("_total") * F.lit(percent)
        off = off | (F.col(f"_below_{c}") * F.lit(100) >= rank) | (F.col(f"_upto_{c}") * F.lit(100) < rank)
    unsettled = counts.where(off).select(SITE)
    bins = staged.join(unsettled, SITE, "left_semi").groupBy(SITE, x.alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))
    exact = (
        _with_positions(bins.withColumn("_sum", F.lit(0.0)))
        .groupBy(F.col(SITE).alias("site_name"))
        .agg(*(rounded(_percentile(percent), 2).alias(f"_{c}") for c, percent in percents.items()))
    )
    return summary.join(exact, "site_name", "left").select(
        *(F.coalesce(f"_{c}", c).alias(c) if c in percents else c for c in summary.columns)
    )


def _wave_columns(stats: DataFrame, p90: Column, p95: Column) -> DataFrame:
    return _name_sites(
        stats,
        rounded(F.col("avg"), 2).alias("avg_wave_height_m"),
        rounded(F.col("max"), 2).alias("max_wave_height_m"),
        rounded(F.col("period"), 2).alias("avg_wave_period_s"),
        F.col("n").alias("wave_sample_count"),
        rounded(p90, 2).alias("p90_wave_height_m"),
        rounded(p95, 2).alias("p95_wave_height_m"),
        rounded(F.col("calm"), 4).alias("maintenance_window_pct"),
    )
