"""Score columns in 0..1, rounded to four decimals; NULL input gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pelagrid.config import Curves, Weights
from pelagrid.functions.numeric import capped, floored, rounded


def _fall_off(value: Column, span: float) -> Column:
    """Linear: 1 at zero, 0 at ``span`` and beyond."""
    return rounded(F.lit(1.0) - capped(value, span) / F.lit(span), 4)


def _bell(value: Column, peak: float, width: float) -> Column:
    """Parabola: 1 at ``peak``, 0 at ``width`` either side."""
    offset = (value - F.lit(peak)) / F.lit(width)
    return rounded(floored(F.lit(1.0) - F.pow(offset, F.lit(2.0))), 4)


def _by_type(kind: Column, fixed: Column, floating: Column) -> Column:
    return F.when(kind == "fixed", fixed).when(kind == "floating", floating).otherwise(F.lit(0.0))


def depth_score(kind: Column, depth: Column, c: Curves) -> Column:
    return _by_type(
        kind,
        _fall_off(depth, c.fixed_depth_span),
        _bell(depth, c.floating_depth_peak, c.floating_depth_width),
    )


def coast_score(kind: Column, km: Column, c: Curves) -> Column:
    return _by_type(
        kind,
        _fall_off(km, c.fixed_coast_span),
        _bell(km, c.floating_coast_peak, c.floating_coast_width),
    )


def spatial_score(depth: Column, coast: Column) -> Column:
    return rounded((depth + coast) / F.lit(2.0), 4)


def wind_component(value: Column, ideal: float) -> Column:
    """Unrounded share of an ideal speed, at most 1."""
    return capped(value / F.lit(ideal), 1.0)


def wind_score(avg: Column, p50: Column, p90: Column, c: Curves, w: Weights) -> Column:
    return rounded(
        F.lit(w.wind_avg) * wind_component(avg, c.avg_wind_ideal)
        + F.lit(w.wind_p50) * wind_component(p50, c.p50_wind_ideal)
        + F.lit(w.wind_p90) * wind_component(p90, c.p90_wind_ideal),
        4,
    )


def wave_score(kind: Column, avg_height: Column, c: Curves) -> Column:
    def under(limit: float) -> Column:
        return rounded(floored(F.lit(1.0) - avg_height / F.lit(limit)), 4)

    return _by_type(kind, under(c.fixed_wave_limit), under(c.floating_wave_limit))


def weighted_sum(spatial: Column, wind: Column, wave: Column, w: Weights) -> Column:
    """Unrounded composite; also the sort key of the weight-sensitivity report."""
    return F.lit(w.spatial) * spatial + F.lit(w.wind) * wind + F.lit(w.wave) * wave
