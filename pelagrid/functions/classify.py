"""Category columns. Bounds are inclusive or exclusive exactly as written."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pelagrid import config as cfg


def pixel_distance_category(km: Column) -> Column:
    return F.when(km < 50, "nearshore").when(km < 100, "midshore").otherwise("offshore")


def site_distance_category(avg_km: Column) -> Column:
    return F.when(avg_km < 11, "nearshore").when(avg_km <= 50, "midshore").otherwise("offshore")


def depth_category(depth: Column) -> Column:
    return F.when(depth < 50, "shallow").when(depth < 200, "transitional").otherwise("deep")


def turbine_type(depth: Column, gates: cfg.Gates) -> Column:
    return (
        F.when(depth <= gates.fixed_max_depth_m, "fixed")
        .when(depth <= gates.max_depth_m, "floating")
        .otherwise("not_viable")
    )


def wind_potential_class(avg_ms: Column) -> Column:
    return F.when(avg_ms >= 9, "high").when(avg_ms >= 6, "medium").otherwise("low")


def survivability_class(max_wave: Column) -> Column:
    return F.when(max_wave < 8, "high").when(max_wave < 12, "medium").otherwise("low")


def sea_state_class(avg_period: Column) -> Column:
    return F.when(avg_period < 6, "choppy").when(avg_period <= 10, "moderate").otherwise("swell")


def survivability_multiplier(klass: Column, multipliers: cfg.Multipliers) -> Column:
    return (
        F.when(klass == "high", F.lit(multipliers.high))
        .when(klass == "medium", F.lit(multipliers.medium))
        .otherwise(F.lit(multipliers.low))
    )


def passes_gates(depth: Column, kind: Column, km: Column, gates: cfg.Gates) -> Column:
    """Rankable: depth in range and far enough offshore for its turbine type."""
    far_enough = ((kind == "fixed") & (km >= gates.fixed_min_coast_km)) | (
        (kind == "floating") & (km >= gates.floating_min_coast_km)
    )
    return depth.between(gates.min_depth_m, gates.max_depth_m) & far_enough


def violates_gates(depth: Column, kind: Column, km: Column, gates: cfg.Gates) -> Column:
    """Any physical rule broken; a row here is a defect in the ranked table."""
    return (
        (depth < gates.min_depth_m)
        | (depth > gates.max_depth_m)
        | ((kind == "fixed") & (km < gates.fixed_min_coast_km))
        | ((kind == "floating") & (km < gates.floating_min_coast_km))
        | (kind == "not_viable")
    )


def near_gate(depth: Column, kind: Column, km: Column) -> Column:
    """Just inside a gate: the sites to look at by hand."""
    return (
        depth.between(10, 20)
        | ((kind == "fixed") & km.between(11, 15))
        | ((kind == "floating") & km.between(5, 10))
    )


def viability_flag(manual: Column, depth: Column, kind: Column, km: Column, gates: cfg.Gates) -> Column:
    """Why a site is not ranked; the first matching reason wins."""
    return (
        F.when(manual, cfg.FLAG_MANUAL)
        .when(depth < gates.min_depth_m, cfg.FLAG_SHALLOW)
        .when(depth > gates.max_depth_m, cfg.FLAG_DEEP)
        .when(kind == "not_viable", cfg.FLAG_TYPE)
        .when((kind == "fixed") & (km < gates.fixed_min_coast_km), cfg.FLAG_FIXED_NEAR)
        .when((kind == "floating") & (km < gates.floating_min_coast_km), cfg.FLAG_FLOATING_NEAR)
        .otherwise(cfg.FLAG_VIABLE)
    )
