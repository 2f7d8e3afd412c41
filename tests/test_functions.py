import math

import pytest
from pyspark.sql import functions as F

from pelagrid import config as cfg
from pelagrid.functions import classify, grid, numeric, scoring

GATES, CURVES = cfg.DEFAULT.gates, cfg.DEFAULT.curves


def each(spark, column, values, kind="double"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r.x for r in df.select("i", column.alias("x")).orderBy("i").collect()]



def test_clean_numeric(spark):
    got = each(spark, numeric.clean_numeric(F.col("v")), ["NaN", "x", None, "1.5", "-2", ""], "string")
    assert got == [None, None, None, 1.5, -2.0, None]
    assert each(spark, numeric.clean_numeric(F.col("v")), [math.nan, 2.0]) == [None, 2.0]


def test_capped_and_floored_keep_null(spark):
    assert each(spark, numeric.capped(F.col("v"), 200), [None, 1.0, 300.0]) == [None, 1.0, 200.0]
    assert each(spark, numeric.floored(F.col("v")), [None, -1.0, 0.5]) == [None, 0.0, 0.5]


def test_rounded_settles_halves(spark):
    assert each(spark, numeric.rounded(F.col("v"), 4), [0.9632499999999999, 0.96325, 0.96324, None]) == [
        0.9633,
        0.9633,
        0.9632,
        None,
    ]


def test_whole_steps_equal_rounded(spark):
    values = [2.7649999999999997, 2.765, 1.005, -1.005, -0.004, 0.0, 99.994999, 0.3 * 3.7, None]
    rounded = each(spark, numeric.rounded(F.col("v"), 2), values)
    steps = each(spark, numeric.whole_steps(F.col("v"), 2) / 100.0, values)
    assert steps == rounded
    assert rounded[:4] == [2.77, 2.77, 1.01, -1.01]


def test_kmh_to_ms(spark):
    assert each(spark, numeric.to_ms(F.col("v")), [36.0, 1.0, None]) == [10.0, 0.2778, None]


def test_share_of_empty_group(spark, one):
    assert one(numeric.share(F.col("a"), F.col("b")), "a long, b long", 0, 0) is None
    assert one(numeric.share(F.col("a"), F.col("b")), "a long, b long", 1, 4) == 0.25


def test_snap(spark):
    got = each(spark, grid.snap(F.col("v")), [-0.1, 42.75, 42.9999, 0.0, -0.25])
    assert got == [-0.125, 42.875, 42.875, 0.125, -0.125]


def test_cell_key_text_and_index_agree(spark, one):
    direct = grid.cell_key(F.col("a"), F.col("b"))
    by_index = grid.index_key(grid.cell_index(F.col("a")), grid.cell_index(F.col("b")))
    expected = one(F.md5(F.lit("42.875-3.125")), "a int", 1)
    assert one(direct, "a double, b double", 42.75, 3.0) == expected
    assert one(by_index, "a double, b double", 42.99, 3.24) == expected


def test_surrogate_key_nulls_are_distinct(spark, frame):
    df = frame([("a", None), (None, "a"), ("a", ""), (None, None)], "x string, y string")
    keys = [r.k for r in df.select(grid.surrogate_key(F.col("x"), F.col("y")).alias("k")).collect()]
    assert len(set(keys)) == 4 and all(len(k) == 32 for k in keys)


def test_site_coordinate(spark):
    names = ["GULF_OF_LION_43.0_4.0", "AEGEAN_39.0_25.0", "GULF_OF_LION_42.75_-0.5", None]
    assert each(spark, grid.site_coordinate(F.col("v"), "lat"), names, "string") == [43.0, None, 42.75, None]
    assert each(spark, grid.site_coordinate(F.col("v"), "lon"), names, "string") == [4.0, None, -0.5, None]
    long_name = ["BAY_OF_SOUTH_BISCAY_44.0_-2.0"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        each(spark, grid.site_coordinate(F.col("v"), "lat"), long_name, "string")
    tail = [*long_name, "AEGEAN_39.0_25.0", "X"]
    assert each(spark, grid.site_coordinate(F.col("v"), "lat", True), tail, "string") == [44.0, 39.0, None]
    assert each(spark, grid.site_coordinate(F.col("v"), "lon", True), tail, "string") == [-2.0, 25.0, None]


def test_nearest_line_and_site_key(spark, one):
    assert each(spark, grid.nearest_line(F.col("v"), 0.25), [42.8, 42.9, 42.875, -0.2]) == [
        42.75,
        43.0,
        43.0,
        -0.25,
    ]
    key = grid.site_key(F.lit("gulf_of_lion"), F.col("a"), F.col("b"))
    assert one(key, "a double, b double", 41.5, 3.0) == "GULF_OF_LION_41.5_3.0"


@pytest.mark.parametrize(
    ("column", "values", "expected"),
    [
        (
            lambda v: classify.pixel_distance_category(v),
            [49.99, 50.0, 99.99, 100.0, None],
            ["nearshore", "midshore", "midshore", "offshore", "offshore"],
        ),
        (
            lambda v: classify.site_distance_category(v),
            [10.99, 11.0, 50.0, 50.01, None],
            ["nearshore", "midshore", "midshore", "offshore", "offshore"],
        ),
        (
            lambda v: classify.depth_category(v),
            [49.99, 50.0, 199.99, 200.0],
            ["shallow", "transitional", "transitional", "deep"],
        ),
        (
            lambda v: classify.turbine_type(v, GATES),
            [9.99, 50.0, 50.01, 1000.0, 1000.01, None],
            ["fixed", "fixed", "floating", "floating", "not_viable", "not_viable"],
        ),
        (lambda v: classify.wind_potential_class(v), [5.99, 6.0, 8.99, 9.0], ["low", "medium", "medium", "high"]),
        (
            lambda v: classify.survivability_class(v),
            [7.99, 8.0, 11.99, 12.0],
            ["high", "medium", "medium", "low"],
        ),
        (
            lambda v: classify.sea_state_class(v),
            [5.99, 6.0, 10.0, 10.01],
            ["choppy", "moderate", "moderate", "swell"],
        ),
    ],
)
def test_classifiers(spark, column, values, expected):
    assert each(spark, column(F.col("v")), values) == expected


def test_multiplier(spark):
    column = classify.survivability_multiplier(F.col("v"), cfg.DEFAULT.multipliers)
    assert each(spark, column, ["high", "medium", "low", None], "string") == [1.0, 0.9, 0.7, 0.7]


SITE = "manual boolean, depth double, kind string, km double"
SITES = [
    (True, 5.0, "fixed", 1.0, cfg.FLAG_MANUAL, False),
    (False, 9.99, "fixed", 20.0, cfg.FLAG_SHALLOW, False),
    (False, 1000.01, "not_viable", 20.0, cfg.FLAG_DEEP, False),
    (False, 500.0, "not_viable", 20.0, cfg.FLAG_TYPE, False),
    (False, 30.0, "fixed", 10.99, cfg.FLAG_FIXED_NEAR, False),
    (False, 30.0, "fixed", 11.0, cfg.FLAG_VIABLE, True),
    (False, 100.0, "floating", 4.99, cfg.FLAG_FLOATING_NEAR, False),
    (False, 100.0, "floating", 5.0, cfg.FLAG_VIABLE, True),
    (False, 10.0, "fixed", 11.0, cfg.FLAG_VIABLE, True),
    (False, 1000.0, "floating", 5.0, cfg.FLAG_VIABLE, True),
    (False, 100.0, "floating", None, cfg.FLAG_VIABLE, None),
]


@pytest.mark.parametrize("site", SITES)
def test_gates_and_flags(one, site):
    *values, flag, passes = site
    d, k, km = F.col("depth"), F.col("kind"), F.col("km")
    assert one(classify.viability_flag(F.col("manual"), d, k, km, GATES), SITE, *values) == flag
    assert one(classify.passes_gates(d, k, km, GATES), SITE, *values) is passes
    if passes:
        assert one(classify.violates_gates(d, k, km, GATES), SITE, *values) is False
    elif passes is False and not values[0]:
        assert one(classify.violates_gates(d, k, km, GATES), SITE, *values) is True


def test_near_gate(one):
    near = classify.near_gate(F.col("depth"), F.col("kind"), F.col("km"))
    assert one(near, SITE, False, 20.0, "fixed", 90.0)
    assert one(near, SITE, False, 40.0, "fixed", 15.0)
    assert not one(near, SITE, False, 40.0, "fixed", 15.1)
    assert one(near, SITE, False, 100.0, "floating", 10.0)
    assert not one(near, SITE, False, 100.0, "floating", 10.1)


def test_depth_scores(spark):
    fixed = scoring.depth_score(F.lit("fixed"), F.col("v"), CURVES)
    floating = scoring.depth_score(F.lit("floating"), F.col("v"), CURVES)
    assert each(spark, fixed, [0.0, 50.0, 200.0, 400.0, None]) == [1.0, 0.75, 0.0, 0.0, None]
    assert each(spark, floating, [180.0, 380.0, 900.0, 80.0, None]) == [1.0, 0.0, 0.0, 0.75, None]
    assert each(spark, scoring.depth_score(F.lit("not_viable"), F.col("v"), CURVES), [5.0, None]) == [0.0, 0.0]


def test_coast_scores(spark):
    fixed = scoring.coast_score(F.lit("fixed"), F.col("v"), CURVES)
    floating = scoring.coast_score(F.lit("floating"), F.col("v"), CURVES)
    assert each(spark, fixed, [0.0, 20.0, 200.0, None]) == [1.0, 0.9, 0.0, None]
    assert each(spark, floating, [35.0, 95.0, 5.0, None]) == [1.0, 0.0, 0.75, None]


def test_wind_and_wave_scores(one, spark):
    wind = scoring.wind_score(F.col("a"), F.col("m"), F.col("h"), CURVES, cfg.DEFAULT.weights)
    schema = "a double, m double, h double"
    assert one(wind, schema, 12.0, 10.0, 18.0) == 1.0
    assert one(wind, schema, 24.0, 20.0, 36.0) == 1.0
    assert one(wind, schema, 6.0, 5.0, 9.0) == 0.5
    assert one(wind, schema, 6.0, None, 9.0) is None
    fixed = scoring.wave_score(F.lit("fixed"), F.col("v"), CURVES)
    floating = scoring.wave_score(F.lit("floating"), F.col("v"), CURVES)
    assert each(spark, fixed, [0.0, 1.0, 4.0, 9.0, None]) == [1.0, 0.75, 0.0, 0.0, None]
    assert each(spark, floating, [1.5, 6.0]) == [0.75, 0.0]


def test_speeds_that_are_no_number_or_huge_are_kept(spark):
    values = [float("nan"), float("inf"), 1e16, -1e16, 36.0, None]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(numeric.to_ms(F.col("v")).alias("x")).collect()
    got = [r.x for r in rows]
    assert got[0] != got[0] and got[1] == float("inf") and got[5] is None and got[4] == 10.0
    assert abs(got[2] - 1e16 / 3.6) < 1 and got[3] == -got[2]
