import random
import statistics

import pytest

from pelagrid.operators import summaries

WIND = "location_name string, wind_speed_ms double"
WAVE = "location_name string, wave_height double, wave_period double"


def discrete(values, percent):
    """First ordered value whose rank share reaches the percentage."""
    ordered = sorted(values)
    return ordered[max(0, -(-len(ordered) * percent // 100) - 1)]


def test_wind_summary_against_plain_python(frame):
    rng = random.Random(3)
    series = {
        "hot": [round(rng.uniform(0, 30), 4) for _ in range(5000)],
        "tied": [8.5] * 40 + [3.0] * 10,
        "one": [7.1234],
        "pair": [25.0, 6.0],
    }
    df = frame([(k, v) for k, vs in series.items() for v in vs], WIND)
    for mode in ("exact", "approx"):
        got = {r.site_name: r for r in summaries.wind_summary(df, percentiles=mode).collect()}
        assert set(got) == set(series)
        for name, vs in series.items():
            r = got[name]
            assert r.avg_wind_speed_ms == pytest.approx(statistics.fmean(vs), abs=0.0051)
            assert r.max_gust_ms == pytest.approx(max(vs), abs=0.0051)
            assert r.wind_power_potential_index == pytest.approx(statistics.fmean(v**3 for v in vs), abs=0.0051)
            assert r.p50_wind_speed_ms == pytest.approx(discrete(vs, 50), abs=0.0051)
            assert r.p90_wind_speed_ms == pytest.approx(discrete(vs, 90), abs=0.0051)
            share = sum(6 <= v <= 25 for v in vs) / len(vs)
            assert r.operational_availability_pct == pytest.approx(share, abs=0.000051)
            if len(vs) > 1:
                assert r.wind_stddev == pytest.approx(statistics.stdev(vs), abs=0.0051)
            else:
                assert r.wind_stddev is None


def test_exact_percentiles_round_the_order_statistic(frame):
    values = [1.004, 1.006, 1.016, 2.5, 9.994, 9.996]
    df = frame([("s", v) for v in values], WIND)
    r = summaries.wind_summary(df).first()
    assert (r.p50_wind_speed_ms, r.p90_wind_speed_ms) == (1.02, 10.0)


def test_wave_summary(frame):
    rows = [("a", 0.5, 4.0), ("a", 1.5, None), ("a", 3.0, 8.0), ("b", 2.0, None)]
    for mode in ("exact", "approx"):
        got = {r.site_name: r for r in summaries.wave_summary(frame(rows, WAVE), percentiles=mode).collect()}
        a, b = got["a"], got["b"]
        assert (a.avg_wave_height_m, a.max_wave_height_m, a.avg_wave_period_s) == (1.67, 3.0, 6.0)
        assert (a.wave_sample_count, a.p90_wave_height_m, a.p95_wave_height_m) == (3, 3.0, 3.0)
        # The window is exclusive: 1.5 m is already too rough.
        assert a.maintenance_window_pct == 0.3333
        assert (b.avg_wave_period_s, b.maintenance_window_pct) == (None, 0.0)


def test_settled_percentiles_are_exact_beyond_the_accuracy_of_the_sketch(spark, monkeypatch):
    """A coarse sketch is off by hundredths in the site with many rows; the settled one is not."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(summaries, "ACCURACY", 20)
    draw = F.floor(F.pow(F.pmod(F.xxhash64("id"), F.lit(3000)) / 60.0, 2.0)) / 100
    rows = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") < 59_990, "hot").otherwise("small").alias("location_name"),
        draw.alias("wind_speed_ms"), draw.alias("wave_height"), draw.alias("wave_period"),
    )
    series = {}
    for r in rows.collect():
        series.setdefault(r.location_name, []).append(r.wave_height)
    for make, value, percents in (
        (summaries.wind_summary, "wind_speed_ms", {"p50_wind_speed_ms": 50, "p90_wind_speed_ms": 90}),
        (summaries.wave_summary, "wave_height", {"p90_wave_height_m": 90, "p95_wave_height_m": 95}),
    ):
        sketched = make(rows, percentiles="approx")
        got = summaries.settled(sketched, rows, value, percents)
        assert got.columns == sketched.columns
        want = {(s, c): discrete(series[s], p) for s in series for c, p in percents.items()}
        assert {(r.site_name, c): r[c] for r in sketched.collect() for c in percents} != want
        assert {(r.site_name, c): r[c] for r in got.collect() for c in percents} == want


def test_approximate_summaries_show_their_percentiles():
    import oracle

    for name in ("wind_summary", "wave_summary"):
        assert oracle.ORACLES[f"{name}_approx"] == oracle.ORACLES[name]


def test_hot_site_is_reduced_before_the_shuffle(spark):
    """One site with most rows: the shuffle carries its histogram, not its rows."""
    from pyspark.sql import functions as F

    rows = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("location_name"),
        (F.col("id") % 2000 / 100.0).alias("wind_speed_ms"),
    )
    df = summaries.wind_summary(rows)
    got = {r.site_name: r for r in df.collect()}
    assert len(got) == 51
    want = discrete([i % 2000 / 100.0 for i in range(300_000) if i % 3 > 0], 90)
    assert got["hot"].p90_wind_speed_ms == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("HashAggregate") < plan.index("Exchange")
    assert "hashpartitioning(location_name" in plan and "_groupingexpression" in plan
