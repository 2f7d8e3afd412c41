from dataclasses import replace

import pytest

from pelagrid.config import DEFAULT, FLAG_MANUAL, FLAG_VIABLE
from pelagrid.operators import staging
from pelagrid.plans import materialize, quality_report, reports, validation
from pelagrid.plans.pipeline import COMPOSITE, MODELS, Pipeline
from pelagrid.sources import demo

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pipeline(spark):
    return Pipeline(demo.raw_tables(spark, SF), shared=True)


def rows(pipeline, name):
    return pipeline.model(name).collect()


def test_scores_are_in_unit_range(pipeline):
    for r in rows(pipeline, "composite_unfiltered"):
        for score in ("spatial_score", "wind_score", "wave_score", "raw_final_score", "final_score"):
            assert 0.0 <= r[score] <= 1.0
        assert r.final_score <= r.raw_final_score


def test_composite_is_unfiltered_minus_gates(pipeline):
    gated = {r.site_name: r for r in rows(pipeline, "composite")}
    for r in rows(pipeline, "composite_unfiltered"):
        passes = r.viability_flag in (FLAG_VIABLE, FLAG_MANUAL)
        assert (r.site_name in gated) == passes
        if passes:
            assert all(gated[r.site_name][c] == r[c] for c in COMPOSITE)
    assert pipeline.model("composite").columns == COMPOSITE


def test_ranks(pipeline, spark):
    ranked = rows(pipeline, "mart_prioritization")
    assert sorted(r.site_rank for r in ranked) == list(range(1, len(ranked) + 1))
    ordered = sorted(ranked, key=lambda r: (-r.final_score, -r.avg_wind_speed_ms, r.site_name))
    assert [r.site_rank for r in ordered] == list(range(1, len(ranked) + 1))
    gis = {r.site_name: r for r in rows(pipeline, "mart_gis")}
    viable = {n for n, r in gis.items() if r.viability_flag == FLAG_VIABLE}
    assert {r.site_name for r in ranked} == viable
    assert all((gis[n].site_rank is not None) == (n in viable) for n in gis)
    narrow = Pipeline(pipeline.raw, replace(DEFAULT, rank_scope="viable"))
    assert {(r.site_name, r.site_rank) for r in rows(narrow, "mart_gis") if r.site_rank} == {
        (r.site_name, r.site_rank) for r in ranked
    }


def test_null_in_exclusions_empties_the_ranked_mart_only(pipeline, spark):
    with_null = pipeline.raw.exclusions.union(
        spark.createDataFrame([(None,) * 4], pipeline.raw.exclusions.schema)
    )
    p = Pipeline(replace(pipeline.raw, exclusions=with_null))
    assert rows(p, "mart_prioritization") == []
    assert len(rows(p, "composite_unfiltered")) == len(rows(pipeline, "composite_unfiltered"))


def test_shared_and_single_pipelines_agree(pipeline):
    single = Pipeline(pipeline.raw)
    for name in ("site_centers", "spatial_score", "wave_score"):
        assert sorted(rows(single, name)) == sorted(rows(pipeline, name))
    assert {(r.site_name, r.final_score) for r in rows(single, "composite")} == {
        (r.site_name, r.final_score) for r in rows(pipeline, "composite")
    }


def test_every_declared_expectation_holds(pipeline):
    report = quality_report.run(pipeline).collect()
    assert len(report) == 105
    assert [r for r in report if not r.passed] == []


def test_checklist(pipeline):
    got = {r.check_name: r for r in validation.summary(pipeline, expected_sites=60).collect()}
    assert len(got) == 8
    assert got["sites_in_gis_mart"].passed and got["gate_consistency"].passed
    assert got["excluded_have_null_rank"].passed and got["no_negative_depths"].passed
    deciles = validation.score_deciles(pipeline).orderBy("decile").collect()
    assert [r.decile for r in deciles] == list(range(1, 11))
    assert validation.gate_violations(pipeline).count() == 0


def test_dashboard_slices(pipeline):
    mart = pipeline.model("mart_prioritization")
    floating = reports.dashboard_slice(mart, turbine_type="floating").count()
    fixed = reports.dashboard_slice(mart, turbine_type="fixed").count()
    assert floating + fixed == mart.count()
    top = reports.top_ranked(mart, 3)
    assert [r.site_rank for r in top.collect()] == [1, 2, 3]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_smoke_run_covers_the_graph(spark):
    raw = demo.raw_tables(spark, SF).smoke(demo.DEMO_SMOKE_SITES, demo.DEMO_SMOKE_YEAR)
    p = Pipeline(raw, shared=True)
    assert {r.site_name for r in rows(p, "wind_summary")} == set(demo.DEMO_SMOKE_SITES)
    assert len(rows(p, "mart_gis")) == 3
    with pytest.raises(KeyError, match="no model named"):
        p.model("stg_nothing")


def test_publish(spark, pipeline):
    built = materialize.build_all(spark, pipeline, database="marts_test")
    assert set(built["views"]) | {t.split(".")[1] for t in built["tables"]} == set(MODELS)
    assert spark.table("marts_test.mart_gis").count() == 60
    assert spark.sql("SELECT count(*) AS n FROM wind_score WHERE wind_score > 1").first().n == 0
    materialize.publish_marts(spark, pipeline, ("mart_gis",), "marts_test")
    assert spark.table("marts_test.mart_gis").count() == 60
    spark.sql("DROP DATABASE marts_test CASCADE")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_composite_scans_each_series_once(spark):
    plan = plan_of(Pipeline(demo.raw_tables(spark, SF)).model("composite"))
    assert plan.count("events.parquet") == 2
    assert plan.count("orders.parquet") == 3
    assert "observation_time" not in plan and "BatchEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_staging_filter_reaches_parquet(spark, tmp_path):
    path = str(tmp_path / "b")
    demo.raw_bathymetry(spark, SF).write.parquet(path)
    plan = plan_of(staging.stg_bathymetry(spark.read.parquet(path)).select("depth_m"))
    assert "LessThan(elevation_m,0.0)" in plan
    assert "ReadSchema: struct<elevation_m:double>" in plan
