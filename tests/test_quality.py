from pelagrid.operators import quality
from pelagrid.operators.quality import EXPECTATIONS, Expect
from pelagrid.plans.pipeline import MODELS


def test_declared_expectations():
    declared = EXPECTATIONS.values()
    assert sum(len(e.unique) for e in declared) == 19
    assert sum(len(e.not_null) for e in declared) == 74
    assert sum(len(e.accepted) for e in declared) == 12
    assert sum(e.size for e in declared) == 105
    assert list(EXPECTATIONS) == list(MODELS) or set(EXPECTATIONS) == set(MODELS)


def test_failing_rows(frame):
    df = frame([("a", 1), ("a", 2), ("b", None), (None, 4), (None, 4), ("z", 5)], "k string, n int")
    assert [(r.k, r.n_records) for r in quality.duplicates(df, "k").collect()] == [("a", 2)]
    assert quality.nulls(df, "n").count() == 1
    odd = quality.unexpected_values(df, "k", ("a", "b"))
    assert [(r.k, r.n_records) for r in odd.collect()] == [("z", 1)]


def test_reports_count_failures(frame):
    df = frame([("a", 1), ("a", 2), ("b", None), (None, 4), ("z", 5)], "k string, n int")
    expect = Expect(("k", "n"), ("k", "n"), {"k": ("a", "b")})
    got = {(r.test, r.column_name): (r.failures, r.passed) for r in quality.column_report(df, "m", expect).collect()}
    assert got == {
        ("not_null", "k"): (1, False),
        ("not_null", "n"): (1, False),
        ("accepted_values", "k"): (1, False),
    }
    unique = [r for part in quality.unique_report(df, "m", expect) for r in part.collect()]
    assert {(r.column_name, r.failures) for r in unique} == {("k", 1), ("n", 0)}


def test_record_id_duplicates_are_found_by_the_declared_column(frame):
    df = frame([("x", "a", None), ("x", "a", None), ("y", "a", 2)], "record_id string, location_name string, observation_time int")
    (report,) = quality.unique_report(df, "m", Expect(("record_id",)))
    assert report.first().failures == 1


def test_unique_columns_of_all_models_share_one_shuffle(spark, frame):
    one = frame([("a", 1), ("a", 2), ("b", None), (None, 2), (None, 4)], "k string, n int")
    two = frame([("a",), ("b",)], "k string")
    parts = [quality.unique_values(one, "one", Expect(("k", "n"))), quality.unique_values(two, "two", Expect(("k",)))]
    none = quality.unique_values(two.limit(0), "three", Expect(("k",)))
    declared = [("one", "k"), ("one", "n"), ("two", "k"), ("three", "k")]
    report = quality.unique_lines(parts[0].unionByName(parts[1]).unionByName(none), declared)
    got = {(r.model, r.column_name): (r.test, r.failures, r.passed) for r in report.collect()}
    assert got == {
        ("one", "k"): ("unique", 1, False),
        ("one", "n"): ("unique", 1, False),
        ("two", "k"): ("unique", 0, True),
        ("three", "k"): ("unique", 0, True),
    }
    plan = report._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Generate") == 3 and plan.count("partial_count(1)") == 1
    executed = report._jdf.queryExecution().executedPlan().toString()
    initial = executed.split("== Initial Plan ==")[-1]
    assert sum("hashpartitioning(model" in line and "value#" in line.split("),")[0] for line in initial.splitlines()) == 1
