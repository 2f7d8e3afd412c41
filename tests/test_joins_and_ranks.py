import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pelagrid.operators import joins, ranking


def names(df):
    return sorted((r.x for r in df.collect()), key=str)


@pytest.mark.parametrize(
    ("listed", "kept"),
    [
        (["a", "a"], ["b"]),
        (["a", None], []),
        ([None], []),
        ([], [None, "a", "b"]),
        (["z"], ["a", "b"]),
    ],
)
def test_not_in_follows_sql(spark, frame, listed, kept):
    df = frame([("a", 1), ("b", 2), (None, 3)], "x string, n int")
    others = frame([(v,) for v in listed], "y string")
    got = joins.not_in(df, "x", others, "y")
    assert names(got) == sorted(kept, key=str)
    df.createOrReplaceTempView("probe")
    others.createOrReplaceTempView("listed")
    assert names(spark.sql("SELECT * FROM probe WHERE x NOT IN (SELECT y FROM listed)")) == names(got)


def test_flag_in_never_null_never_multiplies(frame):
    df = frame([("a",), ("b",), (None,)], "x string")
    got = joins.flag_in(df, "x", frame([("a",), ("a",), (None,)], "y string"), "hit", "y")
    assert {(r.x, r.hit) for r in got.collect()} == {("a", True), ("b", False), (None, False)}


@pytest.fixture
def scores(frame):
    rng = random.Random(5)
    # A third of the rows share one score.
    rows = [(f"s{i:04d}", 0.5 if i % 3 == 0 else round(rng.random(), 2)) for i in range(600)]
    rows.append(("none", None))
    return frame(rows, "name string, score double")


def order():
    return [F.desc("score"), F.asc("name")]


def test_distributed_row_number_equals_window(scores):
    plain = scores.withColumn("n", F.row_number().over(Window.orderBy(*order())))
    sliced = ranking.row_number(scores, order(), "n").collect()
    assert {(r.name, r.n) for r in plain.collect()} == {(r.name, r.n) for r in sliced}
    assert sorted(r.n for r in sliced) == list(range(1, 602))


@pytest.mark.parametrize("tiles", [1, 7, 10, 1000])
def test_distributed_ntile_equals_window(scores, tiles):
    plain = scores.withColumn("t", F.ntile(tiles).over(Window.orderBy(*order()))).collect()
    sliced = ranking.ntile(scores, tiles, order(), "t").collect()
    assert {(r.name, r.t) for r in plain} == {(r.name, r.t) for r in sliced}
    by_value = ranking.value_tiles(scores, "score", tiles, "t").collect()
    # Within equal scores rows are interchangeable: only the counts are determined.
    ascending = scores.withColumn("t", F.ntile(tiles).over(Window.orderBy("score"))).groupBy("score", "t")
    assert {(r.score, r.t, r.n) for r in by_value} == {(r.score, r.t, r["count"]) for r in ascending.count().collect()}


def test_a_score_of_most_rows_is_one_row_of_the_decile_plan(spark, frame):
    many = spark.range(4000).selectExpr("CASE WHEN id % 10 > 0 THEN 0.5 ELSE id / 4000D END AS score")
    tiles = ranking.value_tiles(many, "score", 10, "t").collect()
    assert len([r for r in tiles if r.score == 0.5]) == 10 and sum(r.n for r in tiles) == 4000
    assert {t: sum(r.n for r in tiles if r.t == t) for t in range(1, 11)} == dict.fromkeys(range(1, 11), 400)


def test_distributed_rank_equals_window(scores):
    values = {"a": F.col("score"), "b": F.col("score") * -1.0}
    plain = scores.withColumns({k: F.rank().over(Window.orderBy(v.desc())) for k, v in values.items()}).collect()
    sliced = ranking.rank(scores, values).collect()
    assert {(r.name, r.a, r.b) for r in plain} == {(r.name, r.a, r.b) for r in sliced}


def test_ranks_of_several_types_with_nulls_equal_windows(frame):
    rows = [(i, None if i % 11 == 0 else (i * 7) % 5, None if i % 13 == 0 else (i % 17) / 4, i // 2) for i in range(300)]
    df = frame(rows, "id int, a long, b double, c int")
    values = {"ra": F.col("a"), "rb": F.col("b"), "rc": F.col("c"), "rd": F.col("b") * -1}
    got = ranking.rank(df, values)
    want = df.withColumns({k: F.rank().over(Window.orderBy(v.desc())) for k, v in values.items()})
    assert got.columns == want.columns
    assert sorted(got.collect(), key=lambda r: r.id) == sorted(want.collect(), key=lambda r: r.id)
    assert ranking.rank(df.limit(0), values).count() == 0
