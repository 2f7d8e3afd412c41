"""Monthly states against full scans, missing hours against a plain list, marts that are switched over."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pelagrid.config import WeatherLimits
from pelagrid.operators import staging, summaries
from pelagrid.plans import incremental, materialize
from pelagrid.schemas import RAW_WAVE, RAW_WIND, WIND_VARS
from pelagrid.sources import timeseries, versions, worklist


def wind(site, time, speed):
    return (site, 43.0, 4.0, dt.datetime.fromisoformat(time), speed, 1.0, 5.0)


def month(draw, m, sites=("a", "b"), days=9):
    hours = [f"2023-{m:02d}-{d:02d}T{h:02d}:00:00" for d in range(1, days) for h in (0, 6, 12)]
    return [wind(s, t, draw.choice([None, round(draw.uniform(0, 120), 2)])) for s in sites for t in hours]


def full_scan(spark, table):
    return sorted(summaries.wind_summary(staging.stg_wind(timeseries.read_hourly(spark, table, WIND_VARS))).collect())


def from_states(spark, states):
    return sorted(incremental.summary(incremental.read_states(spark, states, incremental.WIND), incremental.WIND).collect())


def test_only_changed_months_are_read(spark, frame, tmp_path, monkeypatch):
    table, states, draw = str(tmp_path / "t"), str(tmp_path / "s"), random.Random(4)
    read = []
    real = timeseries.read_months

    def watch(*args):
        rows = real(*args)
        read.append({f.split("obs_month=")[1][:7] for f in rows.inputFiles()})
        return rows

    for m in (1, 2, 3):
        timeseries.merge_hourly(frame(month(draw, m), RAW_WIND), table)
    monkeypatch.setattr(timeseries, "read_months", watch)
    monkeypatch.setattr(incremental.timeseries, "read_months", watch)
    part = "obs_month=2023-{:02d}".format
    assert incremental.refresh(spark, table, states, incremental.WIND) == [part(1), part(2), part(3)]
    assert incremental.refresh(spark, table, states, incremental.WIND) == []
    timeseries.append_hourly(frame(month(draw, 4, ("b", "c")), RAW_WIND), table)
    assert incremental.refresh(spark, table, states, incremental.WIND) == [part(4)]
    late = [wind("a", "2023-02-01T06:00:00", 200.0), wind("a", "2023-02-27T06:00:00", 1.0)]
    timeseries.merge_hourly(frame(late, RAW_WIND), table)
    assert incremental.refresh(spark, table, states, incremental.WIND) == [part(2)]
    assert read == [{"2023-01", "2023-02", "2023-03"}, {"2023-04"}, {"2023-02"}]
    monkeypatch.undo()
    assert from_states(spark, states) == full_scan(spark, table)
    assert [len(versions.latest(spark, states).parts[part(m)]) for m in (1, 2, 3, 4)] == [1, 1, 1, 1]


def test_months_that_empty_or_go(spark, frame, tmp_path):
    table, states, draw = str(tmp_path / "t"), str(tmp_path / "s"), random.Random(5)
    timeseries.append_hourly(frame(month(draw, 1) + month(draw, 2, ("z",)), RAW_WIND), table)
    incremental.refresh(spark, table, states, incremental.WIND)
    nothing = [wind("z", f"2023-02-{d:02d}T{h:02d}:00:00", None) for d in range(1, 9) for h in (0, 6, 12)]
    timeseries.merge_hourly(frame(nothing, RAW_WIND), table)
    assert incremental.refresh(spark, table, states, incremental.WIND) == ["obs_month=2023-02"]
    assert from_states(spark, states) == full_scan(spark, table)
    versions.commit(spark, table, versions.latest(spark, table), {"obs_month=2023-01": []})
    assert incremental.refresh(spark, table, states, incremental.WIND) == ["obs_month=2023-01"]
    assert from_states(spark, states) == full_scan(spark, table) == []
    assert incremental.refresh(spark, str(tmp_path / "none"), str(tmp_path / "of none"), incremental.WIND) == []


def test_rows_without_a_month_have_a_state(spark, frame, tmp_path):
    table, states = str(tmp_path / "t"), str(tmp_path / "s")
    rows = [("a", 43.0, 4.0, None, 36.0, 1.0, 5.0), wind("a", "2023-01-01T00:00:00", 18.0)]
    timeseries.append_hourly(frame(rows, RAW_WIND), table)
    assert len(incremental.refresh(spark, table, states, incremental.WIND)) == 2
    assert from_states(spark, states) == full_scan(spark, table)
    assert from_states(spark, states)[0].avg_wind_speed_ms == 7.5


def test_two_refreshes_at_once(spark, frame, tmp_path, monkeypatch):
    table, states, draw = str(tmp_path / "t"), str(tmp_path / "s"), random.Random(6)
    timeseries.append_hourly(frame(month(draw, 1), RAW_WIND), table)
    real, between = versions.commit_next, []

    def commit(*args):
        if not between:
            between.append(True)
            timeseries.append_hourly(frame(month(draw, 2), RAW_WIND), table)
            incremental.refresh(spark, table, states, incremental.WIND)
        return real(*args)

    monkeypatch.setattr(versions, "commit_next", commit)
    assert incremental.refresh(spark, table, states, incremental.WIND) == []
    assert from_states(spark, states) == full_scan(spark, table)


def test_states_belong_to_their_limits(spark, frame, tmp_path):
    table, states, draw = str(tmp_path / "t"), str(tmp_path / "s"), random.Random(7)
    timeseries.append_hourly(frame(month(draw, 1), RAW_WIND), table)
    incremental.refresh(spark, table, states, incremental.WIND)
    with pytest.raises(ValueError, match="was made for"):
        incremental.refresh(spark, table, states, incremental.WIND, WeatherLimits(cut_in_ms=1.0))


def test_missing_hours_equal_a_plain_list(frame):
    draw = random.Random(8)
    hours = [dt.datetime(2023, 1, 1) + dt.timedelta(hours=h) for h in range(8760)]
    have = {s: sorted(draw.sample(hours, n)) for s, n in (("few", 3), ("many", 8700), ("all", 8760))}
    have["ends"] = [hours[0], hours[-1]]
    rows = [(s, 43.0, 4.0, t + dt.timedelta(minutes=m), 1.0, 1.0, 5.0) for s, ts in have.items() for t in ts for m in (0, 7)]
    rows += [("few", 43.0, 4.0, None, 1.0, 1.0, 5.0), ("few", 43.0, 4.0, dt.datetime(2021, 5, 5), 1.0, 1.0, 5.0)]
    sites = frame([(s,) for s in (*have, "none")], "location_name string")
    requests = worklist.backfill_requests(sites, 2023, 2023)
    want = set()
    for s in (*have, "none"):
        present, run = set(have.get(s, ())), []
        for h in [*hours, None]:
            if h is not None and h not in present:
                run.append(h)
            elif run:
                want.add((s, 2023, run[0], run[-1], len(run)))
                run = []
    stored = frame(rows, RAW_WAVE)
    got = worklist.missing_hours(requests.unionByName(requests), stored).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    open_years = {r.location_name: r.missing_hours for r in worklist.incomplete_requests(requests, stored, 60).collect()}
    assert open_years == {"few": 8757, "none": 8760, "ends": 8758}
    assert {r.location_name for r in worklist.missing_requests(requests, stored).collect()} == {"none"}


def test_a_bucketed_table_is_summarised_without_a_shuffle_of_its_rows(spark, frame):
    draw = random.Random(9)
    rows = [*month(draw, 1), *month(draw, 2, ("c",)), ("a", 43.0, 4.0, None, 36.0, 1.0, 5.0), (None, 43.0, 4.0, None, 36.0, 1.0, 5.0)]
    source = frame(rows, RAW_WIND)
    for _ in range(2):  # saved again: replaced
        timeseries.save_bucketed(source, "bucketed_t", 4)
    table = spark.table("bucketed_t")
    assert sorted(map(str, table.select(*source.columns).collect())) == sorted(map(str, source.collect()))
    states = incremental.month_states(table, incremental.WIND)
    plan = states._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan and plan.count("HashAggregate") >= 2
    plain = summaries.wind_summary(staging.stg_wind(source)).collect()
    assert sorted(map(str, incremental.summary(states, incremental.WIND).collect())) == sorted(map(str, plain))
    spark.sql("DROP TABLE bucketed_t")


class Marts:
    """Stands for a pipeline: a mart by its name."""

    def __init__(self, **marts):
        self.marts = marts

    def model(self, name):
        return self.marts[name]


def test_marts_stay_readable_while_they_are_replaced(spark, frame):
    publish = lambda df: materialize.publish_marts(spark, Marts(m=df), ("m",), "marts_test")
    one = frame([(1, "a")], "k int, v string")
    assert publish(one) == ["marts_test.m"]
    reading = spark.table("marts_test.m")
    with pytest.raises(Exception, match="broken"):
        publish(one.withColumn("v", F.raise_error(F.lit("broken"))))
    assert spark.table("marts_test.m").collect() == [(1, "a")]
    publish(one.union(one))
    assert spark.table("marts_test.m").count() == 2 and reading.collect() == [(1, "a")]
    publish(frame([], "k int, v string"))
    assert spark.table("marts_test.m").count() == 0
    publish(one.withColumn("w", F.lit(2.0)))
    assert spark.table("marts_test.m").columns == ["k", "v", "w"]
    spark.sql("DROP DATABASE marts_test CASCADE")
