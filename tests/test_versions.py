"""Versions of tables: killed writes, two writers, retention; counts taken while a batch is written."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from pelagrid.config import RasterGrid
from pelagrid.schemas import GRID_POINTS, RAW_BATHYMETRY, RAW_COASTLINE, RAW_WAVE, WAVE_VARS
from pelagrid.sources import rasters, reference_data, timeseries, versions

ROWS = "latitude double, longitude double, elevation_m double"


def sea(frame, *depths):
    return frame([(float(i), 1.0, d) for i, d in enumerate(depths)], ROWS)


def depths(spark, path):
    return sorted(r.elevation_m for r in rasters.read_bathymetry(spark, path).collect())


class Killed(BaseException):
    """Stands for a process that ends: no handler of the library may depend on running."""


@pytest.mark.parametrize("at", ["write", "before", "create", "rename", "after"])
def test_a_write_killed_anywhere_leaves_one_readable_version(spark, frame, tmp_path, monkeypatch, at):
    path = str(tmp_path / "table")
    rasters.load_tiles([sea(frame, -1.0, -2.0)], path)
    real_create, real_put, real_delete = versions._create, versions._write, versions.delete_folder

    def die(*_):
        raise Killed

    def create(*args):
        if at == "before":
            die()
        done = real_create(*args)
        if at == "after":
            die()
        return done

    monkeypatch.setattr(versions, "_create", create)
    monkeypatch.setattr(versions, "delete_folder", lambda *_: None)  # a killed process does not tidy up
    if at == "create":
        monkeypatch.setattr(versions, "_write", die)
    if at == "rename":
        monkeypatch.setattr(versions, "_write", lambda stream, text: (real_put(stream, text), die()))
    write = die if at == "write" else lambda folder: sea(frame, -7.0).write.parquet(folder)
    with pytest.raises(Killed):
        versions.replace(spark, path, write)
    assert depths(spark, path) == ([-7.0] if at == "after" else [-2.0, -1.0])
    monkeypatch.setattr(versions, "_create", real_create)
    monkeypatch.setattr(versions, "_write", real_put)
    monkeypatch.setattr(versions, "delete_folder", real_delete)
    rasters.load_tiles([sea(frame, -9.0)], path)
    assert depths(spark, path) == [-9.0]
    versions.expire(spark, path, keep_seconds=-60)
    assert depths(spark, path) == [-9.0] and len(list((tmp_path / "table" / "data").iterdir())) == 1


def test_readers_of_an_older_version_go_on(spark, frame, tmp_path):
    path = str(tmp_path / "table")
    rasters.load_tiles([sea(frame, -1.0)], path)
    old = versions.latest(spark, path)
    reading = rasters.read_bathymetry(spark, path)
    rasters.load_tiles([sea(frame, -2.0), sea(frame, -3.0)], path)
    assert [r.elevation_m for r in reading.collect()] == [-1.0]
    assert versions.read(spark, path, RAW_BATHYMETRY, old).count() == 1
    assert versions.expire(spark, path) == []
    assert versions.expire(spark, path, keep_seconds=-60) == old.parts[""]
    assert depths(spark, path) == [-3.0, -2.0]


def test_a_number_is_given_once(spark, tmp_path):
    root = str(tmp_path / "t")
    base = versions.latest(spark, root)
    assert base == (0, {}, {})
    won = [versions._try_commit(spark, root, base, {"p=1": [str(i)]}, {}) for i in range(4)]
    assert [w is not None for w in won] == [True, False, False, False]
    assert versions.latest(spark, root).parts == {"p=1": ["0"]}
    assert [p.name for p in (tmp_path / "t" / "versions").iterdir() if not p.name.startswith(".")] == ["000000000001.json"]


def test_commits_join_or_conflict_by_part(spark, tmp_path):
    root = str(tmp_path / "t")
    base = versions.commit(spark, root, versions.latest(spark, root), {"m=1": ["a"], "m=2": ["b"]})
    versions.commit(spark, root, base, {"m=1": ["c"]}, {"seen": 1})
    done = versions.commit(spark, root, base, {"m=2": ["d"], "m=3": ["e"]})
    assert done.parts == {"m=1": ["c"], "m=2": ["d"], "m=3": ["e"]} and done.notes == {"seen": 1}
    with pytest.raises(versions.Conflict, match="m=1"):
        versions.commit(spark, root, base, {"m=1": ["f"]})
    assert versions.add(spark, root, {"m=1": ["g"]}).parts["m=1"] == ["c", "g"]
    assert versions.commit(spark, root, versions.latest(spark, root), {"m=1": []}).parts.keys() == {"m=2", "m=3"}


def test_other_files_are_not_taken_over(spark, frame, tmp_path):
    path = str(tmp_path / "plain")
    sea(frame, -1.0).write.parquet(path)
    with pytest.raises(ValueError, match="holds other files"):
        rasters.load_tiles([sea(frame, -2.0)], path)
    assert depths(spark, path) == [-1.0]


def test_empty_tables_have_versions_too(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    rasters.load_tiles([sea(frame, -1.0)], path)
    rasters.load_tiles([sea(frame)], path)
    assert rasters.read_bathymetry(spark, path).count() == 0
    strips = str(tmp_path / "s")
    grid = RasterGrid(0.0, 10.0, 0.0, 10.0, 1.0)
    rasters.write_strips(frame([(0.5, 1.5, 1.0)], RAW_COASTLINE), strips, grid)
    rasters.write_strips(frame([], RAW_COASTLINE), strips, grid)
    assert rasters.read_strips(spark, strips).count() == 0
    points = str(tmp_path / "p")
    for n in (2, 1, 0):
        reference_data.write_grid_points(frame([(f"K{i}", 1.0, 2.0, -3.0, "a") for i in range(n)], GRID_POINTS), points)
        assert reference_data.read_registry(spark, points).count() == n


def wave(site, time, height):
    return (site, 43.0, 4.0, time and dt.datetime.fromisoformat(time), height, 1.0, 5.0)


def stored(spark, path):
    rows = timeseries.read_hourly(spark, path, WAVE_VARS).collect()
    return sorted((r.location_name, str(r.observation_time), r.wave_height) for r in rows)


def test_interleaved_merges_lose_no_row(spark, frame, tmp_path, monkeypatch):
    """The second merge reads, then the first commits, then the second commits."""
    path = str(tmp_path / "t")
    timeseries.merge_hourly(frame([wave("a", "2023-01-01T00:00:00", 1.0)], RAW_WAVE), path)
    real, between = versions.commit, []

    def commit(*args):
        if not between:
            between.append(True)
            timeseries.merge_hourly(
                frame([wave("b", "2023-01-01T05:00:00", 2.0), wave("a", "2023-01-01T00:00:00", 8.0)], RAW_WAVE), path
            )
        return real(*args)

    monkeypatch.setattr(versions, "commit", commit)
    timeseries.merge_hourly(frame([wave("c", "2023-01-02T00:00:00", 3.0), wave("c", "2023-02-02T00:00:00", 4.0)], RAW_WAVE), path)
    assert stored(spark, path) == [
        ("a", "2023-01-01 00:00:00", 8.0),
        ("b", "2023-01-01 05:00:00", 2.0),
        ("c", "2023-01-02 00:00:00", 3.0),
        ("c", "2023-02-02 00:00:00", 4.0),
    ]


def test_merges_and_appends_at_once(spark, frame, tmp_path):
    path, failed = str(tmp_path / "t"), []

    def load(k):
        try:
            rows = [wave(f"s{k}", f"2023-0{m}-01T0{k}:00:00", float(k)) for m in (1, 2)]
            (timeseries.append_hourly if k == 4 else timeseries.merge_hourly)(frame(rows, RAW_WAVE), path)
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    threads = [threading.Thread(target=load, args=(k,)) for k in range(5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and len(stored(spark, path)) == 10


def test_writers_that_never_win_say_so(spark, frame, tmp_path, monkeypatch):
    def lose(*_):
        raise versions.Conflict("lost")

    monkeypatch.setattr(versions, "commit", lose)
    monkeypatch.setattr(timeseries, "MERGE_TRIES", 2)
    with pytest.raises(versions.Conflict, match="lost"):
        timeseries.merge_hourly(frame([wave("a", "2023-01-01T00:00:00", 1.0)], RAW_WAVE), str(tmp_path / "t"))


@pytest.mark.parametrize("load", [timeseries.append_hourly, timeseries.merge_hourly])
def test_counts_come_from_the_write(spark, frame, tmp_path, load):
    """Each row of the source is produced once, counts, guard and NULLs included."""
    made = spark.sparkContext.accumulator(0)
    rows = [wave("a", "2023-01-01T00:00:00", 1.0), wave("a", None, None), wave("b", "2023-03-01T00:00:00", None)]

    def produce(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    source = frame(rows, RAW_WAVE).mapInArrow(produce, RAW_WAVE)
    day = dt.date.fromisoformat
    report = load(source, str(tmp_path / "t"), timeseries.Request("b", day("2023-03-01"), day("2023-03-01")))
    assert made.value == 3
    assert (report.rows, report.requested) == (3, 1)
    assert (str(report.first), str(report.last)) == ("2023-01-01 00:00:00", "2023-03-01 00:00:00")
    assert {c: n for c, n in report.nulls.items() if n} == {"observation_time": 1, "wave_height": 2}


def test_a_request_without_rows_adds_nothing(spark, frame, tmp_path):
    path, day = str(tmp_path / "t"), dt.date.fromisoformat
    timeseries.merge_hourly(frame([wave("a", "2023-01-01T00:00:00", 1.0)], RAW_WAVE), path)
    batch = frame([wave("a", "2023-01-05T00:00:00", 2.0)], RAW_WAVE)
    for load in (timeseries.append_hourly, timeseries.merge_hourly):
        with pytest.raises(timeseries.EmptyLoad, match=r"No rows loaded for a \(2023-01-02..2023-01-04\): 0"):
            load(batch, path, timeseries.Request("a", day("2023-01-02"), day("2023-01-04")))
    assert len(stored(spark, path)) == 1
    report = timeseries.merge_hourly(frame([], RAW_WAVE), path)
    assert (report.rows, report.first, len(stored(spark, path))) == (0, None, 1)


def test_long_requests_are_two_lookups(spark, frame):
    series = frame([wave("a", f"20{y:02d}-06-{d:02d}T00:00:00", 1.0) for y in range(5, 24) for d in (1, 2, 2)], RAW_WAVE)
    day = dt.date.fromisoformat
    spans = [("2005-01-01", "2023-12-31"), ("2010-06-02", "2012-06-01"), ("2010-06-02", "2010-06-02"), ("2024-01-01", "2024-12-31"), ("2012-01-01", "2011-01-01")]
    asked = frame(
        [(s, day(a), day(b)) for s in ("a", "z") for a, b in spans] + [("a", None, None), (None, *map(day, spans[0]))] + [("a", *map(day, spans[0]))],
        "location_name string, start_date date, end_date date",
    )
    counted = timeseries.loaded_rows(asked, series.unionByName(frame([wave("a", None, 1.0)], RAW_WAVE)))
    got = sorted(r.row_count for r in counted.where("location_name = 'a'").collect())
    assert got == [0, 0, 0, 2, 2 + 3 + 1, 57, 57]
    assert counted.where("location_name IS NULL OR location_name = 'z'").agg(F.sum("row_count")).first()[0] == 0
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "sequence" not in plan
