import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pelagrid.config import Area, RasterGrid
from pelagrid.operators import gridpoints, staging
from pelagrid.schemas import RAW_BATHYMETRY, RAW_COASTLINE, RAW_WAVE, RAW_WIND, WAVE_VARS, WIND_VARS
from pelagrid.sources import hourly, rasters, reference_data, timeseries, worklist
from pelagrid.streaming.landing import load_new_files

SITE = "GULF_OF_LION_43.0_4.0"
PERIOD = (dt.date(2023, 1, 1), dt.date(2023, 1, 31))


def response(**changes):
    doc = {
        "time": ["2023-01-01T00:00", "2023-01-01T01:00", "2023-01-01T02:00"],
        "wind_speed_100m": [36.0, None, float("nan")],
        "wind_direction_100m": [10, "x", "20.5"],
        "wind_speed_10m": [1.0, 2.0, 3.0],
    } | changes
    return json.dumps({"latitude": 43.02, "longitude": 4.01, "hourly": doc}, indent=1)


@pytest.fixture
def landed(tmp_path):
    def write(**changes):
        folder = tmp_path / "responses" / f"location_name={SITE}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "2023-01-01_2023-12-31.json").write_text(response(**changes))
        return str(tmp_path / "responses")

    return write


def test_explode_response_files(spark, landed):
    df = hourly.explode_hourly(hourly.read_responses(spark, landed(), WIND_VARS), WIND_VARS)
    rows = df.orderBy("observation_time").collect()
    assert df.columns == RAW_WIND.fieldNames()
    assert [r.observation_time for r in rows] == [dt.datetime(2023, 1, 1, h) for h in range(3)]
    assert [r.wind_speed_100m for r in rows] == [36.0, None, None]
    assert [r.wind_direction_100m for r in rows] == [10.0, None, 20.5]
    assert {(r.location_name, r.latitude, r.longitude) for r in rows} == {(SITE, 43.02, 4.01)}


@pytest.mark.parametrize("bad", [[1.0, 2.0], None])
def test_short_or_missing_array_fails(spark, landed, bad):
    df = hourly.explode_hourly(
        hourly.read_responses(spark, landed(wind_speed_10m=bad), WIND_VARS), WIND_VARS
    )
    with pytest.raises(Exception, match="wind_speed_10m has fewer values"):
        df.collect()


def test_longer_array_is_cut_to_the_timestamps(spark, landed):
    path = landed(wind_speed_10m=[1.0, 2.0, 3.0, 4.0])
    df = hourly.explode_hourly(hourly.read_responses(spark, path, WIND_VARS), WIND_VARS)
    assert df.count() == 3


def waves(frame, *rows):
    stamp = dt.datetime.fromisoformat
    return frame([(s, 43.0, 4.0, stamp(t), h, 1.0, 5.0) for s, t, h in rows], RAW_WAVE)


def test_landing_files_round_trip(spark, frame, tmp_path):
    root = str(tmp_path / "landing")
    df = waves(frame, ("a", "2023-01-01T00:00:00", 1.5), ("b b", "2023-01-31T23:00:00.250000", None))
    hourly.write_landing(df, root, *PERIOD)
    assert sorted(p.name for p in (tmp_path / "landing").glob("location_name=*")) == [
        "location_name=a",
        "location_name=b b",
    ]
    back = hourly.read_landing(spark, root, WAVE_VARS)
    assert sorted(back.collect()) == sorted(df.collect())


def test_malformed_landing_line_fails(spark, tmp_path):
    folder = tmp_path / "l" / "location_name=a"
    folder.mkdir(parents=True)
    (folder / "x.json").write_text('{"latitude": 1.0\n')
    with pytest.raises(Exception):
        hourly.read_landing(spark, str(tmp_path / "l"), WAVE_VARS).collect()


def test_merge_is_idempotent_and_append_is_not(spark, frame, tmp_path):
    merged, appended = str(tmp_path / "m"), str(tmp_path / "a")
    first = waves(frame, ("a", "2023-01-01T00:00:00", 1.0), ("a", "2023-02-01T00:00:00", 2.0))
    second = waves(
        frame,
        ("a", "2023-02-01T00:00:00", 9.0),
        ("b", "2023-02-01T00:00:00", 4.0),
        ("b", "2023-03-01T00:00:00", 5.0),
    )
    for batch in (first, second, second):
        timeseries.merge_hourly(batch, merged)
        timeseries.append_hourly(batch, appended)
    got = timeseries.read_hourly(spark, merged, WAVE_VARS).collect()
    assert sorted((r.location_name, r.obs_month, r.wave_height) for r in got) == [
        ("a", "2023-01", 1.0),
        ("a", "2023-02", 9.0),
        ("b", "2023-02", 4.0),
        ("b", "2023-03", 5.0),
    ]
    assert timeseries.read_hourly(spark, appended, WAVE_VARS).count() == 8


def test_year_filter_prunes_months(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    timeseries.append_hourly(
        waves(frame, ("a", "2022-12-31T23:00:00", 1.0), ("a", "2023-01-01T00:00:00", 2.0), ("z", "2023-05-01T00:00:00", 3.0)),
        path,
    )
    df = staging.smoke_subset(timeseries.read_hourly(spark, path, WAVE_VARS), ("a",), 2023)
    assert [r.wave_height for r in df.collect()] == [2.0]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(obs_month" in plan
    assert "EqualTo(location_name,a), GreaterThanOrEq" in plan


def test_incremental_load_reads_each_file_once(spark, frame, tmp_path):
    root, table, marks = (str(tmp_path / n) for n in ("landing", "table", "marks"))
    load = lambda: load_new_files(spark, root, table, WAVE_VARS, marks)
    hourly.write_landing(waves(frame, ("a", "2023-01-01T00:00:00", 1.0)), root, *PERIOD)
    load()
    hourly.write_landing(waves(frame, ("a", "2023-01-01T00:00:00", 7.0), ("b", "2023-01-02T00:00:00", 2.0)), root, *PERIOD)
    load()
    load()
    got = timeseries.read_hourly(spark, table, WAVE_VARS).collect()
    assert sorted((r.location_name, r.wave_height) for r in got) == [("a", 7.0), ("b", 2.0)]


def test_truncate_only_existing_tables(spark, frame):
    waves(frame, ("a", "2023-01-01T00:00:00", 1.0)).write.mode("overwrite").saveAsTable("raw_wave_t")
    assert timeseries.truncate_tables(spark, "raw_wave_t", "raw_none_t") == ["raw_wave_t"]
    assert spark.table("raw_wave_t").count() == 0
    spark.sql("DROP TABLE raw_wave_t")


def test_backfill_and_load_guard(spark, frame):
    sites = frame([("a",), ("b",)], "location_name string")
    requests = worklist.backfill_requests(sites, 2022, 2023)
    stored = waves(frame, ("a", "2022-12-31T23:59:59", 1.0), ("a", "2022-01-01T00:00:00", None), ("b", "2023-06-01T00:00:00", 1.0))
    missing = {(r.location_name, r.year) for r in worklist.missing_requests(requests, stored).collect()}
    assert missing == {("a", 2023), ("b", 2022)}
    counted = timeseries.loaded_rows(requests, stored).collect()
    assert {(r.location_name, r.start_date.year): r.row_count for r in counted} == {
        ("a", 2022): 2,
        ("a", 2023): 0,
        ("b", 2022): 0,
        ("b", 2023): 1,
    }
    with pytest.raises(timeseries.EmptyLoad, match=r"No rows loaded for a \(2023-01-01..2023-12-31\): 0, b"):
        timeseries.require_loaded(requests, stored)
    timeseries.require_loaded(requests.where("location_name = 'a' AND year = 2022"), stored)
    assert worklist.backfill_requests(sites).count() == 2 * 19


def test_bathymetry_tiles(spark, frame, tmp_path):
    pixels = frame(
        [(40.0, 3.0, -5.0), (40.0, 16.0, -6.0), (40.0, 3.1, 0.0), (29.9, 3.0, -1.0), (46.0, 37.0, -2.0)],
        "lat double, lon double, z double",
    )
    clipped = rasters.clip_marine(pixels)
    assert clipped.schema.fieldNames() == RAW_BATHYMETRY.fieldNames()
    tiles, table = str(tmp_path / "tiles"), str(tmp_path / "table")
    rasters.write_tiles(clipped, tiles)
    rasters.write_tiles(clipped.where("longitude > 15"), tiles)
    back = rasters.read_bathymetry(spark, tiles).select(*RAW_BATHYMETRY.fieldNames())
    assert sorted(back.collect()) == sorted(clipped.collect())
    for _ in range(2):
        rasters.load_tiles([back.where("longitude < 15"), back.where("longitude >= 15")], table)
    assert rasters.read_bathymetry(spark, table).count() == 3


def test_strips(spark, frame, tmp_path):
    grid = RasterGrid(0.0, 10.0, 0.0, 10.0, 1.0)
    df = frame([(r + 0.5, 1.5, float(r)) for r in range(10)], RAW_COASTLINE)
    root = tmp_path / "strips"
    rasters.write_strips(df, str(root), grid, strip_rows=4)
    assert sorted(p.name for p in root.glob("data/*/strip=*")) == ["strip=00000", "strip=00004", "strip=00008"]
    back = rasters.read_strips(spark, str(root)).select(*RAW_COASTLINE.fieldNames())
    assert sorted(back.collect()) == sorted(df.collect())


def test_reference_inputs(spark, tmp_path):
    seed = reference_data.default_exclusions(spark)
    assert sorted(r.site_name for r in seed.collect()) == ["GULF_OF_LION_42.25_3.25", "GULF_OF_LION_42.5_3.0"]
    from_file = reference_data.read_exclusions(spark, str(reference_data.SEED))
    assert sorted(from_file.collect()) == sorted(seed.collect())
    box = (0.0, 1.0, 0.0, 1.0)
    on, off = Area("a", *box), Area("b", *box, active=False)
    assert [r["name"] for r in reference_data.active_areas(spark, [on, off]).collect()] == ["a"]
    assert reference_data.active_areas(spark).count() == 1
    reference_data.active_areas(spark).write.json(str(tmp_path / "areas"))
    assert reference_data.read_areas(spark, str(tmp_path / "areas")).collect() == reference_data.active_areas(spark).collect()


def test_grid_points_and_registry(spark, frame, tmp_path):
    areas = reference_data.active_areas(
        spark,
        [
            Area("west", -1.0, 1.0, -1.0, 1.0, 0.25, 0.0, -100.0),
            Area("wide", -2.0, 2.0, -2.0, 2.0, 1.0, 0.0, -50.0),
        ],
    )
    sea = frame(
        [
            (0.2, 0.2, -10.0),
            (0.3, 0.3, -20.0),
            (1.0, 1.0, -30.0),
            (-1.6, -0.4, -40.0),
            (0.2, 0.2, -60.0),
            (0.2, 0.2, 3.0),
            (0.5, 0.5, -200.0),
        ],
        RAW_BATHYMETRY,
    )
    points = gridpoints.grid_points(sea, areas)
    assert {(r.key, r.avg_depth) for r in points.collect()} == {
        ("WEST_0.25_0.25", -30.0),
        ("WEST_1.0_1.0", -30.0),
        ("WIDE_0.0_0.0", -15.0),
        ("WIDE_1.0_1.0", -30.0),
        ("WIDE_-2.0_0.0", -40.0),
    }
    reference_data.write_grid_points(points, str(tmp_path / "points"))
    registry = reference_data.read_registry(spark, str(tmp_path / "points"))
    assert {r.location_name for r in registry.collect()} == {r.key for r in points.collect()}
    assert registry.columns == ["location_name", "latitude", "longitude"]


def test_staging_keys(frame):
    df = staging.stg_wave(waves(frame, ("a", "2023-01-01T00:00:00", 1.0), ("a", "2023-01-01T00:00:00.5", 1.0)))
    keys = [r.record_id for r in df.collect()]
    assert len(set(keys)) == 2
    stamp = df.select(F.md5(F.lit("a-2023-01-01 00:00:00+00")).alias("k")).first().k
    assert stamp in keys
    row = df.first()
    assert (row.snap_lat, row.snap_lon, row.year, row.month) == (43.125, 4.125, 2023, 1)


def test_merge_keeps_rows_without_a_key_and_is_deterministic(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    schema = RAW_WAVE
    row = lambda s, t, h: (s, 43.0, 4.0, t and dt.datetime.fromisoformat(t), h, 1.0, 5.0)
    first = frame([row("a", None, 1.0), row("a", None, 2.0), row("a", None, 2.0), row(None, "2023-01-01T00:00:00", 3.0)], schema)
    same = frame([row("x", "2023-05-01T00:00:00", float(h)) for h in range(50)], schema)
    for batch in (first, frame([row("b", None, 4.0)], schema), first, same.repartition(7)):
        timeseries.merge_hourly(batch, path)
    got = timeseries.read_hourly(spark, path, WAVE_VARS).collect()
    assert sorted((str(r.location_name), r.wave_height) for r in got) == [
        ("None", 3.0), ("a", 1.0), ("a", 2.0), ("b", 4.0), ("x", 49.0),
    ]


def test_landing_again_replaces_the_period_only(spark, frame, tmp_path):
    root, february = str(tmp_path / "landing"), (dt.date(2023, 2, 1), dt.date(2023, 2, 28))
    one = waves(frame, ("a", "2023-01-01T00:00:00", 1.0), ("a", "2023-01-02T00:00:00", 5.0), ("b", "2023-01-01T00:00:00", 2.0))
    hourly.write_landing(one, root, *PERIOD)
    hourly.write_landing(waves(frame, ("a", "2023-02-01T00:00:00", 3.0)), root, *february)
    heights = lambda: sorted((r.location_name, r.wave_height) for r in hourly.read_landing(spark, root, WAVE_VARS).collect())
    assert heights() == [("a", 1.0), ("a", 3.0), ("a", 5.0), ("b", 2.0)]
    # A shorter answer to the same request replaces the longer one.
    hourly.write_landing(waves(frame, ("a", "2023-01-02T00:00:00", 6.0)), root, *PERIOD)
    assert heights() == [("a", 3.0), ("a", 6.0), ("b", 2.0)]
    with pytest.raises(ValueError, match="no days"):
        hourly.write_landing(one, root, *PERIOD[::-1])


def test_keys_are_made_in_utc_only(spark, frame):
    rows = waves(frame, ("a", "2023-01-01T00:00:00", 1.0))
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(ValueError, match="UTC"):
            staging.stg_wave(rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_failed_load_leaves_the_old_table(spark, frame, tmp_path):
    table = str(tmp_path / "table")
    good = frame([(40.0, 3.0, -5.0)] * 10, RAW_BATHYMETRY)
    rasters.load_tiles([good], table)
    bad = good.withColumn("elevation_m", F.raise_error(F.lit("broken tile")).cast("double"))
    with pytest.raises(Exception, match="broken tile"):
        rasters.load_tiles([good, bad], table)
    assert rasters.read_bathymetry(spark, table).count() == 10
    assert [p.name for p in tmp_path.iterdir()] == ["table"]


def test_late_strips_have_names_of_their_own(spark, frame, tmp_path):
    grid = RasterGrid(0.0, 200_000.0, 0.0, 10.0, 1.0)
    df = frame([(float(r) + 0.5, 1.5, 1.0) for r in (12_340, 123_400, 123_401, 123_430)], RAW_COASTLINE)
    root = tmp_path / "strips"
    rasters.write_strips(df, str(root), grid, strip_rows=20)
    assert sorted(p.name for p in root.glob("data/*/strip=*")) == ["strip=12340", "strip=123400", "strip=123420"]


def test_pixels_without_a_place_meet_none(frame):
    nan, inf = float("nan"), float("inf")
    coast = frame([(nan, 1.0, 2.0), (0.0, 0.0, 2.0), (inf, 0.0, 2.0), (None, 0.0, 2.0)], RAW_COASTLINE)
    sea = frame([(0.0, 0.0, -1.0), (nan, 1.0, -1.0), (nan, nan, -1.0)], RAW_BATHYMETRY)
    assert [(r.latitude, r.longitude) for r in staging.stg_coastline_distance(coast, sea).collect()] == [(0.0, 0.0)]


def test_years_in_reverse_are_an_error(frame):
    with pytest.raises(ValueError, match="2025 to 2024"):
        worklist.backfill_requests(frame([("a",)], "location_name string"), 2025, 2024)


def test_other_session_zones_are_refused(spark, frame, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            timeseries.append_hourly(frame([], RAW_WAVE), str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_daily_requests_meet_days_of_their_month(spark, frame):
    stored = waves(frame, ("a", "2023-01-31T10:00:00", 1.0), ("a", "2023-02-01T10:00:00", 1.0))
    day = dt.date.fromisoformat
    requests = frame(
        [("a", day("2023-01-31"), day("2023-02-01")), ("a", day("2023-02-01"), day("2023-02-01")), ("a", day("2023-03-02"), day("2023-03-01"))],
        "location_name string, start_date date, end_date date",
    )
    counted = timeseries.loaded_rows(requests, stored)
    assert sorted(r.row_count for r in counted.collect()) == [0, 1, 2]
    assert "Generate" not in counted._jdf.queryExecution().optimizedPlan().toString()
