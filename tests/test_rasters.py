import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pelagrid.config import FULL_RASTER, REGIONAL_RASTER, RasterGrid
from pelagrid.operators import cells, raster, sites, staging
from pelagrid.operators.raster import _nearest_along_rows
from pelagrid.schemas import RAW_BATHYMETRY, RAW_COASTLINE
from pelagrid.sources import rasters


def test_grid_sizes():
    assert (FULL_RASTER.rows, FULL_RASTER.cols) == (3840, 10320)
    assert (REGIONAL_RASTER.rows, REGIONAL_RASTER.cols) == (720, 1080)
    lat_km = FULL_RASTER.res * 111.0
    assert FULL_RASTER.km_per_pixel == (lat_km + lat_km * math.cos(math.radians(38.0))) / 2


def test_vertices_truncate_toward_zero(frame):
    grid = RasterGrid(10.0, 12.0, 20.0, 22.0, 0.5)
    rows = [(20.1, 10.1), (20.2, 10.2), (21.9, 11.9), (22.0, 11.0), (19.8, 9.7), (19.4, 10.0)]
    got = raster.rasterise_vertices(frame(rows, "lon double, lat double"), grid).collect()
    assert sorted((r.row, r.col) for r in got) == [(0, 0), (3, 3)]


def brute(coast, rows, cols):
    y, x = np.mgrid[0:rows, 0:cols]
    return np.min([(y - r) ** 2 + (x - c) ** 2 for r, c in coast], axis=0)


def transformed(frame, coast, grid):
    df = raster.distance_transform(frame(coast, "row long, col long"), grid)
    got = np.full((grid.rows, grid.cols), -1)
    seen = df.collect()
    for r in seen:
        got[r.row, r.col] = r.squared
    assert len(seen) == grid.rows * grid.cols
    return got


@pytest.mark.parametrize("seed", range(4))
def test_distance_transform_equals_brute_force(frame, seed, monkeypatch):
    monkeypatch.setattr(raster, "STRIP_PIXELS", 96)
    rng = random.Random(seed)
    grid = RasterGrid(0.0, 32.0, 0.0, 32.0 + seed, 1.0)
    coast = sorted(
        {(rng.randrange(grid.rows), rng.randrange(grid.cols)) for _ in range(1 + 9 * seed)}
    )
    assert (transformed(frame, coast, grid) == brute(coast, grid.rows, grid.cols)).all()


def test_distance_transform_shapes(frame):
    grid = RasterGrid(0.0, 9.0, 0.0, 7.0, 1.0)
    for coast in (
        [(4, 3)],
        [(0, c) for c in range(7)],
        [(r, 6) for r in range(9)],
        [(r, c) for r in range(9) for c in range(7)],
    ):
        assert (transformed(frame, coast, grid) == brute(coast, 9, 7)).all()
    empty = frame([], "row long, col long")
    assert raster.distance_transform(empty, grid).count() == 0


@pytest.mark.parametrize("width", [1, 2, 3, 5, 8, 17, 100])
def test_row_search(width):
    rng = np.random.default_rng(width)
    cols = np.sort(rng.choice(width, size=max(1, width // 3), replace=False))
    gap = rng.integers(0, 40, size=(6, cols.size))
    x = np.arange(width)
    want = ((x[None, :, None] - cols) ** 2 + gap[:, None, :] ** 2).min(axis=2)
    assert (_nearest_along_rows(cols, gap, width) == want).all()


def test_coast_distances_drop_coast_and_scale(frame):
    grid = RasterGrid(41.0, 42.0, 2.0, 3.0, 0.25)
    got = raster.coast_distances(frame([(2.1, 41.1)], "lon double, lat double"), grid).collect()
    assert len(got) == 15
    nearest = min(got, key=lambda r: r.distance_to_coast_km)
    assert nearest.distance_to_coast_km == pytest.approx(grid.km_per_pixel)
    assert {(r.latitude, r.longitude) for r in got} == {
        (41.125 + 0.25 * i, 2.125 + 0.25 * j) for i in range(4) for j in range(4)
    } - {(41.125, 2.125)}


def test_pixel_grid(spark):
    grid = RasterGrid(0.0, 3.0, 10.0, 12.0, 1.0)
    got = sorted(tuple(r) for r in raster.pixel_grid(spark, grid).collect())
    assert got == [(r, c, r + 0.5, c + 10.5) for r in range(3) for c in range(2)]


# Pixels that repeat, that straddle a cell border under the same rounded key, and
# that have no partner.
BATHY = [
    (42.10, 3.10, -20.0),
    (42.10, 3.10, -22.0),
    (42.15, 3.10, -40.0),
    (42.15, 3.15, 5.0),
    (42.2501, 3.10, -60.0),
    (42.2499, 3.2501, -80.0),
    (43.10, 4.10, -90.0),
]
COAST = [
    (42.10, 3.10, 3.0),
    (42.10, 3.10, 5.0),
    (42.15, 3.10, 1.0),
    (42.15, 3.15, 9.0),
    (42.2499, 3.10, 12.0),
    (42.2501, 3.2499, 40.0),
    (44.10, 4.10, 80.0),
]


def test_cell_statistics_equal_the_pixel_join(frame):
    bathymetry, coastline = frame(BATHY, RAW_BATHYMETRY), frame(COAST, RAW_COASTLINE)
    staged = staging.stg_coastline_distance(coastline, bathymetry)
    # 2 x 2 for the repeated pixel, one each across the two borders.
    assert staged.count() == 6
    want = {
        r.spatial_id: (r.avg, r.min, r.n)
        for r in staged.groupBy("spatial_id")
        .agg(
            F.avg("distance_to_coast_km").alias("avg"),
            F.min("distance_to_coast_km").alias("min"),
            F.count("*").alias("n"),
        )
        .collect()
    }
    got = {
        r.spatial_id: (r.distance_to_coast_km, r.distance_min_km, r.coast_pixels)
        for r in cells.cell_coast_distances(coastline, bathymetry).collect()
    }
    assert got == want and len(got) == 2


def test_pixels_meet_wherever_they_lie(frame):
    """Coordinates have no bounds; halves go away from zero; no coordinate and NaN equal nothing."""
    inf, nan = float("inf"), float("nan")
    places = [
        (720.1, 3.1), (-721.25, 3.1), (41.0, 2238.265625), (41.0, -90000.5), (123456.789, -123456.789),
        (1e9 + 0.25, 3.1), (2.0**43, 3.1), (2.0**43 + 2.0**-9, 3.1), (1e16, 3.1), (-1e18, 1e17), (1e300, 3.1), (1e306, 3.1), (inf, 3.1), (-inf, inf),
    ]
    none = [(nan, 3.1), (3.1, nan), (None, 3.1), (3.1, None), (nan, nan), (None, None)]
    apart = [(-0.0001, 0.0), (0.0004, -0.0004), (721.0006, -0.0005)], [(0.0, -0.0), (721.001, -0.001)]
    coastline = frame([(*p, 20.0 + i) for i, p in enumerate(places + none + apart[0])], RAW_COASTLINE)
    bathymetry = frame([(*p, -5.0) for p in places + none + apart[1]], RAW_BATHYMETRY)
    staged = staging.stg_coastline_distance(coastline, bathymetry)
    got = sorted((r.latitude, r.longitude) for r in staged.collect())
    assert got == sorted(places + apart[0])
    want = {r.spatial_id: (r["sum"], r.low, r.n) for r in staged.groupBy("spatial_id").agg(
        F.sum("distance_to_coast_km").alias("sum"), F.min("distance_to_coast_km").alias("low"), F.count("*").alias("n")).collect()}
    cellwise = {r.spatial_id: (pytest.approx(r.distance_to_coast_km * r.coast_pixels), r.distance_min_km, r.coast_pixels)
                for r in cells.cell_coast_distances(coastline, bathymetry).collect()}
    assert cellwise == want


def test_sample_equals_fan_out(frame):
    bathymetry, coastline = frame(BATHY, RAW_BATHYMETRY), frame(COAST, RAW_COASTLINE)
    depth, coast = cells.cell_depths(bathymetry), cells.cell_coast_distances(coastline, bathymetry)
    names = ["GULF_OF_LION_42.0_3.0", "GULF_OF_LION_43.0_4.0", "GULF_OF_LION_42.5_3.0", "X_1_2"]
    located = sites.locate_sites(frame([(n, n) for n in names], "site_name string, site_id string"))
    assert located.count() == 3
    centres = sites.keep_marine(located, depth)
    assert {r.site_name for r in centres.collect()} == set(names[:2])

    got = {r.site_name: r for r in sites.sample_cells(located, depth, coast).collect()}
    fan = (
        located.join(staging.stg_bathymetry(bathymetry).withColumnRenamed("depth_m", "d"), "spatial_id", "left")
        .join(staging.stg_coastline_distance(coastline, bathymetry), "spatial_id", "left")
        .groupBy("site_name")
        .agg(F.avg("d").alias("d"), F.avg("distance_to_coast_km").alias("km"), F.count("elevation_m").alias("n"))
        .collect()
    )
    for row in fan:
        mine = got[row.site_name]
        assert (mine.sample_count, mine.depth_m) == (row.n, pytest.approx(row.d) if row.d else None)
        assert mine.distance_to_coast_km == (pytest.approx(row.km) if row.km else None)
    nothing = got["GULF_OF_LION_42.5_3.0"]
    assert (nothing.sample_count, nothing.marine_coverage_pct, nothing.distance_category) == (0, None, "offshore")
    inner = sites.sample_cells(located, depth, coast, marine_only=True)
    assert {r.site_name for r in inner.collect()} == set(names[:2])
    covered = sites.keep_covered(sites.sample_cells(located, depth, coast))
    assert {r.site_name for r in covered.collect()} == set(names[:2])


def test_one_hot_pixel_is_split_between_tasks(spark):
    """A pixel key with most rows: adaptive execution splits it, no row is lost."""
    hot = spark.range(200_000).select(
        F.when(F.col("id") % 4 > 0, 42.1).otherwise(F.col("id") / 1000.0).alias("latitude"),
        F.lit(3.1).alias("longitude"),
        (F.lit(30.0) + F.rand(7)).alias("distance_to_coast_km"),
    )
    sea = spark.range(200_000).select(
        (F.col("id") / 1000.0).alias("latitude"), F.lit(3.1).alias("longitude"), F.lit(-5.0).alias("elevation_m")
    )
    tuned = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k, None) for k in tuned}
    try:
        for k, v in tuned.items():
            spark.conf.set(k, v)
        joined = staging.stg_coastline_distance(hot, sea).select("latitude", "distance_to_coast_km")
        assert len(joined.collect()) == 200_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def scan_metric(df, name):
    df.collect()
    (scan,) = [p for p in iterate(df._jdf.queryExecution().executedPlan().collectLeaves())]
    return scan.metrics().get(name).get().value()


def iterate(seq):
    return [seq.apply(i) for i in range(seq.size())]


def test_curve_places_are_z_order(spark):
    df = spark.sql("SELECT x.id / 4D - 180 + 0.1D AS lat, y.id / 4D - 180 + 0.1D AS lon, x.id AS r, y.id AS c FROM range(1440) x JOIN range(40) y ON pmod(x.id * 7 + y.id, 50) = 0")
    for r in df.withColumn("p", rasters.curve_place(F.col("lat"), F.col("lon"))).collect():
        assert r.p == sum((r.r >> k & 1) << (2 * k + 1) | (r.c >> k & 1) << (2 * k) for k in range(11))


def test_few_cells_open_few_files_and_read_few_rows(spark, tmp_path):
    path = str(tmp_path / "curve")
    pixels = spark.range(256 * 256).selectExpr("40 + (id div 256) / 32D AS latitude", "2 + pmod(id, 256) / 32D AS longitude", "-cast(id AS double) AS elevation_m")
    odd = spark.createDataFrame([(None, 1.0, -1.0), (-33.9, -70.1, -2.0)], RAW_BATHYMETRY)
    everything = pixels.unionByName(odd)
    rasters.write_curve(everything, path, block_bits=4)
    assert sorted(map(str, rasters.read_curve(spark, path, RAW_BATHYMETRY).collect())) == sorted(map(str, everything.collect()))
    total = len(list((tmp_path / "curve").rglob("*.parquet")))
    sites = [(41.3, 3.0), (41.8, 3.9), (46.9, 9.1)]
    few = rasters.read_curve(spark, path, RAW_BATHYMETRY, sites)
    assert scan_metric(few, "numFiles") <= total / 8
    assert scan_metric(few, "numOutputRows") <= 256 * 256 / 16
    cells = {(la // 0.25, lo // 0.25) for la, lo in sites}
    want = [r for r in pixels.collect() if (r.latitude // 0.25, r.longitude // 0.25) in cells]
    assert sorted(few.collect()) == sorted(want) and len(want) == 3 * 64
    rasters.write_curve(odd, path)
    assert rasters.read_curve(spark, path, RAW_BATHYMETRY).count() == 2
    assert rasters.read_curve(spark, path, RAW_BATHYMETRY, [(-33.9, -70.1)]).count() == 1
    assert rasters.read_curve(spark, path, RAW_BATHYMETRY, []).count() == 0
