"""A run at the published volume: 18.5M rows per series and the full raster.

The provided tables are copied up to that volume by Spark (``events`` for the two
series, ``orders`` for elevations, ``customer`` for coastline vertices), written
as Parquet below a scratch folder, and then loaded, transformed and ranked. Prints
one JSON line. Usage: ``python bench_volume.py [tables_dir] [scratch_dir]``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import functions as F

from pelagrid.config import FULL_RASTER
from pelagrid.operators import cells, raster, staging
from pelagrid.plans.pipeline import Pipeline, RawTables
from pelagrid.session import get_session
from pelagrid.sources import demo, rasters, timeseries
from pelagrid.schemas import WAVE_VARS, WIND_VARS

COPIES = 185
SITES = 111
VERTEX_COPIES = 4


def copied(df, copies):
    # The provided tables are one small file each: spread them before copying.
    return df.repartition(64).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def series(df):
    """Copies spread over sites on the raster and over months of other years."""
    site = F.pmod(F.col("event_id") * 7 + F.col("_copy"), F.lit(SITES))
    lat = F.lit(40.5) + F.lit(0.25) * F.floor(site / 14)
    lon = F.lit(2.5) + F.lit(0.25) * F.pmod(site, F.lit(14))
    time_ = F.col("observation_time") - F.make_interval(months=F.pmod(F.col("_copy"), F.lit(228)))
    return copied(df, COPIES).withColumns(
        {
            "latitude": lat,
            "longitude": lon,
            "location_name": F.concat_ws("_", F.lit("GULF_OF_LION"), lat.cast("string"), lon.cast("string")),
            "observation_time": time_,
        }
    ).drop("event_id", "_copy")


def main() -> None:
    tables = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    root = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="pelagrid-volume-")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "volume",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions="32",
        spark__ui__enabled="false",
        spark__driver__memory="20g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    grid, times = FULL_RASTER, {}

    def timed(label, action):
        start = time.perf_counter()
        result = action()
        times[label] = round(time.perf_counter() - start, 2)
        print(label, times[label], file=sys.stderr, flush=True)
        return result

    paths = {n: f"{root}/{n}" for n in ("wind", "wave", "bathymetry", "coastline")}
    timed("load_wind", lambda: timeseries.append_hourly(series(demo.raw_wind(spark, tables, "event_id")), paths["wind"]))
    timed("load_wave", lambda: timeseries.append_hourly(series(demo.raw_wave(spark, tables, "event_id")), paths["wave"]))

    orders = demo.table(spark, tables, "orders")
    keys = orders.count()
    pixels = (
        raster.pixel_grid(spark, grid)
        .withColumn("o_orderkey", F.pmod(F.col("row") * grid.cols + F.col("col"), F.lit(keys)))
        .join(orders, "o_orderkey")
        .select(
            F.col("latitude").alias("lat"),
            F.col("longitude").alias("lon"),
            (F.col("o_totalprice") % 300.0 - 250.0 - F.col("col") % 400).alias("z"),
        )
    )
    timed("load_bathymetry", lambda: rasters.write_tiles(rasters.clip_marine(pixels, grid), paths["bathymetry"]))

    key = F.col("c_custkey") * VERTEX_COPIES + F.col("_copy")
    vertices = copied(demo.table(spark, tables, "customer"), VERTEX_COPIES).select(
        (F.lit(grid.lon_min) + F.pmod(key * 104729, F.lit(grid.cols)) * F.lit(grid.res)).alias("lon"),
        (F.lit(grid.lat_min) + F.pmod(key * 7919, F.lit(grid.rows)) * F.lit(grid.res)).alias("lat"),
    )
    timed(
        "load_coast_distance",
        lambda: rasters.write_strips(raster.coast_distances(vertices, grid), paths["coastline"], grid),
    )

    raw = RawTables(
        timeseries.read_hourly(spark, paths["wind"], WIND_VARS),
        timeseries.read_hourly(spark, paths["wave"], WAVE_VARS),
        rasters.read_bathymetry(spark, paths["bathymetry"]),
        rasters.read_strips(spark, paths["coastline"]),
        demo.exclusions(spark),
    )
    rows = {
        "wind": raw.wind.count(),
        "wave": raw.wave.count(),
        "bathymetry": raw.bathymetry.count(),
        "coastline": raw.coastline.count(),
    }

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    p = Pipeline(raw)
    timed("wind_summary", lambda: drain(p.wind_summary()))
    timed("wave_summary", lambda: drain(p.wave_summary()))
    timed("depth_cells", lambda: drain(p.depth_cells()))
    timed("coast_cells", lambda: drain(p.coast_cells()))
    timed("stg_coastline_distance", lambda: drain(p.model("stg_coastline_distance")))
    timed("mart_prioritization", lambda: drain(p.model("mart_prioritization")))
    if os.environ.get("BENCH_FAN_OUT"):
        coast = staging.stg_coastline_distance(raw.coastline, raw.bathymetry)
        timed("cells_fan_out_join", lambda: drain(cells.cell_depths_by_fan_out(raw.bathymetry, coast)))
    spark.stop()
    print(json.dumps({"metric": "volume_run", "unit": "sec", "rows": rows, "steps": times}))


if __name__ == "__main__":
    main()
