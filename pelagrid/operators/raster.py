"""Coastline rasterisation and an exact distance transform as Spark jobs.

The distance transform is separable. Pass 1 works down the columns that hold
coast cells: each coast cell owns the rows nearest to it, found with lag/lead
over the sparse coast cells alone. Pass 2 works along rows: the squared distance
of pixel x is the minimum over columns c of (x - c)^2 + g(c)^2, where g(c) is the
distance to the column's nearest coast cell. Rows are grouped in strips of a fixed
number of pixels: only coast cells are shuffled to them, never the dense raster,
and a task's memory depends on the configured strip, not on the raster.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pelagrid.config import RasterGrid

STRIP_PIXELS = 1 << 18
STRIPS_PER_TASK = 2


def pixel_index(coord: Column, origin: float, res: float) -> Column:
    """Pixel number along one axis, truncated toward zero."""
    return ((coord - F.lit(origin)) / F.lit(res)).cast("long")


def pixel_centre(index: Column, origin: float, res: float) -> Column:
    return F.lit(origin + res / 2) + index * F.lit(res)


def rasterise_vertices(vertices: DataFrame, grid: RasterGrid) -> DataFrame:
    """Distinct in-bounds (row, col) of coastline vertices given as (lon, lat)."""
    cells = vertices.select(
        pixel_index(F.col("lat"), grid.lat_min, grid.res).alias("row"),
        pixel_index(F.col("lon"), grid.lon_min, grid.res).alias("col"),
    )
    inside = F.col("row").between(0, grid.rows - 1) & F.col("col").between(0, grid.cols - 1)
    return cells.where(inside).distinct()


def pixel_grid(spark: SparkSession, grid: RasterGrid) -> DataFrame:
    """Every pixel with its centre; one range split by arithmetic, no join."""
    pixel = F.col("id")
    return spark.range(grid.rows * grid.cols).select(
        F.floor(pixel / grid.cols).alias("row"), F.pmod(pixel, F.lit(grid.cols)).alias("col")
    ).select(
        "row",
        "col",
        pixel_centre(F.col("row"), grid.lat_min, grid.res).alias("latitude"),
        pixel_centre(F.col("col"), grid.lon_min, grid.res).alias("longitude"),
    )


def column_owners(coast: DataFrame, rows: int, strip_rows: int) -> DataFrame:
    """(strip, col, coast_row): the coast cells that matter to each strip of a column.

    A coast cell is listed in every strip that holds a row it is nearest to within
    its column, so a strip can rebuild its distances from the few cells listed.
    """
    down = Window.partitionBy("col").orderBy("row")
    row, above, below = F.col("row"), F.lag("row").over(down), F.lead("row").over(down)
    first = F.coalesce(F.floor((above + row) / 2) + 1, F.lit(0))
    last = F.coalesce(F.floor((row + below) / 2), F.lit(rows - 1))
    owned = coast.select(
        "col",
        row.alias("coast_row"),
        F.floor(first / strip_rows).alias("_from"),
        F.floor(last / strip_rows).alias("_to"),
        (first <= last).alias("_any"),
    )
    strips = F.explode(F.sequence("_from", "_to")).alias("strip")
    return owned.where("_any").select(strips, "col", "coast_row")


def _nearest_along_rows(cols: np.ndarray, gap: np.ndarray, width: int) -> np.ndarray:
    """min over source columns of (x - col)^2 + gap^2, for each strip row and x.

    The best source moves right as x does, so solving every second x bounds the
    search of those between; all rows of the strip advance together.
    """
    rows, sources = gap.shape
    cost = (gap.astype(np.int64) ** 2).ravel()
    best = np.zeros((rows, width), dtype=np.int64)
    out = np.empty((rows, width), dtype=np.int64)
    line = np.arange(rows)[:, None]
    step = 1 << max(width - 1, 1).bit_length()
    while step >= 1:
        x = np.arange(step - 1, width, 2 * step)
        if x.size:
            left, right = x - step, x + step
            low = np.where(left >= 0, best[:, np.maximum(left, 0)], 0)
            high = np.where(right < width, best[:, np.minimum(right, width - 1)], sources - 1)
            count = (high - low + 1).ravel()
            start = np.concatenate(([0], np.cumsum(count)[:-1]))
            source = np.arange(count.sum()) - np.repeat(start - low.ravel(), count)
            where = np.repeat(np.broadcast_to(line, low.shape).ravel(), count)
            target = np.repeat(np.broadcast_to(x, low.shape).ravel(), count)
            value = (target - cols[source]) ** 2 + cost[where * sources + source]
            least = np.minimum.reduceat(value, start)
            first = np.where(value == np.repeat(least, count), source, sources)
            best[:, x] = np.minimum.reduceat(first, start).reshape(low.shape)
            out[:, x] = least.reshape(low.shape)
        step >>= 1
    return out


def _strip_transform(
    grid_rows: int, width: int, strip_rows: int
) -> Callable[[tuple[pa.Scalar, ...], pa.Table], pa.Table]:
    def transform(key: tuple[pa.Scalar, ...], owners: pa.Table) -> pa.Table:
        top = key[0].as_py() * strip_rows
        rows = np.arange(top, min(top + strip_rows, grid_rows))
        col, coast = (owners.column(c).to_numpy() for c in ("col", "coast_row"))
        order = np.argsort(col, kind="stable")
        cols, start = np.unique(col[order], return_index=True)
        gap = np.minimum.reduceat(np.abs(rows[:, None] - coast[order]), start, axis=1)
        nearest = _nearest_along_rows(cols, gap, width)
        return pa.table(
            {
                "row": np.repeat(rows, width),
                "col": np.tile(np.arange(width), rows.size),
                "squared": nearest.ravel(),
            }
        )

    return transform


def distance_transform(coast: DataFrame, grid: RasterGrid) -> DataFrame:
    """(row, col, squared): exact squared pixel distance to the nearest coast cell.

    Empty when there is no coast cell at all. The task count is explicit because
    the input is small and the output is not: left to adaptive coalescing, which
    sees only input bytes, few tasks would produce the whole raster.
    """
    strip_rows = max(1, STRIP_PIXELS // grid.cols)
    tasks = ceil(grid.rows / (strip_rows * STRIPS_PER_TASK))
    return (
        column_owners(coast, grid.rows, strip_rows)
        .repartition(tasks, "strip")
        .groupBy("strip")
        .applyInArrow(
            _strip_transform(grid.rows, grid.cols, strip_rows), "row long, col long, squared long"
        )
    )


def coast_distances(vertices: DataFrame, grid: RasterGrid) -> DataFrame:
    """``raw_coastline_distance`` from coastline vertices; coast cells dropped."""
    coast = rasterise_vertices(vertices, grid)
    return (
        distance_transform(coast, grid)
        .where(F.col("squared") > 0)
        .select(
            pixel_centre(F.col("row"), grid.lat_min, grid.res).alias("latitude"),
            pixel_centre(F.col("col"), grid.lon_min, grid.res).alias("longitude"),
            (F.sqrt("squared") * F.lit(grid.km_per_pixel)).alias("distance_to_coast_km"),
        )
    )
