"""Grid snapping, cell keys, surrogate keys and site-name parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pelagrid.config import CELL_DEG

# Key separator and the text hashed in place of a NULL field.
KEY_SEPARATOR = "-"
KEY_NULL = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*fields: Column) -> Column:
    """md5 over the text of the fields; NULL fields hash to a fixed token."""
    parts = [F.coalesce(f.cast("string"), F.lit(KEY_NULL)) for f in fields]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def time_text(ts: Column) -> Column:
    """Timestamp text that enters a key: UTC with an explicit offset."""
    return F.concat(ts.cast("string"), F.lit("+00"))


def cell_index(coord: Column, size: float = CELL_DEG) -> Column:
    """Integer number of the cell a coordinate falls in; the cheap grouping key."""
    return F.floor(coord / F.lit(size))


def index_centre(index: Column, size: float = CELL_DEG) -> Column:
    """Centre coordinate of a numbered cell."""
    return F.round(index.cast("double") * F.lit(size) + F.lit(size / 2), 4)


def snap(coord: Column, size: float = CELL_DEG) -> Column:
    """Coordinate moved to the centre of its cell."""
    return index_centre(cell_index(coord, size), size)


def cell_key(lat: Column, lon: Column, size: float = CELL_DEG) -> Column:
    """Spatial join key of a point's cell.

    The snapped coordinates are hashed as text so that equal cells always get
    equal keys whatever raster they come from.
    """
    return surrogate_key(snap(lat, size), snap(lon, size))


def index_key(lat_index: Column, lon_index: Column, size: float = CELL_DEG) -> Column:
    """The same key from cell numbers, for use after aggregation."""
    return surrogate_key(index_centre(lat_index, size), index_centre(lon_index, size))


def nearest_line(coord: Column, step: Column | float) -> Column:
    """Nearest multiple of ``step`` (grid lines, not cell centres)."""
    step = step if isinstance(step, Column) else F.lit(float(step))
    return F.round(coord / step) * step


def site_key(area: Column, lat: Column, lon: Column) -> Column:
    """Registry key of a grid point: upper-case area name and coordinates."""
    return F.concat_ws("_", F.upper(area), lat.cast("string"), lon.cast("string"))


def site_coordinate(name: Column, axis: str, from_last: bool = False) -> Column:
    """Latitude or longitude encoded in a site name.

    By default the fourth and fifth ``_`` token, NULL for names of fewer than
    five tokens; a fifth-token name that does not hold numbers fails the cast.
    ``from_last`` reads the last two tokens instead, for area names of any length.
    """
    tokens = F.split(name, "_")
    if from_last:
        token = F.element_at(tokens, -2 if axis == "lat" else -1)
        return F.when(F.size(tokens) >= 3, token.cast("double"))
    token = F.get(tokens, F.lit(3 if axis == "lat" else 4))
    return F.when(F.size(tokens) >= 5, token.cast("double"))
