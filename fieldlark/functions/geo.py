"""Distances, longitudes and a nested square grid as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius (authalic sphere), km.
RADIUS_KM = 6371.007180918475


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    h = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return 2 * RADIUS_KM * F.atan2(F.sqrt(h), F.sqrt(F.greatest(F.lit(0.0), 1 - h)))


def wrapped_longitude(lon: Column) -> Column:
    """The longitude in [-180, 180)."""
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def cell(lat: Column, lon: Column, resolution: int) -> Column:
    """Cell id at a resolution: squares of 90 / 2**resolution degrees, named by row and column."""
    size = 90.0 / 2**resolution
    row = F.least(F.floor((lat + 90) / size), F.lit(2 ** (resolution + 1) - 1)).cast("bigint")
    col = F.floor((wrapped_longitude(lon) + 180) / size).cast("bigint")
    return F.concat_ws("/", F.lit(resolution), row, col)


def parent(cell_id: Column, steps: int = 1) -> Column:
    """The cell ``steps`` resolutions up that holds a cell."""
    part = lambda k: F.split_part(cell_id, F.lit("/"), F.lit(k)).try_cast("bigint")
    return F.concat_ws("/", part(1) - steps, F.shiftright(part(2), steps), F.shiftright(part(3), steps))


def neighbours(cell_id: Column) -> Column:
    """The cell and the up to 8 cells around it; columns wrap at the date line, rows end at the poles."""
    part = lambda k: F.split_part(cell_id, F.lit("/"), F.lit(k)).try_cast("bigint")
    res, row, col = part(1), part(2), part(3)
    rows = F.lit(2).cast("bigint") * F.pow(F.lit(2), res).cast("bigint")
    around = F.flatten(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda j: F.struct((row + i).alias("r"), F.pmod(col + j, 2 * rows).alias("c")))))
    inside = F.filter(around, lambda s: (s["r"] >= 0) & (s["r"] < rows))
    return F.array_distinct(F.transform(inside, lambda s: F.concat_ws("/", res, s["r"], s["c"])))
