"""Plane and map geometry as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6371008.8


def bin_centre(v: Column, width: float) -> Column:
    """Centre of the grid bin that holds ``v``."""
    return F.round(F.floor(v / width) * width + width / 2, 4)


def mercator_tile(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """The web-mercator tile of a point."""
    n = float(1 << zoom)
    r = F.radians(lat)
    x = F.floor((lon + 180.0) / 360.0 * n)
    y = F.floor((1.0 - F.log(F.tan(r) + 1.0 / F.cos(r)) / math.pi) / 2.0 * n)
    return x.cast("long"), y.cast("long")


def box_area_m2(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Area of a longitude-latitude box on a sphere, in closed form."""
    return EARTH_M * EARTH_M * F.radians(east - west) * (F.sin(F.radians(north)) - F.sin(F.radians(south)))


def boxes_meet(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Closed overlap of two ``(west, south, east, north)`` boxes."""
    return (a[0] <= b[2]) & (a[2] >= b[0]) & (a[1] <= b[3]) & (a[3] >= b[1])


def iou(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Intersection over union of two corner boxes; touching boxes have 0."""
    w = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    area = lambda x: (x[2] - x[0]) * (x[3] - x[1])
    return F.coalesce(w * h / F.nullif(area(a) + area(b) - w * h, F.lit(0.0)), F.lit(0.0))


def in_polygon(x: Column, y: Column, ring: Column) -> Column:
    """Ray casting: whether a point is in a ring, an array of ``struct<x, y>`` corners (not closed)."""
    n = F.size(ring)

    def crosses(i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, (i + 1) % n)
        apart = (a["y"] > y) != (b["y"] > y)
        return (apart & (x < (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"])).cast("int")

    hits = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + F.coalesce(crosses(i), F.lit(0)))
    return F.when(n < 3, F.lit(False)).otherwise(hits % 2 == 1)
