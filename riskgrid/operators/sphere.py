"""Nearest boundary segment on the sphere (X7), for maps of any size.

Places and segment ends are unit vectors, so poles and the date line are places like all others. A segment is the
shorter great-circle arc between its ends; one of length zero, or between opposite points, counts as its ends.

The map is a table ``x1, y1, x2, y2`` (degrees). An index over latitude-longitude cells is built from coarse to fine: a
cell keeps each segment that is nearest to some point of it. With d the angle from the cell's centre to any
segment and r the largest angle from the centre to a point of the cell, the nearest one is at most d + 2 r
from the centre; so a cell keeps the segments within that, and hands them to the cells it is cut into. The d of each cell
comes first, from a segment of each cell that segments begin in (at most as many as cells, whatever the map); then
each segment goes down the broadcast cells by projections alone, so what is written grows as the map does.
Only cells that hold events are refined. A cell's segments then meet its events in a join on the cell, and the
least angle of each event is taken before anything is shuffled again: exact, with no list of a cell's segments or events in
one row. A cell crowded with events or segments is one join key, which Spark splits (AQE skew join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgrid.session import materialize

EARTH_KM = 6371.0
#: Cell sides in degrees, coarse to fine; each divides the one before.
SIDES = (30.0, 6.0, 1.5)
#: Wider than the rounding of an angle.
SLACK = 1e-9
XYZ = ("x", "y", "z")
ENDS = ("ax", "ay", "az", "bx", "by", "bz")


def unit(lat: Column, lon: Column) -> list[Column]:
    """Unit vector of a place in degrees."""
    la, lo = F.radians(lat), F.radians(lon)
    return [F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)]


def _dot(u, v) -> Column:
    return u[0] * v[0] + u[1] * v[1] + u[2] * v[2]


def _cross(u, v) -> list[Column]:
    return [u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]]


def _norm(u) -> Column:
    return F.sqrt(_dot(u, u))


def angle(u, v) -> Column:
    """Angle between unit vectors, exact for small and for large ones."""
    return F.atan2(_norm(_cross(u, v)), _dot(u, v))


def arc_angle(p, a, b) -> Column:
    """Angle from p to the arc between a and b."""
    n = _cross(a, b)
    size = _norm(n)
    beside = (_dot(_cross(n, a), p) >= 0) & (_dot(_cross(b, n), p) >= 0)
    across = F.abs(F.asin(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), _dot(n, p) / size))))
    return F.when((size > 1e-15) & beside, across).otherwise(F.least(angle(p, a), angle(p, b)))


def cell(lat: Column, lon: Column, side: float) -> Column:
    """Number of the cell of a place on the globe; longitudes beyond 180 go on around it. Null if there is no such place."""
    columns = round(360 / side)
    around = F.pmod(F.floor((lon + 180.0) / side), F.lit(columns))
    row = F.least(F.floor((lat + 90.0) / side), F.lit(round(180 / side) - 1))
    there = lat.between(-90.0, 90.0) & (F.abs(lon) <= 1e6)  # neither null, NaN nor infinite
    return F.when(there, row * columns + around).cast("int")


def _parent(number: Column, side: float, coarser: float) -> Column:
    columns, part = round(360 / side), round(coarser / side)
    row, column = F.floor(number / columns), F.pmod(number, F.lit(columns))
    return (F.floor(row / part) * round(360 / coarser) + F.floor(column / part)).cast("int")


def _centre(number: Column, side: float) -> tuple[list[Column], Column]:
    """A cell's centre, and the angle to its farthest point: a corner, as distance from the centre grows along its borders."""
    columns = round(360 / side)
    lat = F.floor(number / columns) * side - 90.0 + side / 2
    lon = F.pmod(number, F.lit(columns)) * side - 180.0 + side / 2
    c = unit(lat, lon)
    reach = F.greatest(*[angle(c, unit(lat + dy * side / 2, lon + side / 2)) for dy in (-1, 1)])
    return c, reach


CENTRE = ("cx", "cy", "cz")


def _far() -> Column:
    """Angle from the centre of a cell to the arc beside it."""
    return arc_angle([F.col(k) for k in CENTRE], [F.col(k) for k in ENDS[:3]], [F.col(k) for k in ENDS[3:]])


def _with_centre(df: DataFrame, side: float) -> DataFrame:
    c, reach = _centre(F.col("cell"), side)
    return df.select("*", *[x.alias(k) for k, x in zip(CENTRE, c)], reach.alias("reach"))


def _handed_down(arcs: DataFrame, cells: DataFrame, i: int) -> DataFrame:
    """The arcs beside the cells of level ``i`` that they may be nearest in; above the first level they carry the ``cell`` above."""
    return arcs.join(F.broadcast(cells)) if i == 0 else arcs.withColumnRenamed("cell", "above").join(F.broadcast(cells), "above").drop("above")


def _kept(arcs: DataFrame, limits: list) -> DataFrame:
    """``cell`` and ends of the arcs within the limit of each cell from the coarsest level down: projections beside
    broadcast cells, nothing is shuffled or written."""
    for i, cells in enumerate(limits):
        arcs = _handed_down(arcs, cells, i).where(_far() <= F.col("limit")).select("cell", *ENDS)
    return arcs


def segment_index(segments: DataFrame, cells: DataFrame) -> DataFrame:
    """``cell`` and the ends of each segment that may be nearest to a point of it, for the finest cells given in ``cells``."""
    a, b = unit(F.col("y1").cast("double"), F.col("x1").cast("double")), unit(F.col("y2").cast("double"), F.col("x2").cast("double"))
    arcs = segments.select(*[c.alias(k) for k, c in zip(ENDS, a + b)]).where(" AND ".join(f"{k} IS NOT NULL AND NOT isnan({k})" for k in ENDS)).distinct()
    arcs = materialize(arcs, "sphere-arcs")
    lat, lon = F.degrees(F.asin("az")), F.degrees(F.atan2("ay", "ax"))
    limits, some = [], None
    for i, side in enumerate(SIDES):
        # One segment of each cell that segments begin in, beside those of the coarser cells: at most as many as cells.
        own = _with_centre(arcs.withColumn("cell", cell(lat, lon, side)), side).withColumn("far", _far())
        nearest = own.groupBy("cell").agg(F.min(F.struct("far", *ENDS)).alias("s")).select(*[f"s.{k}" for k in ENDS])
        some = materialize((nearest if some is None else some.unionByName(nearest)).distinct(), "sphere-some")
        wanted = cells.select(_parent(F.col("cell"), SIDES[-1], side).alias("cell")).distinct() if side != SIDES[-1] else cells
        if i:
            wanted = wanted.withColumn("above", _parent(F.col("cell"), side, SIDES[i - 1]))
        # Written with their centres: a condition of a join would work them out again for each arc.
        wanted = materialize(_with_centre(wanted, side), "sphere-wanted")
        least = _handed_down(_kept(some, limits), wanted, i).groupBy("cell").agg(F.min(_far()).alias("least"))
        limit = (F.col("least") + 2 * F.col("reach") + SLACK).alias("limit")
        limits.append(materialize(wanted.join(F.broadcast(least), "cell").select("cell", *(["above"] if i else []), *CENTRE, limit), "sphere-limits"))
    return _kept(arcs, limits)


def nearest_segment_km(events: DataFrame, segments: DataFrame, lat: str = "latitude", lon: str = "longitude", out: str = "geodesic_km") -> DataFrame:
    """``events`` with the great-circle km to the nearest segment; null for places that are not on the globe, and without segments.

    Equal places are looked up once. Ids play no part, so they may repeat or be null.
    """
    la, lo = F.col(lat).cast("double"), F.col(lon).cast("double")
    places = events.select(la.alias("lat"), lo.alias("lon")).distinct().withColumn("cell", cell(F.col("lat"), F.col("lon"), SIDES[-1])).where("cell IS NOT NULL")
    places = materialize(places.select("lat", "lon", "cell", *[c.alias(k) for k, c in zip(XYZ, unit(F.col("lat"), F.col("lon")))]), "sphere-places")
    index = segment_index(segments, materialize(places.select("cell").distinct(), "sphere-cells"))
    met = places.join(index, "cell")
    least = met.groupBy("lat", "lon").agg(F.min(arc_angle([F.col(k) for k in XYZ], [F.col(k) for k in ENDS[:3]], [F.col(k) for k in ENDS[3:]])).alias("least"))
    found = least.select(F.col("lat").alias("__lat"), F.col("lon").alias("__lon"), (F.col("least") * EARTH_KM).alias(out))
    return events.join(found, (la == F.col("__lat")) & (lo == F.col("__lon")), "left").drop("__lat", "__lon")
