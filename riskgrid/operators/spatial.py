"""Spatial joins: region boxes (J1) and nearest boundary segment.

Both reference tables are parameters held on the driver as Python lists. Each is indexed once over
a fixed grid of ``CELL``-degree cells (16,200, and one for all places off the globe), whatever its
size: a cell holds what can matter to a point inside it. Events meet their cell's list in one
equi-join whose other side has a row per cell; no shuffle of events, no key but the place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid.functions.geo import in_box, nearest_segment_degrees
from riskgrid.schema import KM_PER_DEGREE

CELL = 2.0
COLUMNS, ROWS = 180, 90
#: Side lengths of the squares that are refined down to cells, from one square around the globe.
LEVELS = (360.0, 60.0, 10.0, CELL)
#: The cell of places off the globe, NaN included.
OUTSIDE = -1
#: Wider than the rounding of a place to its cell.
SLACK = 1e-9


def cell_of(lat: Column, lon: Column) -> Column:
    """The grid cell of a place; null if a coordinate is null."""
    column = F.least(F.floor((lon + 180.0) / CELL), F.lit(COLUMNS - 1))
    row = F.least(F.floor((lat + 90.0) / CELL), F.lit(ROWS - 1))
    return (F.when(in_box(lat, lon, -90.0, 90.0, -180.0, 180.0), row * COLUMNS + column)
            .when(lat.isNotNull() & lon.isNotNull(), F.lit(OUTSIDE)).cast("int"))


def _cell_number(x: float, y: float) -> int:
    """The cell whose lower left corner is (x, y)."""
    return round((y + 90.0) / CELL) * COLUMNS + round((x + 180.0) / CELL)


def _index(spark: SparkSession, lists: dict, items: pa.StructArray) -> DataFrame:
    """``__cell, __items``: one row per cell that has a list (of positions in ``items``)."""
    sizes = [len(v) for v in lists.values()]
    flat = np.concatenate(list(lists.values())) if lists else np.empty(0, np.int64)
    held = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), items.take(pa.array(flat, pa.int64())))
    return spark.createDataFrame(pa.table({"__cell": pa.array(list(lists), pa.int32()), "__items": held}))


# ---------------------------------------------------------------------------
# Box range join
# ---------------------------------------------------------------------------

def box_join(events: DataFrame, regions, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Inner theta join: one output row per (event, box containing it), bounds inclusive.

    An event inside two overlapping boxes appears once per box, as a per-box
    pull would return it twice; an event in no box is dropped.
    """
    unboxed = [r.name for r in regions if None in (r.min_lat, r.max_lat, r.min_lon, r.max_lon)]
    if unboxed:
        raise ValueError(f"regions without a box: {unboxed}")
    sides = {k: np.array([float(getattr(r, k)) for r in regions]) for k in ("min_lat", "max_lat", "min_lon", "max_lon")}
    lists = {OUTSIDE: np.arange(len(regions))}
    for y in np.arange(-90.0, 90.0, CELL):
        across = np.flatnonzero((sides["min_lat"] <= y + CELL + SLACK) & (sides["max_lat"] >= y - SLACK))
        for x in np.arange(-180.0, 180.0, CELL) if len(across) else ():
            touched = across[(sides["min_lon"][across] <= x + CELL + SLACK) & (sides["max_lon"][across] >= x - SLACK)]
            if len(touched):
                lists[_cell_number(x, y)] = touched
    boxes = pa.StructArray.from_arrays([pa.array([r.name for r in regions], pa.string()), *map(pa.array, sides.values())], names=["name", *sides])
    met = events.withColumn("__cell", cell_of(F.col(lat), F.col(lon))).join(_index(events.sparkSession, lists, boxes), "__cell")
    hits = F.filter("__items", lambda b: in_box(F.col(lat), F.col(lon), b["min_lat"], b["max_lat"], b["min_lon"], b["max_lon"]))
    return (met.withColumn("__box", F.explode(hits)).withColumn("box_region", F.col("__box.name"))
            .drop("__cell", "__items", "__box"))


# ---------------------------------------------------------------------------
# Nearest polyline
# ---------------------------------------------------------------------------

def _distances(x: float, y: float, ends: np.ndarray) -> np.ndarray:
    """Planar degrees from one point to each segment (rows x1, y1, x2, y2)."""
    x1, y1, dx, dy = ends[:, 0], ends[:, 1], ends[:, 2] - ends[:, 0], ends[:, 3] - ends[:, 1]
    length = dx * dx + dy * dy
    t = np.clip(((x - x1) * dx + (y - y1) * dy) / np.where(length == 0, 1.0, length), 0.0, 1.0)
    return np.hypot(x - x1 - t * dx, y - y1 - t * dy)


def _nearest_lists(ends: np.ndarray) -> dict:
    """Per cell, every segment that is nearest to some point of it.

    With d the distance from a square's centre to the nearest segment and r its half diagonal, the
    segment nearest to any point of the square is at most d + 2 r from the centre. So a square
    keeps the segments within that, and hands them down to the squares that it is cut into.
    """
    level = [(-180.0, -180.0, np.arange(len(ends)))]
    for size, part in zip(LEVELS, LEVELS[1:]):
        steps = np.arange(round(size / part)) * part
        finer = []
        for x0, y0, held in level:
            for y in y0 + steps:
                if y >= 90.0 or y + part <= -90.0:
                    continue
                for x in x0 + steps:
                    d = _distances(x + part / 2, y + part / 2, ends[held])
                    finer.append((x, y, held[d <= d.min() + part * 2**0.5 + SLACK]))
        level = finer
    return {OUTSIDE: np.arange(len(ends))} | {_cell_number(x, y): held for x, y, held in level}


def add_distance_to_fault(events: DataFrame, segments, lon: str = "longitude",
                          lat: str = "latitude") -> DataFrame:
    """Add ``distance_to_fault_km``: planar degrees x 111 to the nearest segment, one per event.

    Ids play no part, so they may repeat or be null. A null coordinate, or a map without
    segments, gives null.
    """
    if not segments:
        return events.withColumn("distance_to_fault_km", F.lit(None).cast("double"))
    ends = np.array([[s.x1, s.y1, s.x2, s.y2] for s in segments], float)
    items = pa.StructArray.from_arrays([pa.array(ends[:, i]) for i in range(4)], names=["x1", "y1", "x2", "y2"])
    index = _index(events.sparkSession, _nearest_lists(ends), items)
    met = events.withColumn("__cell", cell_of(F.col(lat), F.col(lon))).join(index, "__cell", "left")
    nearest = nearest_segment_degrees(F.col(lon), F.col(lat), F.col("__items")) * F.lit(KM_PER_DEGREE)
    return met.withColumn("distance_to_fault_km", nearest).drop("__cell", "__items")


def segments_from_lines(lines) -> list:
    """Polylines (lists of (lon, lat)) to the segment list."""
    from riskgrid.schema import Segment
    out = []
    for li, coords in enumerate(lines):
        for si in range(len(coords) - 1):
            (x1, y1), (x2, y2) = coords[si][:2], coords[si + 1][:2]
            out.append(Segment(li, si, float(x1), float(y1), float(x2), float(y2)))
    return out
