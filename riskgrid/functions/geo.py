"""Planar geometry as native column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def point_segment_degrees(px: Column, py: Column, x1, y1, x2, y2) -> Column:
    """Planar distance (degrees) from point (px, py) to segment (x1,y1)-(x2,y2).

    The projection parameter is clamped to [0, 1]; a zero-length segment is a
    point. Segment ends may be columns or lambda variables.
    """
    dx = x2 - x1
    dy = y2 - y1
    len2 = dx * dx + dy * dy
    t_raw = ((px - x1) * dx + (py - y1) * dy) / len2
    t = F.when(len2 == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), t_raw)))
    cx = x1 + t * dx
    cy = y1 + t * dy
    return F.sqrt((px - cx) * (px - cx) + (py - cy) * (py - cy))


def nearest_segment_degrees(px: Column, py: Column, segments: Column) -> Column:
    """Smallest distance from a point to any segment of an array<struct> column.

    The segment array is a constant of the plan (a literal), so the reduction is a
    per-row higher-order function: no join, no shuffle, inside codegen.
    """
    return F.array_min(F.transform(
        segments,
        lambda s: point_segment_degrees(px, py, s["x1"], s["y1"], s["x2"], s["y2"]),
    ))


def in_box(lat: Column, lon: Column, min_lat, max_lat, min_lon, max_lon) -> Column:
    """Inclusive lat/lon rectangle test."""
    return lat.between(min_lat, max_lat) & lon.between(min_lon, max_lon)
