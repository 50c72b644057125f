"""Catalog predicates, cleaning and the cleaning report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.functions.geo import in_box
from riskgrid.schema import FEATURE_ROLE_COLUMNS, METADATA_COLUMNS, MIN_MAGNITUDE, role_of


def catalog_filter(df: DataFrame, box=None, year: int | None = None,
                   min_magnitude: float = MIN_MAGNITUDE, time_col: str = "time") -> DataFrame:
    """Request predicate: year window, lat/lon box, magnitude floor.

    The year is half-open [Jan 1, next Jan 1) so no sub-second event at a year
    end falls between two chunks (a deliberate difference from closing at
    23:59:59). Plain comparisons on columns, so Parquet gets them pushed down.
    """
    cond = F.col("magnitude") >= F.lit(min_magnitude)
    if year is not None:
        lo = dt.datetime(year, 1, 1)
        hi = dt.datetime(year + 1, 1, 1)
        t = F.col(time_col)
        cond = cond & (t >= F.lit(lo).cast(t_type(df, time_col))) & (t < F.lit(hi).cast(t_type(df, time_col)))
    if box is not None:
        cond = cond & in_box(F.col("latitude"), F.col("longitude"), box.min_lat, box.max_lat,
                             box.min_lon, box.max_lon)
    return df.filter(cond)


def t_type(df: DataFrame, c: str) -> str:
    return df.schema[c].dataType.simpleString()


def clean(df: DataFrame, keep_type: str = "earthquake") -> DataFrame:
    """Keep one event type (null type is dropped) and lower-case ``status``."""
    return df.filter(F.col("type") == F.lit(keep_type)).withColumn("status", F.lower(F.col("status")))


def clean_report(df: DataFrame, keep_type: str = "earthquake") -> DataFrame:
    """Rows before / removed / after, and the sorted distinct statuses after cleaning.

    One aggregate pass; the status set is bounded by the status vocabulary.
    """
    kept = F.col("type") == F.lit(keep_type)
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(~F.coalesce(kept, F.lit(False))).alias("rows_removed"),
        F.count_if(kept).alias("rows_after"),
        F.array_join(F.sort_array(F.collect_set(F.when(kept, F.lower(F.col("status"))))), ",").alias("statuses"),
    )


def role_projection(df: DataFrame, keep_metadata: bool = True) -> DataFrame:
    """Project the allow-listed columns; excluded (leak-prone) columns never pass."""
    allowed = list(FEATURE_ROLE_COLUMNS) + (list(METADATA_COLUMNS) if keep_metadata else [])
    cols = [c for c in df.columns if c in allowed or (role_of(c) is None and c == "date")]
    return df.select(*cols)
