"""Helpers shared by the training-data operators: row keys, null-safe joins, Arrow batch size."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid.session import drop_tables, materialize

__all__ = ["KEY", "arrow_map", "batch_bytes", "drop_tables", "empty_text", "few", "if_small", "key_columns", "key_match", "materialize", "read", "settings", "split_lines"]

#: A row's key: its id and a hash of its text. Repeated rows share a key and get the same result.
KEY = ("__key_id", "__key_text")
#: Rows in one Arrow batch; texts are long, so batches are short.
ARROW_ROWS = 512


def empty_text(text_col: str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def key_columns(id_col: str, text_col: str) -> list[Column]:
    return [F.col(id_col).alias(KEY[0]), F.xxhash64(empty_text(text_col)).alias(KEY[1])]


def key_match(left: DataFrame, right: DataFrame, keys=KEY) -> Column:
    """Equality on all key columns; null ids match each other."""
    out = None
    for k in keys:
        same = left[k].eqNullSafe(right[k])
        out = same if out is None else out & same
    return out


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with batches short enough for long texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return df.mapInArrow(fn, schema)


@contextmanager
def batch_bytes(spark: SparkSession, most: int) -> Iterator[None]:
    """Arrow batches of at most some ``most`` bytes for what runs inside; the session's values come back after it."""
    names = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch")
    with settings(spark, {names[0]: str(most), names[1]: spark.conf.get(names[1])}):
        yield


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with these values for what runs inside; its own come back after it."""
    before = {n: spark.conf.get(n, None) for n in values}
    for n, value in values.items():
        spark.conf.set(n, value)
    try:
        yield
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows, or items of their arrays, of a join side that is broadcast, after a count (some 50 bytes each);
#: larger sides are joined by shuffle.
BROADCAST_ITEMS = 500_000


def few(df: DataFrame, items: Column | None = None) -> bool:
    """Whether ``df`` (a written table) holds few enough rows and items for a broadcast."""
    return (df.agg(F.sum(F.lit(1) if items is None else 1 + items)).first()[0] or 0) <= BROADCAST_ITEMS


def if_small(df: DataFrame, items: Column | None = None) -> DataFrame:
    """``df`` (a written table), marked for broadcast if it holds few rows and items; so long texts need not be shuffled to meet it."""
    return F.broadcast(df) if few(df, items) else df
