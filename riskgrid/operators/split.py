"""Embargoed chronological split, at any grain (events or region-days)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgrid.schema import SplitSpec


def split_of(day: Column, spec: SplitSpec) -> Column:
    """'train' / 'validate' / 'test', or null inside an embargo gap or for a null day.

    Cutoffs are inclusive; the last ``embargo_days`` of train and of validate
    are dropped so a 7-day-ahead label never reads the next block.
    """
    return (F.when(day <= F.lit(spec.train_last), F.lit("train"))
            .when((day >= F.lit(spec.validate_start)) & (day <= F.lit(spec.validate_last)), F.lit("validate"))
            .when(day >= F.lit(spec.test_start), F.lit("test")))


def assign_split(df: DataFrame, spec: SplitSpec, date_column: str = "date") -> DataFrame:
    """Tag rows by the UTC day of ``date_column`` and drop untagged rows."""
    day = F.to_date(F.col(date_column))
    return df.withColumn("split", split_of(day, spec)).filter(F.col("split").isNotNull())


def drop_unobservable(df: DataFrame, label: str = "label_7d") -> DataFrame:
    return df.filter(F.col(label).isNotNull())


def split_summary(df: DataFrame, spec: SplitSpec, date_column: str = "date") -> DataFrame:
    """Rows per split, share of kept rows, and the number dropped by the embargo.

    One aggregate with conditional counts; the shares come from the same row,
    so there is no second pass and no global window.
    """
    s = split_of(F.to_date(F.col(date_column)), spec)
    agg = df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(s == "train").alias("train"),
        F.count_if(s == "validate").alias("validate"),
        F.count_if(s == "test").alias("test"),
        F.count_if(s.isNull()).alias("dropped"),
    )
    kept = F.col("train") + F.col("validate") + F.col("test")
    stacked = agg.select(
        "rows_in", "dropped", kept.alias("kept"),
        F.explode(F.array(
            F.struct(F.lit("train").alias("split"), F.col("train").alias("rows")),
            F.struct(F.lit("validate").alias("split"), F.col("validate").alias("rows")),
            F.struct(F.lit("test").alias("split"), F.col("test").alias("rows")),
        )).alias("s"))
    return stacked.select(
        F.col("s.split").alias("split"),
        F.col("s.rows").alias("rows"),
        F.when(F.col("kept") > 0, F.col("s.rows") / F.col("kept")).otherwise(F.lit(0.0)).alias("share"),
        F.col("dropped"),
        F.col("rows_in"),
    )
