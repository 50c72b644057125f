"""Incremental daily tally with Structured Streaming (the weekly-refresh form).

landed event files --readStream (schema given)--> withWatermark(time)
  --> groupBy(region, 1-day window).agg(tally)  [update mode: changed keys only]
  --> foreachBatch: append the batch's rows, tagged with the batch id, to a
      changelog table in the shared checkpoint folder.
The current tally is the newest row per (region, day) of the changelog, so a
replayed batch (after a failure) rewrites the same keys and the view stays
exact. Trailing row frames are not allowed on streams, so the windows and the
label run as a batch job on the tally (``plans.feature_table``). Events later
than the watermark are dropped by Spark; ``run_to_changelog`` returns how many partial
sums of such events it dropped, and if there are any, their batch must be applied by
``plans.refresh``, which takes late events of any age. The delay should cover how far out of order files can arrive (a day's landing: days; a
replay of yearly slices: more than a year). State is one row per (region, day)
inside the delay, so a long delay stays small.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskgrid.functions.columns import fixed_point, nan_to_null
from riskgrid.operators.grid import large_flag
from riskgrid.session import checkpoint_dir

TALLY_KEYS = ["region", "date"]


def tally_aggregates(regions):
    def fsum(c):
        return F.coalesce(F.sum(fixed_point(nan_to_null(c))), F.lit(0)).cast("bigint")
    return [
        F.count(F.lit(1)).alias("n"),
        fsum("magnitude").alias("mag_sum"),
        F.max(nan_to_null("magnitude")).alias("mag_max"),
        F.count_if(large_flag(F.col("region"), F.col("magnitude"), regions)).alias("large"),
        fsum("depth_km").alias("depth_sum"),
        fsum("latitude").alias("lat_sum"),
        fsum("longitude").alias("lon_sum"),
    ]


def streaming_tally(events: DataFrame, regions, watermark: str = "30 days") -> DataFrame:
    """Streaming aggregate per (region, UTC day); ``time`` may be NTZ (cast for the watermark)."""
    ev = events.withColumn("_t", F.col("time").cast("timestamp")).withWatermark("_t", watermark)
    return (ev.groupBy("region", F.window("_t", "1 day").alias("w"))
            .agg(*tally_aggregates(regions))
            .select("region", F.to_date(F.col("w.start")).alias("date"), "n", "mag_sum", "mag_max",
                    "large", "depth_sum", "lat_sum", "lon_sum"))


def run_to_changelog(spark: SparkSession, source_dir: str, schema, regions, changelog: str,
                     state_dir: str, files_per_batch: int = 8, watermark: str = "30 days") -> int:
    """Drain everything landed in ``source_dir`` (availableNow) into the changelog; returns how many partial sums of
    rows came too late for the watermark and were dropped (over the batches whose progress Spark keeps: 100 unless set otherwise)."""
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
           .parquet(source_dir))

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(changelog)

    q = (streaming_tally(src, regions, watermark).writeStream.outputMode("update")
         .foreachBatch(sink).option("checkpointLocation", state_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    # The last batches' progress is kept by the query (``spark.sql.streaming.numRecentProgressUpdates`` of them).
    return sum(o["numRowsDroppedByWatermark"] for p in q.recentProgress for o in json.loads(p.json)["stateOperators"])


def current_tally(spark: SparkSession, changelog: str) -> DataFrame:
    """Newest row per (region, day) of the changelog."""
    log = spark.read.parquet(changelog)
    w = Window.partitionBy(*TALLY_KEYS).orderBy(F.col("batch_id").desc())
    return log.withColumn("_rk", F.row_number().over(w)).filter("_rk = 1").drop("_rk", "batch_id")


#: Rows a landed file holds at most, more or less (some 50 MB).
ROWS_PER_FILE = 1_000_000


def land_in_time_order(events: DataFrame, source_dir: str, time_col: str = "time",
                       unit: str = "year", files_per_slice: int | None = None) -> int:
    """Test harness: land events as files, one append per ``unit`` slice, oldest first,
    so file arrival order follows event time as a live feed's would. The events are worked
    out once, laid out by slice. Each slice is range-partitioned by time into files by its rows, two at
    least: a stream pays for each micro-batch, so the number of files must not follow the number of shuffle
    partitions. (A real deployment lands files from outside; this only replays the given table.)"""
    spark, at = events.sparkSession, scratch(events.sparkSession, "slices")
    name = F.concat(F.lit("s"), F.date_trunc(unit, F.col(time_col)).cast("string"))
    events.where(F.col(time_col).isNotNull()).withColumn("_slice", name).write.partitionBy("_slice").parquet(at)
    laid = spark.read.schema(events.withColumn("_slice", name).schema).parquet(at)
    slices = laid.groupBy("_slice").count().orderBy("_slice").collect()
    for s in slices:
        n = files_per_slice or max(2, -(-s["count"] // ROWS_PER_FILE))
        (laid.filter(F.col("_slice") == F.lit(s["_slice"])).drop("_slice")
         .repartitionByRange(n, time_col).write.mode("append").parquet(source_dir))
    return len(slices)


def scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/riskgrid-stream/{name}-{uuid.uuid4().hex}"
