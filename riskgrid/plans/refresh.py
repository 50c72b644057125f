"""Incremental refresh of the stored tally and features (X4): only what a batch can change is worked out again.

A store holds these tables, laid out by month so that an update rewrites the months it touches and no others:

* ``events``: every landed batch under its number; landing a batch again replaces it. Of an id that several
  batches hold, the row of the highest batch counts (``superseded`` lists such ids; there are few),
* ``tally``: one row per (region, day) that has events; a day that has lost all of them keeps a row of 0,
* ``features``: every region-day of the calendar with its features and nullable label,
* ``journal``: the keys that each batch may have changed.

Applying a batch

1. notes the (region, day) keys it can change in the journal, before anything else is written: its own days, the days
   of what this batch held before, and the days of other versions of its events;
2. replaces the batch's events;
3. works out the tally of the changed keys from all events of their months, and upserts it;
4. works out the features of the rows a change can reach: 7 days back (label), 29 ahead (windows), on to the region's next
   event (days since the last one), and whatever the end of the calendar has made observable. They are computed on
   slices of the calendar, each with the 29 days before and 7 after that its windows read.

Every step reads what the journal and the events say and replaces whole keys, so a batch may be applied any number of
times, also after it was cut off anywhere. Rows of days more than ``late_days`` behind the newest day known are counted in the report and
take part like all others; rows before the first day of the calendar move its start, which every region's first rows depend
on: the features are then rebuilt. Rows without a region or a day are counted and belong to no key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskgrid.operators.grid import daily_tally
from riskgrid.operators.windows import as_feature_table, forward_label, trend_column, window_feature_columns
from riskgrid.schema import FEATURE_COLUMNS, TARGET, PipelineParams
from riskgrid.session import materialize

KEYS = ["region", "date"]
#: Days before a row that its windows read, besides itself.
BACK = 29
REPORT = "batch int, rows long, unkeyed long, late long, changed_days long, rebuilt boolean, feature_rows long"


def _month(date: str = "date"):
    return F.date_format(F.col(date), "'m'yyyy-MM")


class RefreshStore:
    def __init__(self, spark: SparkSession, root: str, params: PipelineParams, late_days: int = 30):
        self.spark, self.root, self.params, self.late_days = spark, root.rstrip("/"), params, late_days

    # -- tables --------------------------------------------------------------

    def _read(self, name: str) -> DataFrame | None:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        found = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
        return self.spark.read.option("mergeSchema", False).parquet(f"{self.root}/{name}") if found else None

    def _events(self) -> DataFrame | None:
        """The landed rows that have a region and a day."""
        events = self._read("events")
        return None if events is None else events.where("region IS NOT NULL AND date IS NOT NULL")

    def _move(self, source: str, target: str) -> None:
        """Put a batch in the place of what ``target`` holds; rows without a day stay behind, they are in no month."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        old, new = path(target), path(source)
        files = old.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        files.delete(path(f"{source}/month=__HIVE_DEFAULT_PARTITION__"), True)
        files.delete(old, True)
        files.mkdirs(old.getParent())
        if not files.rename(new, old):
            raise OSError(f"{source} could not be moved to {target}")

    def _by_month(self, rows: DataFrame) -> DataFrame:
        """A file a month, written by all cores: of few rows, months would otherwise come together in one task."""
        return rows.withColumn("month", _month()).repartition(self.spark.sparkContext.defaultParallelism, "month")

    def features(self) -> DataFrame:
        return self._read("features").select(*KEYS, *FEATURE_COLUMNS, TARGET)

    def tally(self) -> DataFrame | None:
        t = self._read("tally")
        return None if t is None else t.where("n > 0")

    def _upsert(self, name: str, rows: DataFrame, keys: DataFrame) -> None:
        """Replace the rows of ``keys`` by ``rows``; months without such keys are not read or written."""
        months = [r[0] for r in keys.select(_month()).distinct().collect()]  # the months a batch touches
        old = self._read(name)
        if old is not None:
            kept = old.where(F.col("month").isin(months)).drop("month").join(keys, KEYS, "left_anti")
            rows = kept.unionByName(rows)
        self._by_month(materialize(rows, f"refresh-{name}")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(f"{self.root}/{name}")

    # -- a batch -------------------------------------------------------------

    def apply(self, batch: DataFrame, number: int) -> DataFrame:
        """Land batch ``number`` (``id, region, time`` or ``date``, and the measures) and bring all tables up to date.

        Returns one row: its rows, those without a region or day, those that came late, the region-days
        it may have changed, whether the features were rebuilt, and the feature rows worked out.
        """
        day = F.to_date(F.col("date") if "date" in batch.columns else F.col("time"))
        rows = batch.withColumn("date", day).withColumn("month", _month())
        # Written once, as the events are laid out, and moved among them when its keys are noted.
        landing = f"{self.root}/landing/batch={number}"
        rows.write.mode("overwrite").partitionBy("month").parquet(landing)
        rows = self.spark.read.schema(rows.schema).parquet(landing)
        keyed = rows.where("region IS NOT NULL AND date IS NOT NULL")
        before = self.tally()
        known = before.agg(F.min("date").alias("first"), F.max("date").alias("last")).first() if before is not None else None
        behind = F.lit(known["last"] if known else None).cast("date")
        seen = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("region").isNull() | F.col("date").isNull()).alias("unkeyed"),
                        F.count_if(F.col("region").isNotNull() & (F.datediff(behind, F.col("date")) > self.late_days)).alias("late")).first()

        changed = self._note(keyed, number)
        self._move(landing, f"{self.root}/events/batch={number}")
        self._upsert("tally", self._tally_of(changed), changed)

        now = self.tally().agg(F.min("date").alias("first"), F.max("date").alias("last")).first()
        rebuilt = known is None or known["first"] != now["first"] or known["last"] > now["last"]
        if now["first"] is None:
            worked = 0
        else:
            slices = self._everything(now) if rebuilt else self._reach(changed, known, now)
            fresh = materialize(self._features_of(slices, now), "refresh-features-new")
            worked = fresh.count()
            if rebuilt:
                self._by_month(fresh).write.mode("overwrite").partitionBy("month").parquet(f"{self.root}/features")
            elif worked:
                self._upsert("features", fresh, fresh.select(*KEYS))
        return self.spark.createDataFrame([(number, seen["rows"], seen["unkeyed"], seen["late"], changed.count(), rebuilt, worked)], REPORT)

    def _note(self, keyed: DataFrame, number: int) -> DataFrame:
        """The keys that the batch can change, noted before anything else; and the ids that other batches hold too."""
        keys, events = keyed.select(*KEYS), self._events()
        own_ids = keyed.select("id").where("id IS NOT NULL").distinct()
        if events is not None:
            keys = keys.unionByName(events.where(F.col("batch") == number).select(*KEYS))
            others = materialize(events.where(F.col("batch") != number).select("id", "batch", *KEYS).join(own_ids, "id", "left_semi"), "refresh-others")
            keys = keys.unionByName(others.select(*KEYS))
            newest = others.groupBy("id").agg(F.greatest(F.max("batch"), F.lit(number)).alias("newest"))
        else:
            newest = own_ids.limit(0).withColumn("newest", F.lit(number))
        keys.distinct().write.mode("append").parquet(f"{self.root}/journal/batch={number}")
        newest.write.mode("overwrite").parquet(f"{self.root}/superseded/batch={number}")
        return materialize(self._read("journal").where(F.col("batch") == number).select(*KEYS).distinct(), "refresh-changed")

    def _tally_of(self, changed: DataFrame) -> DataFrame:
        """One row per changed key, from all events that count; 0 where none is left."""
        months = [r[0] for r in changed.select(_month()).distinct().collect()]
        events = self._events().where(F.col("month").isin(months)).join(changed, KEYS, "left_semi")
        newest = self._read("superseded").groupBy("id").agg(F.max("newest").alias("newest"))
        left = events.join(newest, "id", "left").where("newest IS NULL OR batch = newest")
        tally = daily_tally(left.drop("month", "batch", "newest"), self.params.regions)
        return changed.join(tally, KEYS, "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))

    # -- what to work out again ----------------------------------------------

    def _regions(self) -> DataFrame:
        return self.spark.createDataFrame([(r.name,) for r in self.params.regions], "region string")

    def _everything(self, now) -> DataFrame:
        return self._regions().select("region", F.lit(0).cast("long").alias("island"), F.lit(now["first"]).alias("lo"), F.lit(now["last"]).alias("hi"))

    def _reach(self, changed: DataFrame, known, now) -> DataFrame:
        """``region, island, lo, hi``: the days to work out, neighbouring stretches joined where their windows meet."""
        # The next event after each changed day: the first one among the days behind it.
        marked = self.tally().select(*KEYS, F.col("date").alias("event"), F.lit(False).alias("ask")).unionByName(
            changed.select(*KEYS, F.lit(None).cast("date").alias("event"), F.lit(True).alias("ask")))
        days = marked.groupBy(*KEYS).agg(F.max("event").alias("event"), F.max("ask").alias("ask"))
        behind = Window.partitionBy("region").orderBy("date").rowsBetween(1, Window.unboundedFollowing)
        asked = days.withColumn("next", F.first("event", ignorenulls=True).over(behind)).where("ask")
        first, last = F.lit(now["first"]), F.lit(now["last"])
        quiet = F.coalesce(F.date_sub("next", 1), last)
        stretches = asked.select("region", F.greatest(first, F.date_sub("date", self.params.horizon)).alias("lo"),
                                 F.least(last, F.greatest(F.date_add("date", BACK), quiet)).alias("hi"))
        if now["last"] > known["last"]:  # new days, and days whose label can now be seen
            opened = F.greatest(first, F.date_sub(F.lit(known["last"]), self.params.horizon - 1))
            stretches = stretches.unionByName(self._regions().select("region", opened.alias("lo"), last.alias("hi")))
        stretches = stretches.join(self._regions(), "region", "left_semi")
        order = Window.partitionBy("region").orderBy("lo", "hi")
        so_far = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
        apart = F.coalesce(F.datediff("lo", so_far) > BACK + self.params.horizon + 1, F.lit(True))
        numbered = stretches.withColumn("apart", apart).withColumn("island", F.sum(F.col("apart").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        return numbered.groupBy("region", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))

    def _features_of(self, slices: DataFrame, now) -> DataFrame:
        """Features of the slices' days, from the tally of those days and the ones their windows read."""
        part, horizon = ("region", "island"), self.params.horizon
        tally = self.tally()
        cut = materialize(slices.withColumn("begin", F.greatest(F.lit(now["first"]), F.date_sub("lo", BACK)))
                          .withColumn("end", F.least(F.lit(now["last"]), F.date_add("hi", horizon))), "refresh-slices")
        # The last event before each slice: the days since it go on counting into the slice.
        marked = tally.select(*KEYS, F.col("date").alias("event"), F.lit(None).cast("long").alias("island")).unionByName(
            cut.select("region", F.col("begin").alias("date"), F.lit(None).cast("date").alias("event"), "island"))
        days = marked.groupBy(*KEYS).agg(F.max("event").alias("event"), F.max("island").alias("island"))
        earlier = Window.partitionBy("region").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
        carried = days.withColumn("carried", F.last("event", ignorenulls=True).over(earlier)).where("island IS NOT NULL").select("region", "island", "carried")
        grid = cut.join(carried, list(part)).select("region", "island", "lo", "hi", "carried", F.explode(F.sequence("begin", "end")).alias("date"))
        filled = grid.join(tally.drop("month"), KEYS, "left")
        columns = {**window_feature_columns(horizon, part), TARGET: forward_label(horizon, part), "trend_7d": trend_column(part)}
        columns["days_since_last"] = F.coalesce(columns["days_since_last"], F.datediff("date", "carried"))
        wide = filled.select("region", "date", "lo", "hi", *[c.alias(k) for k, c in columns.items()])
        return as_feature_table(wide.where(F.col("date").between(F.col("lo"), F.col("hi"))))
