"""Stored models: design state and MLlib model as one versioned artefact.

A version is a folder ``<root>/<name>/version=<n>`` with three tables:

* ``design``: one row per model input (medians, means, deviations; category values in order),
* ``mllib``: the MLlib model as MLlib saves it,
* ``manifest``: one row, written last. A version without it was never finished and does not count, so a
  driver or executor lost in the middle leaves nothing that a reader could pick up.

A version is never changed once its manifest is there. Loading gives the same ``FittedModel`` that was
saved: equal scores to the last bit.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid.operators.prep import output_names
from riskgrid.plans.models import FittedModel

MODEL_CLASSES = {c.__name__: c for c in (LogisticRegressionModel, RandomForestClassificationModel, GBTClassificationModel)}
DESIGN = "kind string, column string, position int, median double, mean double, deviation double, value string"
MANIFEST = ("name string, version int, created_at timestamp, model_class string, features array<string>, "
            "params map<string,string>, train_rows long, train_first date, train_last date")


def _folder(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{re.sub('[^A-Za-z0-9_.=+-]', '_', name)}"


def versions(spark: SparkSession, root: str, name: str) -> list[int]:
    """Finished versions, oldest first (a listing of the store's folders, on any Hadoop file system)."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{_folder(root, name)}/version=*/manifest/_SUCCESS")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(at) or []
    return sorted(int(re.search(r"/version=(\d+)/manifest/", f.getPath().toString()).group(1)) for f in found)


def save_model(fitted: FittedModel, train: DataFrame, root: str, created_at: dt.datetime, date_col: str = "date") -> int:
    """Write the next version; returns its number. ``created_at`` is the run's time, given by the caller."""
    spark = train.sparkSession
    have = versions(spark, root, fitted.run)
    version = have[-1] + 1 if have else 1
    path = f"{_folder(root, fitted.run)}/version={version}"
    rows = [("numeric", c, i, *map(float, fitted.stats[c]), None) for i, c in enumerate(fitted.numeric)]
    rows += [("category", c, i, None, None, None, str(v)) for c, values in fitted.categories.items() for i, v in enumerate(values)]
    # What an unfinished attempt left under this number is replaced.
    spark.createDataFrame(rows, DESIGN).coalesce(1).write.mode("overwrite").parquet(f"{path}/design")
    fitted.model.write().overwrite().save(f"{path}/mllib")
    seen = train.agg(F.count(F.lit(1)).alias("n"), F.min(date_col).alias("first"), F.max(date_col).alias("last")).first()
    row = (fitted.run, version, created_at, type(fitted.model).__name__, list(fitted.names), {k: str(v) for k, v in fitted.params.items()},
           seen["n"], seen["first"], seen["last"])
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("errorifexists").parquet(f"{path}/manifest")
    return version


def manifests(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One row per finished version."""
    have = versions(spark, root, name)
    if not have:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(*[f"{_folder(root, name)}/version={v}/manifest" for v in have])


def load_model(spark: SparkSession, root: str, name: str, version: int | None = None, as_of: dt.datetime | None = None) -> FittedModel:
    """A finished version: the given one, or the newest (created by ``as_of``, if that is given)."""
    known = manifests(spark, root, name)
    if version is not None:
        known = known.where(F.col("version") == version)
    if as_of is not None:
        known = known.where(F.col("created_at") <= F.lit(as_of))
    row = known.orderBy(F.col("version").desc()).first()
    if row is None:
        raise LookupError(f"no finished version of {name!r} under {root} (version={version}, as_of={as_of})")
    path = f"{_folder(root, name)}/version={row['version']}"
    design = spark.read.schema(DESIGN).parquet(f"{path}/design").orderBy("kind", "column", "position").collect()  # one row per model input
    numeric = sorted((r for r in design if r["kind"] == "numeric"), key=lambda r: r["position"])
    categories: dict = {}
    for r in design:
        if r["kind"] == "category":
            categories.setdefault(r["column"], []).append(r["value"])
    stats = {r["column"]: (r["median"], r["mean"], r["deviation"]) for r in numeric}
    names = output_names([r["column"] for r in numeric], categories)
    if names != list(row["features"]):
        raise ValueError(f"design of {name!r} version {row['version']} gives {names}, its model was fitted on {list(row['features'])}")
    model = MODEL_CLASSES[row["model_class"]].load(f"{path}/mllib")
    return FittedModel(name, [r["column"] for r in numeric], categories, stats, names, model, dict(row["params"]))


def forecast(fitted: FittedModel, features: DataFrame) -> DataFrame:
    """What a weekly refresh scores: the newest region-day of each region. ``region, date, score, pred``."""
    from riskgrid.operators.planned import asof_rows
    return fitted.predict(asof_rows(features), ("region", "date"))
