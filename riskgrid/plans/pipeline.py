"""End-to-end steps with file inputs and outputs (the reference's script sequence).

    python -m riskgrid.plans.pipeline ingest    --src landed/ --out raw/
    python -m riskgrid.plans.pipeline clean     --raw raw/ --out clean/ --segments lines.json
    python -m riskgrid.plans.pipeline features  --clean clean/ --out features/
    python -m riskgrid.plans.pipeline check     --features features/
    python -m riskgrid.plans.pipeline train     --features features/ --runs runs/ [--models models/] [--variants base depth] [--run-id id]
    python -m riskgrid.plans.pipeline forecast  --clean clean/ --models models/ --out forecast/ [--model logreg_depth]

Each step reads Parquet (or landed JSON) and overwrites its output, laid out by region and sorted by time/date; all paths
are Spark's, so they may lie in any store it reads. Beside its output a step leaves what it checked: ``raw-audit`` (events
per region and year, and whether a year reaches the page limit), ``clean-report`` (rows before, removed, after) and
``features-tally`` (the day tallies, which ``check`` needs). Rows written are counted again from the files, and a
difference stops the step. Parameters default to the reference's regions, thresholds and cutoffs (``schema.REFERENCE_*``).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid.functions.geo import in_box
from riskgrid.operators.clean import clean, clean_report
from riskgrid.operators.grid import daily_grid, daily_tally, gap_filled_tally
from riskgrid.operators.guards import assert_guards, guard_report
from riskgrid.operators.spatial import add_distance_to_fault, segments_from_lines
from riskgrid.operators.split import assign_split, drop_unobservable
from riskgrid.operators.windows import as_feature_table, window_features
from riskgrid.schema import MIN_MAGNITUDE, PARITY_VARIANTS, REFERENCE_REGIONS, REFERENCE_SPLIT, PipelineParams
from riskgrid.session import materialize
from riskgrid.sources.ingest import check_sources, chunk_audit, load_verify, read_features, write_by_region


def reference_params(segments=()) -> PipelineParams:
    return PipelineParams(regions=list(REFERENCE_REGIONS), split=REFERENCE_SPLIT, segments=list(segments))


def beside(path: str, what: str) -> str:
    return f"{path.rstrip('/')}-{what}"


def requested(events: DataFrame, regions, floor: float = MIN_MAGNITUDE) -> DataFrame:
    """What a request for each region would return: events inside its box, at or above the magnitude floor."""
    own = F.lit(False)
    for r in regions:
        own = own | ((F.col("region") == r.name) & in_box(F.col("latitude"), F.col("longitude"), r.min_lat, r.max_lat, r.min_lon, r.max_lon))
    return events.where(own & (F.col("magnitude") >= floor))


def write_verified(df: DataFrame, out: str, time_col: str = "time") -> DataFrame:
    """``write_by_region``, then the rows of every region are counted again from the files."""
    df = materialize(df, "to-write")
    write_by_region(df, out, time_col=time_col)
    back = df.sparkSession.read.schema(df.schema).parquet(out)
    want, got = ({r["region"]: r["n"] for r in load_verify(x).collect()} for x in (df, back))  # a row per region
    if want != got:
        raise RuntimeError(f"{out}: rows by region written {want}, found {got}")
    return back


def ingest(spark: SparkSession, src: str, out: str, regions=REFERENCE_REGIONS) -> DataFrame:
    """Landed feature collections (``region=<name>/*.json``) -> raw catalog, and its audit."""
    raw = write_verified(requested(read_features(spark, src), regions), out)
    check_sources(raw, [r.name for r in regions])
    chunk_audit(raw).write.mode("overwrite").parquet(beside(out, "audit"))
    return raw


def load_segments(spark: SparkSession, path: str | None):
    """Boundary polylines from a GeoJSON file, read by Spark (only ``features[].geometry`` is used)."""
    if not path:
        raise ValueError("a boundary map is needed: without one every distance would count as 0 km")
    lines = []
    for doc in spark.read.text(path, wholetext=True).collect():  # the map: one document, or a few
        for feat in json.loads(doc["value"]).get("features", []):
            g = feat.get("geometry") or {}
            if g.get("type") == "LineString":
                lines.append(g["coordinates"])
            elif g.get("type") == "MultiLineString":
                lines.extend(g["coordinates"])
            elif g:
                raise ValueError(f"boundary geometry {g.get('type')!r} is not a line")
    return segments_from_lines(lines)


def clean_and_enrich(spark: SparkSession, raw: str, out: str, segments, regions=REFERENCE_REGIONS) -> DataFrame:
    """Every region must be there; keep earthquakes, lower-case status, add distance to the nearest boundary."""
    source = spark.read.parquet(raw)
    check_sources(source, [r.name for r in regions])
    clean_report(source).write.mode("overwrite").parquet(beside(out, "report"))
    df = clean(source)
    df = add_distance_to_fault(df, segments) if segments else \
        df.withColumn("distance_to_fault_km", F.lit(None).cast("double"))
    return write_verified(df, out)


def region_day_features(spark: SparkSession, clean_path: str, params: PipelineParams) -> tuple[DataFrame, DataFrame]:
    """(features of every region-day, with a nullable label; the tally they come from)."""
    cat = spark.read.parquet(clean_path).withColumn("date", F.to_date("time"))
    tally = materialize(daily_tally(cat, params.regions), "daily_tally")
    return window_features(gap_filled_tally(daily_grid(spark, tally, params.regions), tally), params.horizon), tally


def build_features(spark: SparkSession, clean_path: str, out: str, params: PipelineParams) -> DataFrame:
    """A1 + J2/J3 + W1-W8 + P1/P2: the region-day feature table, and the tally beside it."""
    feats, tally = region_day_features(spark, clean_path, params)
    tally.write.mode("overwrite").parquet(beside(out, "tally"))
    return write_verified(as_feature_table(assign_split(drop_unobservable(feats), params.split, "date")), out, time_col="date")


def check(spark: SparkSession, features: str) -> DataFrame:
    """G1-G6 and the forward-only guard: raise if any fails; return the report."""
    report = guard_report(spark.read.parquet(features), spark.read.parquet(beside(features, "tally")))
    assert_guards(report)
    return report


def train(spark: SparkSession, features: str, runs: str, variants=PARITY_VARIANTS, models: str | None = None,
          run_id: str | None = None, now: dt.datetime | None = None) -> DataFrame:
    """M9 + E10 + X4: fit each variant on train, score train + validate, append this run to the log, store the models."""
    from riskgrid.operators.metrics import leaderboard
    from riskgrid.plans import models as M
    from riskgrid.plans.model_store import save_model
    table, now = spark.read.parquet(features), now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    scored, fitted = M.ablation(table, variants)
    metrics = materialize(M.evaluate(materialize(scored, "scores")), "metrics")
    M.append_runs(M.run_log(metrics, fitted), runs, run_id or uuid.uuid4().hex, now)
    for m in fitted if models else ():
        save_model(m, table.where("split = 'train'"), models, now)
    regions = [r[0] for r in table.select("region").distinct().orderBy("region").collect()]
    return leaderboard(metrics, regions)


def forecast(spark: SparkSession, clean_path: str, models: str, out: str, model: str = "logreg_depth", params: PipelineParams | None = None) -> DataFrame:
    """The newest region-day of every region, scored by the newest stored model."""
    from riskgrid.plans import model_store
    feats, _ = region_day_features(spark, clean_path, params or reference_params())
    scored = model_store.forecast(model_store.load_model(spark, models, model), as_feature_table(feats))
    scored.write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def main(argv=None) -> None:
    from riskgrid.session import get_spark
    ap = argparse.ArgumentParser(prog="riskgrid")
    sub = ap.add_subparsers(dest="step", required=True)
    for name, args in {"ingest": ["src", "out"], "clean": ["raw", "out", "segments?"],
                       "features": ["clean", "out"], "check": ["features"],
                       "train": ["features", "runs", "models?", "run-id?", "variants*"],
                       "forecast": ["clean", "models", "out", "model?"]}.items():
        p = sub.add_parser(name)
        for a in args:
            if a.endswith("?"):
                p.add_argument(f"--{a[:-1]}", default=None)
            elif a.endswith("*"):
                p.add_argument(f"--{a[:-1]}", nargs="*", default=list(PARITY_VARIANTS))
            else:
                p.add_argument(f"--{a}", required=True)
    ns = ap.parse_args(argv)
    spark = get_spark()
    if ns.step == "ingest":
        ingest(spark, ns.src, ns.out)
    elif ns.step == "clean":
        clean_and_enrich(spark, ns.raw, ns.out, load_segments(spark, ns.segments))
    elif ns.step == "features":
        build_features(spark, ns.clean, ns.out, reference_params())
    elif ns.step == "check":
        check(spark, ns.features).show(truncate=False)
    elif ns.step == "train":
        train(spark, ns.features, ns.runs, ns.variants, ns.models, ns.run_id).show(truncate=False)
    elif ns.step == "forecast":
        forecast(spark, ns.clean, ns.models, ns.out, ns.model or "logreg_depth").show(truncate=False)


if __name__ == "__main__":
    main()
