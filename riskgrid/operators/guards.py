"""Leakage guards (G1-G6 and a forward-only check) as one DataFrame of verdicts.

Each check is an aggregate over the feature table; the report is a small
``(check_id, guard, passed, detail)`` DataFrame, and ``assert_guards`` turns any
failure into an exception (the failing exit of the pipeline).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.operators.prep import fit_numeric
from riskgrid.schema import HORIZON_DAYS, ROLE_EXCLUDED, VARIANTS, role_of

REPORT_COLUMNS = ["check_id", "guard", "passed", "detail"]


def _row(cid: int, name: str, passed, detail):
    return F.struct(F.lit(cid).alias("check_id"), F.lit(name).alias("guard"),
                    passed.alias("passed"), detail.alias("detail"))


def guard_embargo(table: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    """Each block's label window ends before the next block starts."""
    d = F.col("date")
    b = table.agg(*[F.max(F.when(F.col("split") == s, d)).alias(f"{s}_max") for s in ("train", "validate")],
                  *[F.min(F.when(F.col("split") == s, d)).alias(f"{s}_min") for s in ("validate", "test")])

    def check(cid, a, z):
        ok = F.coalesce(F.date_add(F.col(f"{a}_max"), horizon) < F.col(f"{z}_min"), F.lit(False))
        det = F.concat(F.lit(f"{a}_max "), F.coalesce(F.col(f"{a}_max").cast("string"), F.lit("none")),
                       F.lit(f" + {horizon}d < {z}_min "), F.coalesce(F.col(f"{z}_min").cast("string"), F.lit("none")))
        return _row(cid, f"embargo {a} -> {z}", ok, det)
    return b.select(F.explode(F.array(check(1, "train", "validate"), check(2, "validate", "test"))).alias("r")) \
            .select("r.*")


def guard_one_split(table: DataFrame) -> DataFrame:
    """Every (region, date) is in exactly one split; an empty table fails."""
    per_key = table.groupBy("region", "date").agg(F.count_distinct("split").alias("k"))
    m = per_key.agg(F.max("k").alias("m"))
    return m.select(_row(3, "one split per (region, date)", F.coalesce(F.col("m") == 1, F.lit(False)),
                         F.concat(F.lit("max distinct splits per key = "),
                                  F.coalesce(F.col("m").cast("string"), F.lit("0")))).alias("r")).select("r.*")


def guard_forbidden(table: DataFrame, variants=VARIANTS) -> DataFrame:
    """Neither the table nor any variant holds a column whose role is excluded.

    A column of the table counts if any of its rows holds a value; a variant's input by its name.
    """
    named = {c for v in variants.values() for part in v.columns() for c in part if role_of(c) == ROLE_EXCLUDED}
    held = [c for c in table.columns if role_of(c) == ROLE_EXCLUDED]
    filled = table.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(c) for c in held])
    used = F.array_sort(F.array_distinct(F.concat(F.array(*[F.lit(c) for c in sorted(named)]).cast("array<string>"), F.array_compact(
        F.array(*[F.when(F.col(c) > 0, F.lit(c)) for c in held]).cast("array<string>")))))
    text = F.when(F.size(used) > 0, F.concat_ws(", ", used)).otherwise("none")
    return filled.select(_row(4, "leak-prone columns never used", F.size(used) == 0, F.concat(F.lit("excluded columns in use: "), text)).alias("r")).select("r.*")


def median_ranks(rows: DataFrame, column: str, value: float) -> DataFrame:
    """Whether ``value`` is the (interpolated) median of the column's non-null rows: one row, a boolean.

    Judged by ranks, not by another median: the middle rows are ``value`` itself, or it lies midway between them. Counts and
    extremes only, so no task holds the column.
    """
    x, v = F.col(column), F.lit(float(value))
    at = rows.agg(F.count(x).alias("n"), F.count_if(x < v).alias("below"), F.count_if(x == v).alias("equal"),
                  F.max(F.when(x < v, x)).alias("left"), F.min(F.when(x > v, x)).alias("right"))
    half = F.floor((F.col("n") - 1) / 2)
    in_rows = (F.col("below") <= half) & (F.col("below") + F.col("equal") > F.floor(F.col("n") / 2))
    between = (F.col("equal") == 0) & (F.col("below") * 2 == F.col("n")) & (F.abs((F.col("left") + F.col("right")) / 2 - v) < F.lit(1e-9))
    return at.select(F.coalesce((F.col("n") > 0) & (in_rows | between), F.lit(False)).alias("is_median"))


def guard_train_only(table: DataFrame, column: str = "avg_mag_7d", fitted: float | None = None) -> DataFrame:
    """The imputer's median (``fitted``; by default that of a fit on the train rows) is the train rows' median, judged by ranks."""
    train = table.filter(F.col("split") == "train")
    if fitted is None:
        fitted = fit_numeric(train, [column])[column][0]
    return median_ranks(train, column, fitted).select(
        _row(5, "preprocessing fit on train only", F.col("is_median"), F.lit(f"{column}: fitted median = train median")).alias("r")).select("r.*")


def guard_label(table: DataFrame, label: str = "label_7d") -> DataFrame:
    """The label is binary with no nulls."""
    a = table.agg(F.count_if(F.col(label).isNull()).alias("nulls"),
                  F.count_if(~F.col(label).isin(0, 1)).alias("bad"))
    return a.select(_row(6, "label is a clean binary target", (F.col("nulls") == 0) & (F.col("bad") == 0),
                         F.concat(F.lit("nulls="), F.col("nulls").cast("string"), F.lit(", non-binary="),
                                  F.col("bad").cast("string"))).alias("r")).select("r.*")


def guard_forward_only(table: DataFrame, tally: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    """Label at D re-derived from D+1..D+horizon only, and the 7-day count from D-6..D only.

    Independent of the window code: each row is expanded to its day offsets and
    equi-joined to the event tally (at most horizon + 7 rows per key).
    """
    offs = F.explode(F.sequence(F.lit(-6), F.lit(horizon))).alias("off")
    keys = table.select("region", "date", "label_7d", "quakes_7d", offs)
    probe = keys.withColumn("day", F.date_add("date", F.col("off")))
    t = tally.select("region", F.col("date").alias("day"), "n", "large")
    j = probe.join(t, ["region", "day"], "left")
    agg = j.groupBy("region", "date").agg(
        F.first("label_7d").alias("label_7d"), F.first("quakes_7d").alias("quakes_7d"),
        F.coalesce(F.sum(F.when(F.col("off") > 0, F.col("large"))), F.lit(0)).alias("fut_large"),
        F.coalesce(F.sum(F.when(F.col("off") <= 0, F.col("n"))), F.lit(0)).alias("past_n"))
    bad = agg.agg(F.count_if((F.col("label_7d") != (F.col("fut_large") >= 1).cast("int")) |
                             (F.col("quakes_7d") != F.col("past_n").cast("double"))).alias("bad"))
    return bad.select(_row(7, "label reads only D+1..D+7, features only <= D", F.col("bad") == 0,
                           F.concat(F.lit("mismatched rows = "), F.col("bad").cast("string"))).alias("r")) \
              .select("r.*")


def guard_report(table: DataFrame, tally: DataFrame | None = None) -> DataFrame:
    parts = [guard_embargo(table), guard_one_split(table), guard_forbidden(table),
             guard_train_only(table), guard_label(table)]
    if tally is not None:
        parts.append(guard_forward_only(table, tally))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def assert_guards(report: DataFrame) -> None:
    """Raise if any guard failed (the report has a handful of rows)."""
    failed = [r for r in report.collect() if not r["passed"]]
    if failed:
        raise AssertionError("leakage guards failed: " + "; ".join(f"{r['guard']} ({r['detail']})"
                                                                  for r in failed))
