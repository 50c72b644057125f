"""Equivalent DuckDB SQL for the registered queries (the correctness oracle).

The SQL is written independently of the DataFrame code; shared pieces are CTE
strings rendered from the same parameters (regions, thresholds, segments,
cutoffs) so the two sides agree on inputs, not on logic. Floating-point sums
go through the same fixed-point integers as the Spark side, so results are
equal to the last bit regardless of summation order.
"""

from __future__ import annotations

import math

from riskgrid.schema import STANDIN_REGIONS, STANDIN_SEGMENTS, STANDIN_SPLIT, SplitSpec

SCALE = "1000000.0"


def _d(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def region_values(regions=STANDIN_REGIONS) -> str:
    rows = ", ".join(f"('{r.name}', {_d(r.threshold)})" for r in regions)
    return f"regions(region, threshold) AS (VALUES {rows})"


def threshold_case(col: str = "region", regions=STANDIN_REGIONS) -> str:
    whens = " ".join(f"WHEN '{r.name}' THEN {_d(r.threshold)}" for r in regions)
    return f"(CASE {col} {whens} END)"


def segment_values(segments=STANDIN_SEGMENTS) -> str:
    rows = ", ".join(f"({s.line_id}, {s.seg_id}, {_d(s.x1)}, {_d(s.y1)}, {_d(s.x2)}, {_d(s.y2)})"
                     for s in segments)
    return f"seg(line_id, seg_id, x1, y1, x2, y2) AS (VALUES {rows})"


CATALOG = """catalog AS (
  SELECT o_orderkey AS id, r_name AS region, o_orderdate AS time, CAST(o_orderdate AS DATE) AS date,
         o_totalprice AS magnitude, c_acctbal AS depth_km,
         CAST((o_orderkey * 37) % 3600 AS DOUBLE) / 10 - 180 AS longitude,
         CAST((o_orderkey * 53) % 1800 AS DOUBLE) / 10 - 90 AS latitude,
         o_orderstatus AS type, c_mktsegment AS status
  FROM orders JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey)"""


def seg_distance(px: str, py: str) -> str:
    """Planar point-to-segment distance in degrees (same operation order as Spark)."""
    dx, dy = "(x2 - x1)", "(y2 - y1)"
    len2 = f"({dx} * {dx} + {dy} * {dy})"
    t = (f"(CASE WHEN {len2} = 0 THEN 0.0 ELSE least(1.0, greatest(0.0, "
         f"(({px} - x1) * {dx} + ({py} - y1) * {dy}) / {len2})) END)")
    cx, cy = f"(x1 + {t} * {dx})", f"(y1 + {t} * {dy})"
    return f"sqrt(({px} - {cx}) * ({px} - {cx}) + ({py} - {cy}) * ({py} - {cy}))"


def enriched(segments=STANDIN_SEGMENTS) -> str:
    return f"""{segment_values(segments)},
enriched AS (
  SELECT c.*, (SELECT min({seg_distance('c.longitude', 'c.latitude')}) FROM seg) * 111.0 AS distance_to_fault_km
  FROM catalog c)"""


def fx(col: str) -> str:
    return f"CAST(floor({col} * {SCALE} + 0.5) AS BIGINT)"


def fsum(col: str) -> str:
    return f"CAST(COALESCE(SUM({fx(col)}), 0) AS BIGINT)"


def tally(regions=STANDIN_REGIONS, source: str = "enriched") -> str:
    return f"""tally AS (
  SELECT region, date, COUNT(*) AS n,
         {fsum('magnitude')} AS mag_sum, MAX(magnitude) AS mag_max,
         COUNT(*) FILTER (WHERE COALESCE(magnitude >= {threshold_case('region', regions)}, false)) AS large,
         {fsum('depth_km')} AS depth_sum, {fsum('distance_to_fault_km')} AS dist_sum,
         {fsum('latitude')} AS lat_sum, {fsum('longitude')} AS lon_sum
  FROM {source} GROUP BY region, date)"""


def grid(regions=STANDIN_REGIONS) -> str:
    names = ", ".join(f"('{r.name}')" for r in regions)
    return f"""grid AS (
  SELECT r.region, CAST(g.d AS DATE) AS date
  FROM (VALUES {names}) r(region),
       generate_series(CAST((SELECT min(date) FROM tally) AS TIMESTAMP),
                       CAST((SELECT max(date) FROM tally) AS TIMESTAMP), INTERVAL 1 DAY) g(d)),
filled AS (SELECT g.region, g.date, t.n, t.mag_sum, t.mag_max, t.large, t.depth_sum, t.dist_sum,
                  t.lat_sum, t.lon_sum
           FROM grid g LEFT JOIN tally t ON g.region = t.region AND g.date = t.date)"""


def arc_sql(px: str, py: str, radius_km: float = 6371.0) -> str:
    """Great-circle km from (px, py) to the segment ``x1, y1, x2, y2``, by spherical trigonometry on bearings (for DuckDB)."""
    r = f"CAST({math.pi / 180!r} AS DOUBLE)"

    def part(lat1, lon1, lat2, lon2):
        """Angle by the haversine, and bearing, from the first to the second place."""
        dla, dlo = f"(({lat2}) - ({lat1})) * {r}", f"(({lon2}) - ({lon1})) * {r}"
        h = f"(pow(sin({dla} / 2), 2) + cos({lat1} * {r}) * cos({lat2} * {r}) * pow(sin({dlo} / 2), 2))"
        bearing = f"atan2(sin({dlo}) * cos({lat2} * {r}), cos({lat1} * {r}) * sin({lat2} * {r}) - sin({lat1} * {r}) * cos({lat2} * {r}) * cos({dlo}))"
        return f"(2 * asin(sqrt(least(1.0, {h}))))", bearing

    to_p, way_p = part("y1", "x1", py, px)
    to_b, way_b = part("y1", "x1", "y2", "x2")
    end, way_end = part("y2", "x2", py, px)
    _, way_back = part("y2", "x2", "y1", "x1")
    turn, turn_back = f"(({way_p}) - ({way_b}))", f"(({way_end}) - ({way_back}))"
    return (f"(CASE WHEN x1 = x2 AND y1 = y2 THEN {to_p} WHEN cos({turn}) < 0 THEN {to_p} WHEN cos({turn_back}) < 0 THEN {end} "
            f"ELSE abs(asin(greatest(-1.0, least(1.0, sin({to_p}) * sin({turn}))))) END * {radius_km!r})")


W = "PARTITION BY region ORDER BY date"


def _frame(a: int, b: int | None = None) -> str:
    if b is None:
        return f"OVER ({W} ROWS BETWEEN {a} PRECEDING AND CURRENT ROW)"
    return f"OVER ({W} ROWS BETWEEN {a} FOLLOWING AND {b} FOLLOWING)"


def _avg(col: str, days: int, count: str) -> str:
    s = f"CAST(SUM({col}) {_frame(days - 1)} AS BIGINT)"
    return f"CASE WHEN {count} <> 0 THEN CAST({s} AS DOUBLE) / CAST({count} AS DOUBLE) / {SCALE} END"


def features(horizon: int = 7) -> str:
    n7 = f"CAST(SUM(COALESCE(n, 0)) {_frame(6)} AS BIGINT)"
    n30 = f"CAST(SUM(COALESCE(n, 0)) {_frame(29)} AS BIGINT)"
    return f"""feats0 AS (
  SELECT region, date, {n7} AS n7, {n30} AS n30,
         CAST(SUM(COALESCE(large, 0)) {_frame(29)} AS BIGINT) AS l30,
         CAST(SUM(mag_sum) {_frame(6)} AS BIGINT) AS ms7,
         CAST(SUM(mag_sum) {_frame(29)} AS BIGINT) AS ms30,
         MAX(mag_max) {_frame(29)} AS mx30,
         CAST(SUM(depth_sum) {_frame(29)} AS BIGINT) AS ds30,
         CAST(SUM(dist_sum) {_frame(29)} AS BIGINT) AS fs30,
         CAST(SUM(lat_sum) {_frame(29)} AS BIGINT) AS las30,
         CAST(SUM(lon_sum) {_frame(29)} AS BIGINT) AS los30,
         date - LAST_VALUE(CASE WHEN COALESCE(n, 0) > 0 THEN date END IGNORE NULLS)
                OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS dsl,
         CASE WHEN COUNT(*) {_frame(1, horizon)} = {horizon}
              THEN CAST(SUM(COALESCE(large, 0)) {_frame(1, horizon)} >= 1 AS INTEGER) END AS label_7d
  FROM filled),
feats AS (
  SELECT date,
         CAST(n7 AS DOUBLE) AS quakes_7d, CAST(n30 AS DOUBLE) AS quakes_30d, CAST(l30 AS DOUBLE) AS large_30d,
         {_q('ms7', 'n7')} AS avg_mag_7d, {_q('ms30', 'n30')} AS avg_mag_30d,
         CAST(mx30 AS DOUBLE) AS max_mag_30d,
         {_q('ds30', 'n30')} AS avg_depth_30d, {_q('fs30', 'n30')} AS avg_dist_30d,
         {_q('las30', 'n30')} AS centroid_lat_30d, {_q('los30', 'n30')} AS centroid_lon_30d,
         CAST(n7 - LAG(n7, 7) OVER ({W}) AS DOUBLE) AS trend_7d,
         CAST(dsl AS DOUBLE) AS days_since_last,
         region, label_7d
  FROM feats0)"""


def _q(s: str, n: str) -> str:
    return f"(CASE WHEN {n} <> 0 THEN CAST({s} AS DOUBLE) / CAST({n} AS DOUBLE) / {SCALE} END)"


def split_case(col: str, spec: SplitSpec = STANDIN_SPLIT) -> str:
    d = f"CAST({col} AS DATE)"
    return (f"(CASE WHEN {d} <= DATE '{spec.train_last}' THEN 'train' "
            f"WHEN {d} >= DATE '{spec.validate_start}' AND {d} <= DATE '{spec.validate_last}' THEN 'validate' "
            f"WHEN {d} >= DATE '{spec.test_start}' THEN 'test' END)")


def feature_table_ctes() -> str:
    return f"""{CATALOG},
{enriched()},
{tally()},
{grid()},
{features()},
ft AS (
  SELECT *, {split_case('date')} AS split FROM feats
  WHERE label_7d IS NOT NULL AND {split_case('date')} IS NOT NULL)"""


def with_ft(body: str, ctes: str = "") -> str:
    extra = f",\n{ctes}" if ctes else ""
    return f"WITH {feature_table_ctes()}{extra}\n{body}"


# ---------------------------------------------------------------------------
# Scorers and metrics
# ---------------------------------------------------------------------------

EPS = 2.220446049250313e-16


def scored() -> str:
    act = "quakes_7d / (quakes_7d + CAST(10.0 AS DOUBLE))"
    keep = "split IN ('train', 'validate')"
    return f"""prior AS (SELECT AVG(CAST(label_7d AS DOUBLE)) AS p FROM ft WHERE split = 'train'),
scored AS (
  SELECT 'prior' AS run, split, region, date, label_7d AS label, p AS score,
         CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS pred
  FROM ft CROSS JOIN prior WHERE {keep}
  UNION ALL
  SELECT 'persistence', split, region, date, label_7d, large_30d, CAST(large_30d >= 1 AS INTEGER)
  FROM ft WHERE {keep}
  UNION ALL
  SELECT 'activity', split, region, date, label_7d, {act}, CAST({act} >= 0.5 AS INTEGER)
  FROM ft WHERE {keep})"""


def ap_sql(src: str, g: str) -> str:
    return f"""(SELECT {g}, CASE WHEN SUM(pos) > 0 THEN SUM(pos * (tp / seen)) / SUM(pos) END AS ap FROM (
     SELECT {g}, pos,
            SUM(pos) OVER (PARTITION BY {g} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
            SUM(n) OVER (PARTITION BY {g} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen
     FROM (SELECT {g}, score, COUNT(*) FILTER (WHERE label = 1) AS pos, COUNT(*) AS n
           FROM {src} GROUP BY {g}, score) d) c
   GROUP BY {g})"""


def confusion_sql(src: str, g: str) -> str:
    return f"""(SELECT {g}, tp, fp, fn, tn,
          CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
          CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
          CASE WHEN 2 * tp + fp + fn > 0 THEN (2 * tp) / (2 * tp + fp + fn) ELSE 0.0 END AS f1
   FROM (SELECT {g},
                COUNT(*) FILTER (WHERE label = 1 AND pred = 1) AS tp,
                COUNT(*) FILTER (WHERE label = 0 AND pred = 1) AS fp,
                COUNT(*) FILTER (WHERE label = 1 AND pred = 0) AS fn,
                COUNT(*) FILTER (WHERE label = 0 AND pred = 0) AS tn
         FROM {src} GROUP BY {g}) k)"""


def logloss_sql(src: str, g: str) -> str:
    p = f"least(CAST({1.0 - EPS!r} AS DOUBLE), greatest(CAST({EPS!r} AS DOUBLE), score))"
    return f"""(SELECT {g}, AVG(CASE WHEN label = 1 THEN -ln({p}) ELSE -ln(1.0 - {p}) END) AS log_loss
   FROM {src} GROUP BY {g})"""


def metric_rows(src: str, with_ll: bool) -> str:
    """Long metric rows (overall + per region with both classes) for one scored source."""
    names = ["ap", "f1", "precision", "recall"] + (["log_loss"] if with_ll else [])
    out = []
    for by_region in (False, True):
        g = "run, split, region" if by_region else "run, split"
        jk = "USING (run, split, region)" if by_region else "USING (run, split)"
        body = f"{ap_sql(src, g)} a JOIN {confusion_sql(src, g)} c {jk}"
        if with_ll:
            body += f" JOIN {logloss_sql(src, g)} l {jk}"
        if by_region:
            body += (f" WHERE (run, split, region) IN (SELECT run, split, region FROM {src} "
                     "GROUP BY run, split, region HAVING MIN(label) <> MAX(label))")
        reg = "region" if by_region else "CAST(NULL AS VARCHAR) AS region"
        for m in names:
            out.append(f"SELECT run, split, {reg}, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {body}")
    return "\nUNION ALL\n".join(out)


def metrics_cte() -> str:
    return f"""{scored()},
prob_scored AS (SELECT * FROM scored WHERE run IN ('prior', 'activity')),
rank_scored AS (SELECT * FROM scored WHERE run IN ('persistence')),
metrics AS (
{metric_rows('prob_scored', True)}
UNION ALL
{metric_rows('rank_scored', False)})"""


def with_metrics(body: str) -> str:
    return f"WITH {feature_table_ctes()},\n{metrics_cte()}\n{body}"
