"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

Group g holds n_g of N documents and shall hold the share w_g of the mix, so each of its
documents is repeated a Poisson number of times with mean rate w_g * total / n_g. The number is
the inverse of that distribution at a uniform value hashed from the seed and the id: the same
on every run, and independent of partitioning. A mean above ``PART_RATE`` is split into equal parts,
each drawn with a hash of its own: sums of Poisson numbers are Poisson, and no table of the distribution
grows with the rate. Each copy then gets its own hash, by which all copies are dealt out and sorted:
a global shuffle.

A null group is a group of its own; a null id is hashed by its text. Rows that repeat an id repeat
its count. Without weights all groups weigh the same. Groups with no weight, or without documents,
give no rows. Extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 42
BITS = 52
#: A larger mean rate is drawn in parts of at most so much.
PART_RATE = 64.0
#: Copies of one document are exploded in blocks of so many.
BLOCK = 1024
#: Tables of so many groups are broadcast (about 1 kB each); more are joined by shuffle, in salted parts.
BROADCAST_GROUPS = 20_000
SALTS = 64


def _unit(*parts: Column) -> Column:
    """A uniform value in (0, 1) on a grid of 2^52 points, from the MD5 of the parts."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, BITS // 4)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**BITS))


def _cdf(rate: Column) -> Column:
    """Poisson probabilities of at most 0, 1, 2, ... copies, up to where the rest is below the grid."""
    top = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    start = F.struct((-rate).alias("log_p"), F.array(F.exp(-rate)).alias("cdf"))
    step = lambda a, k: F.struct(
        (a["log_p"] + F.log(rate / k)).alias("log_p"),
        F.concat(a["cdf"], F.array(F.element_at(a["cdf"], -1) + F.exp(a["log_p"] + F.log(rate / k)))).alias("cdf"))
    return F.aggregate(F.sequence(F.lit(1), top), start, step)["cdf"]


def group_rates(docs: DataFrame, group_col: str = "source", weights: dict[str, float] | None = None,
                total: int | None = None) -> DataFrame:
    """Per group: its size, its mean repetition rate, the parts it is drawn in and the cumulative distribution of one part."""
    sizes = docs.groupBy(F.col(group_col).cast("string").alias("__group")).agg(F.count("*").alias("__n"))
    if weights is None:
        weighted = sizes.withColumn("__w", F.lit(1.0))
    else:
        pairs = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
        weighted = sizes.withColumn("__w", F.coalesce(F.create_map(*pairs)[F.col("__group")], F.lit(0.0)))
    sums = weighted.agg(F.sum("__w").alias("w"), F.sum("__n").alias("n")).first()
    mass, rows = float(sums["w"] or 0), total if total is not None else int(sums["n"] or 0)
    rate = F.col("__w") * F.lit(float(rows)) / (F.lit(mass or 1.0) * F.col("__n"))
    rated = weighted.withColumn("__rate", rate).where("__rate > 0").withColumn("__parts", F.ceil(F.col("__rate") / PART_RATE))
    return rated.withColumn("__cdf", _cdf(F.col("__rate") / F.col("__parts")))


def mix(docs: DataFrame, group_col: str = "source", weights: dict[str, float] | None = None, total: int | None = None,
        seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``' columns, then ``copy`` (from 1) and ``shuffle_key``, dealt out and sorted by that key."""
    rates = group_rates(docs, group_col, weights, total)
    groups = rates.count()
    ident = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), ident.alias("__id"),
                       F.col(group_col).cast("string").alias("__group"))
    if groups <= BROADCAST_GROUPS:
        rated = rows.join(F.broadcast(rates), rows["__group"].eqNullSafe(rates["__group"]))
    else:  # a hot group is dealt over the salts
        salted = rows.withColumn("__salt", F.pmod(F.xxhash64("__id"), F.lit(SALTS)))
        spread = rates.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        rated = salted.join(spread, salted["__group"].eqNullSafe(spread["__group"]) & (salted["__salt"] == spread["__salt"]))
    drawn = F.transform(F.sequence(F.lit(0).cast("long"), F.col("__parts") - 1), lambda d: _unit(
        F.concat(F.lit(f"{seed}|count"), F.when(d > 0, F.concat(F.lit("."), d.cast("string"))).otherwise("")), F.col("__id")))
    count = F.aggregate(drawn, F.lit(0), lambda n, u: n + F.size(F.filter("__cdf", lambda c: c < u)))
    counted = rated.select("row", "__id", count.alias("__count")).where("__count > 0")
    blocks = counted.select("row", "__id", "__count", F.explode(F.sequence(F.lit(1), F.col("__count"), F.lit(BLOCK))).alias("__first"))
    last = F.least(F.col("__count"), F.col("__first") + (BLOCK - 1))
    copies = blocks.select("row", "__id", F.explode(F.sequence(F.col("__first"), last)).alias("copy"))
    keyed = copies.select("row", "copy", F.md5(F.concat_ws("|", F.lit(f"{seed}|order"), F.col("__id"), F.col("copy").cast("string")).cast("binary")).alias("shuffle_key"))
    dealt = keyed.repartition(F.col("shuffle_key")).sortWithinPartitions("shuffle_key", "copy")
    extra = [c for c in ("copy", "shuffle_key")]
    kept = [c for c in docs.columns if c not in extra]
    return dealt.select(*[F.col("row")[c].alias(c) for c in kept], *extra)


def sql(group_col: str = "source", seed: int = SEED) -> str:
    """DuckDB SQL for ``mix`` with equal weights over ``documents``."""
    hexa = "CAST(('0x' || substr(md5({0}), 1, 13)) AS BIGINT)"
    return f"""
WITH g AS (SELECT {group_col} AS grp, count(*) AS n FROM documents GROUP BY ALL),
r AS (SELECT grp, (SELECT CAST(sum(n) AS DOUBLE) FROM g) / ((SELECT CAST(count(*) AS DOUBLE) FROM g) * n) AS rate FROM g),
m AS (SELECT grp, CAST(ceil(rate / {PART_RATE}) AS BIGINT) AS parts, rate / ceil(rate / {PART_RATE}) AS rate FROM r),
k AS (SELECT grp, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 40) AS BIGINT) + 1)) AS k FROM m),
p AS (SELECT grp, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY grp ORDER BY k) AS cdf FROM k),
d AS (SELECT *, coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, ''))) AS ident, row_number() OVER () AS line FROM documents),
t AS (SELECT d.line, d.ident, d.{group_col} AS grp, unnest(range(parts)) AS part FROM d JOIN m ON m.grp IS NOT DISTINCT FROM d.{group_col}),
u AS (SELECT line, grp, (CAST({hexa.format(f"'{seed}|count' || CASE WHEN part > 0 THEN '.' || CAST(part AS VARCHAR) ELSE '' END || '|' || ident")} AS DOUBLE) + 0.5) / {float(2**BITS)!r} AS u FROM t),
n AS (SELECT line, CAST(sum((SELECT count(*) FROM p WHERE p.grp IS NOT DISTINCT FROM u.grp AND p.cdf < u.u)) AS BIGINT) AS n FROM u GROUP BY line),
c AS (SELECT * FROM d JOIN n USING (line)),
x AS (SELECT c.*, unnest(range(1, n + 1)) AS copy FROM c WHERE n > 0)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INT) AS copy,
       md5('{seed}|order|' || ident || '|' || CAST(copy AS VARCHAR)) AS shuffle_key
FROM x
"""
