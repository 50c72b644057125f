"""Hard negatives for contrastive training, found through segment summaries.

Every vector is cut into segments, and each segment keeps its mean and its deviation. Over a segment
of length L, the product of two vectors is ``L * mean_a * mean_b`` plus the product of what is left of
them, which lies within ``L * dev_a * dev_b`` of zero (Cauchy-Schwarz). Summed over the segments this bounds
the score from both sides. Pairs whose bounds rule them out are dropped at the coarsest segments;
the others are looked at with segments a quarter as long, and so on; only what is left is scored exactly.

Rows are packed into chunks and anchors into blocks, each of bounded size and written once. Every anchor
meets every row: blocks are broadcast a bounded number at a time, chunks are scanned. A task keeps the
best rows per anchor over all its chunks, so what is shuffled afterwards are a few rows for each anchor
and task. The search runs twice, first over about the square root of the chunks; what that finds is the
floor which the bounds of the others must reach, and keeps their results few. Nothing is left out by it: the
results are those of scoring all pairs.

Rows with a null id, a null label, a null vector or a null or non-finite component take no part. Vectors of
unequal length meet as if the shorter one went on with zeros; empty vectors score 0. A row with the anchor's
own id is never its positive. Repeated rows are rows: they tie, and each takes its place; anchors that are
equal in id, label and vector are one anchor. Components are ``floor(scale * x)``, so scores are whole numbers;
those beyond 64 bits are cut to the largest long. An anchor without another row of its label has no positive
and no result. Empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskgrid.llm.common import materialize

#: Vectors of a chunk or block at most, and its bytes at most (a vector beyond them is a chunk of its own).
CHUNK_ROWS, CHUNK_BYTES = 1024, 4 << 20
#: Blocks of anchors broadcast at once, at most: up to 32,768 anchors and 128 MB.
BLOCKS_AT_ONCE = 32
#: Pairs whose vectors are gathered at a time.
PAIRS = 1 << 16
POSITIVES, NEGATIVES = 5, 3
#: A negative's score, in percent of the positive's.
LOW, HIGH = 50, 95
LONG_MAX = 2**63 - 1


# ---------------------------------------------------------------------------
# Packed vectors
# ---------------------------------------------------------------------------

def usable(vec: Column) -> Column:
    """No null, NaN or infinite component."""
    return F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def pack(rows: DataFrame, name: str, scale: float) -> DataFrame:
    """``id, label, vec`` -> written chunks ``chunk, n, dim, ids, labels, vectors`` of bounded size.

    Components that all fit 16 bits are kept as such, others as doubles.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, labels = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            vecs = batch.column(2)
            ends = vecs.offsets.to_numpy().astype(np.int64)
            flat = np.floor(vecs.values.to_numpy(zero_copy_only=False).astype(float) * scale)
            at = 0
            while at < len(ids):
                stop, dim = at, 0
                while stop < len(ids) and stop - at < CHUNK_ROWS:
                    wider = max(dim, int(ends[stop + 1] - ends[stop]))
                    if stop > at and (stop + 1 - at) * wider * 8 > CHUNK_BYTES:
                        break
                    dim, stop = wider, stop + 1
                m = np.zeros((stop - at, dim))
                for i in range(at, stop):
                    v = flat[ends[i]:ends[i + 1]]
                    m[i - at, :len(v)] = v
                small = m.size == 0 or np.abs(m).max() < 32768
                yield pa.RecordBatch.from_pydict({
                    "chunk": pa.array([(part << 33) + made], pa.int64()), "n": pa.array([stop - at], pa.int32()), "dim": pa.array([dim], pa.int32()),
                    "ids": pa.array([ids[at:stop].tobytes()], pa.binary()), "labels": pa.array([labels[at:stop].tobytes()], pa.binary()),
                    "vectors": pa.array([m.astype(np.int16).tobytes() if small else m.tobytes()], pa.binary())})
                at, made = stop, made + 1

    packed = rows.mapInArrow(run, "chunk long, n int, dim int, ids binary, labels binary, vectors binary")
    cores = rows.sparkSession.sparkContext.defaultParallelism
    # A table of fewer parts than cores would leave cores idle in the search.
    return materialize(packed.repartition(cores, "chunk") if rows.rdd.getNumPartitions() < cores else packed, name)


class Vectors:
    """A chunk, unpacked: ids, labels, whole-number components, and the summaries of each level."""

    def __init__(self, n: int, dim: int, ids: bytes, labels: bytes, vectors: bytes):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        kind = np.int16 if len(vectors) == 2 * n * dim else np.float64
        self.q = np.frombuffer(vectors, kind).reshape(n, dim).astype(float)
        self.largest = float(np.abs(self.q).max()) if self.q.size else 0.0
        self.levels: dict = {}

    def widen(self, dim: int) -> None:
        if dim > self.q.shape[1]:
            self.q = np.pad(self.q, ((0, 0), (0, dim - self.q.shape[1])))
            self.levels = {}

    def summaries(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Mean and deviation of each segment, both times the root of its length."""
        if length not in self.levels:
            n, dim = self.q.shape
            seg = np.pad(self.q, ((0, 0), (0, -dim % length))).reshape(n, -1, length)
            mean = seg.mean(2)
            dev = np.sqrt(((seg - mean[:, :, None]) ** 2).mean(2))
            self.levels[length] = mean * length**0.5, dev * length**0.5
        return self.levels[length]


def segment_lengths(dim: int) -> list[int]:
    """Coarse to fine: a quarter of the vector, then each a quarter of the one before, down to four components."""
    out, length = [], -(-dim // 4)
    while length >= 4:
        out.append(length)
        length = -(-length // 4)
    return out


def _bounds(mid: np.ndarray, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper), with room for rounding."""
    room = spread + 1e-9 * (np.abs(mid) + spread) + 1e-6
    return mid - room, mid + room


def exact_scores(a: Vectors, b: Vectors, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Products of the pairs ``(i, j)``: exact, in doubles where these hold them, else in whole numbers of any size."""
    if a.largest * b.largest * max(1, a.q.shape[1]) < 2**53:
        return np.einsum("pk,pk->p", a.q[i], b.q[j]).astype(np.int64)
    whole = lambda m: [[int(x) for x in r] for r in m]
    out = [sum(x * y for x, y in zip(r, s)) for r, s in zip(whole(a.q[i]), whole(b.q[j]))]
    return np.array([max(-LONG_MAX, min(LONG_MAX, v)) for v in out], np.int64)


def surviving(a: Vectors, b: Vectors, rows_a: np.ndarray, rows_b: np.ndarray, may: np.ndarray, wanted) -> Iterator[tuple]:
    """Pairs that no level of summaries rules out, with exact scores: ``(i, j, score)`` in parts of bounded size.

    ``may`` marks the pairs to look at; ``wanted(i, low, high)`` says which pairs with these bounds may count.
    """
    lengths = segment_lengths(a.q.shape[1])
    if lengths:
        (ma, da), (mb, db) = a.summaries(lengths[0]), b.summaries(lengths[0])
        low, high = _bounds(ma[rows_a] @ mb[rows_b].T, da[rows_a] @ db[rows_b].T)
        may &= wanted(rows_a[:, None], low, high)
    i, j = np.nonzero(may)
    for at in range(0, len(i), PAIRS):
        p, q = rows_a[i[at:at + PAIRS]], rows_b[j[at:at + PAIRS]]
        for length in lengths[1:]:
            (ma, da), (mb, db) = a.summaries(length), b.summaries(length)
            low, high = _bounds(np.einsum("pk,pk->p", ma[p], mb[q]), np.einsum("pk,pk->p", da[p], db[q]))
            keep = wanted(p, low, high)
            p, q = p[keep], q[keep]
        yield p, q, exact_scores(a, b, p, q)


class Best:
    """The ``k`` best (score, then smaller id) of each slot."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(slots, -np.inf)

    def offer(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        s, v, d = np.concatenate([self.slot, slot]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((d, -v, s))
        s, v, d = s[order], v[order], d[order]
        first = np.searchsorted(s, s)
        rank = np.arange(len(s)) - first
        keep = rank < self.k
        last = rank == self.k - 1
        self.floor[s[last]] = np.maximum(self.floor[s[last]], v[last])
        self.slot, self.score, self.id = s[keep], v[keep], d[keep]


# ---------------------------------------------------------------------------
# The two searches
# ---------------------------------------------------------------------------

class PositiveSearch:
    """The best other rows of the anchor's label. ``info`` holds a floor for each anchor."""

    def __init__(self, block: Vectors, info: list):
        self.block, self.best = block, Best(len(block.ids), POSITIVES)
        for at, floor in info:
            if floor is not None:
                self.best.floor[at] = floor

    def meet(self, rows: Vectors) -> None:
        a = self.block
        for label in np.intersect1d(a.labels, rows.labels):
            p, q = np.flatnonzero(a.labels == label), np.flatnonzero(rows.labels == label)
            may = a.ids[p][:, None] != rows.ids[q][None, :]
            wanted = lambda i, low, high: high >= self.best.floor[i]
            for i, j, score in surviving(a, rows, p, q, may, wanted):
                good = score >= self.best.floor[i]
                self.best.offer(i[good], score[good], rows.ids[j[good]])


class NegativeSearch:
    """The best rows of other labels in the window of each positive. ``info`` holds (place, positive's number, its score, floor)."""

    def __init__(self, block: Vectors, info: list):
        n = len(block.ids)
        self.block, self.best = block, Best(n * POSITIVES, NEGATIVES)
        self.low, self.high = np.full((n, POSITIVES), np.inf), np.full((n, POSITIVES), -np.inf)
        for at, r, score, floor in info:
            # 100 * s >= LOW * p and 100 * s <= HIGH * p, in whole numbers
            self.low[at, r], self.high[at, r] = -((-LOW * score) // 100), (HIGH * score) // 100
            if floor is not None:
                self.best.floor[at * POSITIVES + r] = floor
        self.exact = {(at, r): (-((-LOW * s) // 100), (HIGH * s) // 100) for at, r, s, _ in info if abs(s) >= 2**53}

    def meet(self, rows: Vectors) -> None:
        a = self.block

        def wanted(i, low, high):
            out = np.zeros(np.broadcast_shapes(i.shape, low.shape), bool)
            for r in range(POSITIVES):
                out |= (high >= np.maximum(self.low[i, r], self.best.floor[i * POSITIVES + r])) & (low <= self.high[i, r])
            return out

        p = np.flatnonzero(np.isfinite(self.low).any(1) & (self.low <= self.high).any(1))
        if not len(p):
            return
        q = np.arange(len(rows.ids))
        for i, j, score in surviving(a, rows, p, q, a.labels[p][:, None] != rows.labels[None, :], wanted):
            for r in range(POSITIVES):
                inside = (score >= self.low[i, r]) & (score <= self.high[i, r])
                if self.exact:  # windows that doubles do not hold
                    for k in range(len(i)):
                        if (int(i[k]), r) in self.exact:
                            lo, hi = self.exact[int(i[k]), r]
                            inside[k] = lo <= int(score[k]) <= hi
                slot = i * POSITIVES + r
                inside &= score >= self.best.floor[slot]
                self.best.offer(slot[inside], score[inside], rows.ids[j[inside]])


CHUNK = ("n", "dim", "ids", "labels", "vectors")


def search(chunks: DataFrame, blocks: DataFrame, info: DataFrame, kind: type) -> DataFrame:
    """Every block meets every chunk: ``block, slot, score, id``, the best of each task.

    ``blocks`` are at most ``BLOCKS_AT_ONCE``; ``info`` holds the block, the anchor's place and the other fields ``kind`` asks for.
    """
    held = info.groupBy("block").agg(F.collect_list(F.struct(*[c for c in info.columns if c != "block"])).alias("info"))  # bounded by a block's anchors
    some = blocks.join(held, "block").select("block", *[F.col(c).alias(f"a_{c}") for c in CHUNK], "info")
    size = len(CHUNK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        last, rows = None, None
        for batch in batches:
            for c in range(batch.num_rows):
                at = [batch.column(0)[c].as_py(), batch.column(1 + size)[c].as_py()]
                if at[0] != last:
                    last, rows = at[0], Vectors(*[batch.column(1 + k)[c].as_py() for k in range(size)])
                if at[1] not in known:
                    known[at[1]] = kind(Vectors(*[batch.column(2 + size + k)[c].as_py() for k in range(size)]),
                                        [tuple(x.values()) for x in batch.column(2 + 2 * size)[c].as_py()])
                found = known[at[1]]
                dim = max(rows.q.shape[1], found.block.q.shape[1])
                rows.widen(dim)
                found.block.widen(dim)
                found.meet(rows)
        for block, found in known.items():
            b = found.best
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b.slot), block, np.int64)), pa.array(b.slot), pa.array(b.score), pa.array(b.id)],
                                             names=["block", "slot", "score", "id"])

    # The blocks are the stated query set: each meets every chunk of rows.
    return chunks.select("chunk", *CHUNK).crossJoin(F.broadcast(some)).mapInArrow(run, "block long, slot long, score long, id long")


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each slot over all tasks, ranked from 1."""
    order = Window.partitionBy("block", "slot").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def twice(chunks: DataFrame, n_chunks: int, blocks: DataFrame, info: DataFrame, kind: type, k: int, name: str) -> DataFrame:
    """The ``k`` best of each slot over all chunks: some root of the chunks first, then the others above the floors found.

    ``info`` has a column ``slot`` that numbers the slots of ``kind``, and a ``floor`` as its last.
    """
    seed = F.pmod(F.xxhash64("chunk"), F.lit(max(1, round(n_chunks**0.5)))) == 0
    given = [c for c in info.columns if c != "slot"]
    first = materialize(best_of(search(chunks.where(seed), blocks, info.select(given), kind), k), f"{name}-seed")
    floors = first.where(F.col("rank") == k).select("block", "slot", F.col("score").alias("reached"))
    raised = info.join(floors, ["block", "slot"], "left").withColumn("floor", F.col("reached")).select(given)
    rest = search(chunks.where(~seed), blocks, raised, kind)
    return materialize(best_of(first.drop("rank").unionByName(rest), k), name)


def places(blocks: DataFrame) -> DataFrame:
    """``block, at, anchor_id`` of every packed anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(ids, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), block, np.int64)), pa.array(np.arange(len(ids))), pa.array(ids)],
                                                 names=["block", "at", "anchor_id"])

    return blocks.select("block", "ids").mapInArrow(run, "block long, at long, anchor_id long")


def mine(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding",
         scale: float = 256.0) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` says which rows are anchors, over the columns ``id`` and ``label``. The positives of an anchor
    are its ``POSITIVES`` best other rows of its label; for each, the ``NEGATIVES`` best rows of other labels that score
    between ``LOW`` and ``HIGH`` percent of it follow.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & usable(F.col("vec")))
    chunks = pack(rows, "negatives-rows", scale)
    n_chunks = chunks.count()
    chosen = materialize(rows.where(anchors).dropDuplicates(["id", "label", "vec"]), "negatives-anchors")
    parts = -(-chosen.count() // (BLOCKS_AT_ONCE * CHUNK_ROWS))
    blocks = pack(chosen.repartition(max(1, parts), "id"), "negatives-blocks", scale).withColumnRenamed("chunk", "block")
    number = blocks.select("block").withColumn("no", F.row_number().over(Window.orderBy("block")) - 1)  # one short row for each block
    blocks = materialize(blocks.join(number, "block").withColumn("turn", F.floor(F.col("no") / BLOCKS_AT_ONCE)), "negatives-numbered")
    turns = blocks.agg(F.max("turn")).first()[0]
    out = [mine_blocks(chunks, n_chunks, blocks.where(F.col("turn") == t)) for t in range(0 if turns is None else turns + 1)]
    if not out:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    whole = out[0]
    for o in out[1:]:
        whole = whole.unionByName(o)
    return whole


def mine_blocks(chunks: DataFrame, n_chunks: int, blocks: DataFrame) -> DataFrame:
    """The results of some blocks of anchors (at most ``BLOCKS_AT_ONCE``)."""
    own = materialize(places(blocks), "negatives-places")
    info = own.select("block", F.col("at").alias("slot"), "at", F.lit(None).cast("long").alias("floor"))
    positives = twice(chunks, n_chunks, blocks, info, PositiveSearch, POSITIVES, "negatives-positives")
    positives = positives.select("block", F.col("slot").alias("at"), (F.col("rank") - 1).alias("r"), F.col("score").alias("positive_score"), F.col("id").alias("positive_id"))
    slot = (F.col("at") * POSITIVES + F.col("r")).alias("slot")
    info = positives.select("block", slot, "at", "r", "positive_score", F.lit(None).cast("long").alias("floor"))
    found = twice(chunks, n_chunks, blocks, info, NegativeSearch, NEGATIVES, "negatives-found")
    whose = positives.join(own, ["block", "at"]).select("block", slot, "anchor_id", "positive_id", "positive_score")
    return found.join(whose, ["block", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


# ---------------------------------------------------------------------------
# Oracle
# ---------------------------------------------------------------------------

def sql() -> str:
    """All pairs, for DuckDB."""
    return f"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.q, b.q)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES}),
ranked AS (
  SELECT p.anchor_id, p.positive_id, n.other_id AS negative_id, p.positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS rank
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND {LOW} * p.positive_score <= 100 * n.score AND 100 * n.score <= {HIGH} * p.positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= {NEGATIVES}"""
