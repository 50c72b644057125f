"""Exact substring dedup with enhanced suffix arrays over content-defined segments.

Texts are UTF-8 bytes. Every window of ``length`` bytes belongs to the segment that is named by
the smallest hash of the window's ``GRAM``-byte grams: equal windows, wherever they start, meet under
one name. A segment holds the bytes of a run of windows with one name (at most ``RUN``).

1. Scan: one compact row per segment (place, name, hash of its bytes), no text.
2. Names that occur once end here, unless a window may repeat inside their segment. Where all segments of a name are equal, all of their bytes are
   repeated. The other names are mixed: each of their distinct segments is fetched once.
3. Mixed segments are dealt by name into bundles of bounded size. A bundle gets one suffix array
   with longest common prefixes; a stack scan lists the intervals of its prefix tree of ``length``
   or more bytes. An interval whose occurrences are preceded by different bytes (or begin a
   segment) is a maximal repeat, with all its occurrences; the others are part of a longer one.
   A name too large for a bundle is dealt by whole windows instead, counted after combining.
4. The repeated bytes of a segment hold at all its places; runs are joined document by document.

Copies are counted before anything is fetched, so a text held by a third of all rows is one set of
segments. Nulls and texts shorter than ``length`` bytes have nothing to remove (null: empty). Repeated rows
are copies of each other, so all their windows are repeated. Null ids pass through. Extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgrid.llm.common import KEY, arrow_map, empty_text, few, key_columns, key_match, materialize

LENGTH = 200
GRAM = 32
RUN = 256
#: Bytes of distinct segments in one suffix array, about.
BUNDLE = 1_500_000
#: Of the texts that a join moves.
CODEC = "zstd"

_TABLE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all GRAM-byte grams, doubling the length each time."""
    h, size = _TABLE[data], 1
    while size < GRAM:
        h = h[:-size] * _ODD + (h[size:] ^ (h[size:] >> np.uint64(31)))
        size *= 2
    return (h ^ (h >> np.uint64(29))) * _ODD


def _running_min(h: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[:len(h) - (width - size)], h[width - size:]) if width > size else h


def segments(data: bytes, length: int = LENGTH) -> list[tuple[int, int, int, int, bool]]:
    """(start, windows, name, hash of the bytes, whether windows may repeat inside) of the segments of one text.

    Two equal windows of one segment hold its gram at one offset, so the first one's leftmost gram is
    left behind between them: a window begins with the gram, and the next still has the name.
    """
    if len(data) < length:
        return []
    grams = _gram_hashes(np.frombuffer(data, np.uint8))
    names = _running_min(grams, length - GRAM + 1)
    cut = np.flatnonzero(names[1:] != names[:-1]) + 1
    starts = np.concatenate([[0], cut])
    sizes = np.diff(np.append(starts, len(names)))
    if sizes.max() > RUN:
        starts = np.concatenate([np.arange(s, s + n, RUN) for s, n in zip(starts, sizes)])
        sizes = np.diff(np.append(starts, len(names)))
    again = np.append((grams[:len(names) - 1] == names[:-1]) & (names[1:] == names[:-1]), False)
    inside = np.add.reduceat(again.astype(np.int64), starts) > 0
    return [(s, n, m, xxhash.xxh3_64_intdigest(data[s:s + n + length - 1]) - 2**63, a)
            for s, n, m, a in zip(starts.tolist(), sizes.tolist(), names[starts].view(np.int64).tolist(), inside.tolist())]


def segment_table(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                found = segments((text or "").encode(), length)
                rows += found
                at += [i] * len(found)
            take = pa.array(at, pa.int32())
            start, size, name, digest, again = zip(*rows) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(start, pa.int32()), pa.array(size, pa.int32()),
                 pa.array(name, pa.int64()), pa.array(digest, pa.int64()), pa.array(again, pa.bool_())],
                names=[*KEY, "start", "windows", "name", "digest", "again"])

    return arrow_map(docs.select(*key_columns(id_col, text_col), F.col(text_col).cast("string").alias("text")), run,
                     f"{KEY[0]} {id_type}, {KEY[1]} long, start int, windows int, name long, digest long, again boolean")


class SuffixArray:
    """Suffixes of several byte strings, sorted by prefix doubling; common prefixes end with their string."""

    def __init__(self, strings: list[bytes], starts: list[int]):
        """``starts``: how many suffixes of each string take part, from its beginning."""
        size = np.array([len(s) for s in strings], np.int64)
        self.begin = np.cumsum(size + 1) - size - 1
        data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int64) + 1
        data[self.begin + size] = 0  # behind each string
        self.data, n = data, len(data)
        self.left = np.concatenate([[0], data[:-1]])
        end = np.repeat(self.begin + size, size + 1)
        self.room = end - np.arange(n)
        # Ranks of prefixes of 7, 14, 28, ... symbols; nine bits each fill the first word.
        word = np.zeros(n, np.int64)
        for k in range(7):
            word = (word << 9) | np.where(self.room > k, np.append(data[k:], np.zeros(min(k, n), np.int64)), 0)
        self.levels, self.span = [self._ranks(word)], [7]
        deepest = int(size.max(initial=0))
        while self.span[-1] * 2 <= deepest:
            s, rank = self.span[-1], self.levels[-1]
            self.levels.append(self._ranks(rank * np.int64(n + 1) + self._shifted(rank, s)))
            self.span.append(2 * s)
        s, rank = self.span[-1], self.levels[-1]
        part = np.concatenate([np.arange(b, b + k) for b, k in zip(self.begin, starts)]) if strings else np.empty(0, np.int64)
        key = rank[part] * np.int64(n + 1) + self._shifted(rank, s)[part]
        self.order = part[np.argsort(key, kind="stable")]
        self.lcp = self._common(self.order[:-1], self.order[1:])

    def _shifted(self, rank: np.ndarray, by: int) -> np.ndarray:
        """Rank (from 1) of what stands ``by`` further in the same string; 0 behind its end."""
        out = np.zeros(len(rank), np.int64)
        out[:max(0, len(rank) - by)] = rank[by:] + 1
        out[self.room <= by] = 0
        return out

    @staticmethod
    def _ranks(key: np.ndarray) -> np.ndarray:
        order = np.argsort(key)
        new = np.concatenate([[0], key[order][1:] != key[order][:-1]]).astype(np.int64)
        out = np.empty(len(key), np.int64)
        out[order] = np.cumsum(new)
        return out

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of each pair of suffixes."""
        out = np.zeros(len(a), np.int64)
        most = np.minimum(self.room[a], self.room[b])
        for rank, s in [*zip(self.levels[::-1], self.span[::-1])] + [(self.data, 1)] * 6:
            at_a, at_b = np.minimum(a + out, len(rank) - 1), np.minimum(b + out, len(rank) - 1)
            out += np.where((out + s <= most) & (rank[at_a] == rank[at_b]), s, 0)
        return out

    def maximal_repeats(self, least: int) -> Iterator[tuple[int, np.ndarray]]:
        """(length, all places) of the repeats of ``least`` bytes or more that no byte to the left prolongs."""
        lcp, order = self.lcp, self.order
        before = self.left[order]
        # Where the byte before differs from the neighbour's, or a string begins, an interval is diverse.
        differs = np.concatenate([[0], np.cumsum((before[1:] != before[:-1]) | (before[1:] == 0))])
        deep = lcp >= least
        edge = np.flatnonzero(np.diff(np.concatenate([[0], deep.view(np.int8), [0]])))
        for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist()):
            # Suffixes lo..hi share ``least`` bytes. The stack holds the open intervals: (length, first suffix).
            stack: list[tuple[int, int]] = []
            for i, depth in enumerate([*lcp[lo:hi].tolist(), 0], lo):
                first = i
                while stack and stack[-1][0] > depth:
                    size, first = stack.pop()
                    if differs[i] > differs[first]:
                        yield size, order[first:i + 1]
                if depth and (not stack or stack[-1][0] < depth):
                    stack.append((depth, first))


def repeated_bytes(strings: list[bytes], counts: list[int], length: int) -> list[list[tuple[int, int]]]:
    """Per string, its runs of bytes that a maximal repeat of ``length`` or more covers. ``counts``: copies of each string."""
    array = SuffixArray(strings, [len(s) - length + 1 for s in strings])
    change = np.zeros(len(array.data) + 1, np.int64)
    for size, places in array.maximal_repeats(length):
        np.add.at(change, places, 1)
        np.add.at(change, places + size, -1)
    for b, s, c in zip(array.begin, strings, counts):
        if c > 1:
            change[b] += 1
            change[b + len(s)] -= 1
    covered = (np.cumsum(change) > 0).astype(np.int8)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered])))
    lows, highs = edges[::2], edges[1::2]
    out = []
    first, last = np.searchsorted(lows, array.begin), np.searchsorted(lows, array.begin + [len(s) for s in strings])
    for b, i, j in zip(array.begin.tolist(), first.tolist(), last.tolist()):
        out.append([(int(lo) - b, int(hi) - b) for lo, hi in zip(lows[i:j], highs[i:j])])
    return out


SPANS = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
RUNS = "array<struct<lo:int,hi:int>>"


def _as_spans(runs: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"lo": a, "hi": b} for a, b in r] for r in runs], SPANS)


def _bundle_repeats(length: int):
    def run(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group["name"].to_pylist(), group["digest"].to_pylist(), group["copies"].to_pylist(), group["bytes"].to_pylist()))
        found = repeated_bytes([r[3] for r in rows], [r[2] for r in rows], length)
        return pa.table({"name": pa.array([r[0] for r in rows], pa.int64()), "digest": pa.array([r[1] for r in rows], pa.int64()), "spans": _as_spans(found)})
    return run


def packed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``KEY, packed, size``: each text's bytes compressed (null: empty), for joins that move texts, and how many there are."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([pa.compress(t, codec=CODEC, asbytes=True) for t in texts], pa.binary()),
                 pa.array(map(len, texts), pa.int32())], names=[*KEY, "packed", "size"])

    return arrow_map(docs.select(*key_columns(id_col, text_col), empty_text(text_col).alias("text")), run,
                     f"{KEY[0]} {id_type}, {KEY[1]} long, packed binary, size int")


def _unpacked(packed: pa.Array, size: pa.Array) -> list[bytes]:
    return [pa.decompress(p, n, codec=CODEC, asbytes=True) for p, n in zip(packed.to_pylist(), size.to_pylist())]


def _fetch(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """The bytes of the wanted segments, cut from one document each.

    Texts go to the wanted places by shuffle at any size, compressed, and only those long enough for a segment.
    """
    per_doc = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("name", "digest", "copies", "bundle", "start", "windows")).alias("segs")).hint("merge")
    rows = packed_texts(docs.where(F.octet_length(F.col(text_col).cast("string")) >= length), id_col, text_col)
    joined = rows.join(per_doc, key_match(rows, per_doc)).select("packed", "size", "segs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data, segs in zip(_unpacked(batch.column(0), batch.column(1)), batch.column(2).to_pylist()):
                out += [(s["name"], s["digest"], s["copies"], s["bundle"], data[s["start"]:s["start"] + s["windows"] + length - 1]) for s in segs]
            cols = list(zip(*out)) if out else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["name", "digest", "copies", "bundle", "bytes"])

    return arrow_map(joined, run, "name long, digest long, copies long, bundle long, bytes binary").dropDuplicates(["name", "digest"])


def _large_names(large: DataFrame, length: int) -> DataFrame:
    """For names too large for a bundle: each window by its own hash, counted over all segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, digest, copies, data in zip(*(batch.column(k).to_pylist() for k in range(4))):
                n = len(data) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n, pa.int64()), pa.array([digest] * n, pa.int64()), pa.array([copies] * n, pa.int64()), pa.array(range(n), pa.int32()),
                     pa.array([xxhash.xxh3_128_digest(data[i:i + length]) for i in range(n)], pa.binary())], names=["name", "digest", "copies", "at", "window"])

    windows = large.select("name", "digest", "copies", "bytes").mapInArrow(run, "name long, digest long, copies long, at int, window binary")
    often = windows.groupBy("window").agg(F.sum("copies").alias("n")).where("n > 1").select("window")
    return windows.join(often, "window").groupBy("name", "digest").agg(
        F.array_sort(F.collect_set(F.struct(F.col("at").alias("lo"), (F.col("at") + length).alias("hi")))).alias("spans"))


def _merged(spans: Column) -> Column:
    """Overlapping or touching runs joined; ``spans`` sorted."""
    start = F.array().cast(RUNS)
    return F.aggregate(spans, start, lambda done, s: F.when(
        (F.size(done) > 0) & (F.coalesce(F.get(done, F.size(done) - 1)["hi"], F.lit(-1)) >= s["lo"]),
        F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(
            F.get(done, F.size(done) - 1)["lo"].alias("lo"), F.greatest(F.get(done, F.size(done) - 1)["hi"], s["hi"]).alias("hi"))))
    ).otherwise(F.concat(done, F.array(s))))


def repeated_runs(docs: DataFrame, length: int = LENGTH, bundle: int = BUNDLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document key with something to remove: ``runs``, the maximal runs of repeated bytes in order."""
    table = materialize(segment_table(docs, id_col, text_col, length), "segments")
    names = table.groupBy("name").agg(F.count("*").alias("n"), F.min("digest").alias("lo"), F.max("digest").alias("hi"),
                                      F.max("again").alias("again")).where("n > 1 OR again")
    mixed = (F.col("lo") != F.col("hi")) | (F.col("n") == 1)
    shared = materialize(table.drop("again").join(names.select("name", mixed.alias("mixed")), "name"), "shared-segments")
    distinct = shared.where("mixed").groupBy("name", "digest").agg(
        F.count("*").alias("copies"), F.min(F.struct(*KEY, "start", "windows")).alias("one")).select("name", "digest", "copies", "one.*")
    distinct = materialize(distinct, "distinct-segments")
    weight = distinct.groupBy("name").agg(F.sum(F.col("windows") + length).alias("bytes"))
    total = weight.agg(F.sum("bytes")).first()[0] or 0
    bundles = max(1, -(-total // bundle))
    dealt = weight.select("name", F.when(F.col("bytes") > 4 * bundle, -1).otherwise(F.pmod(F.xxhash64("name"), F.lit(bundles))).cast("long").alias("bundle"))
    found = materialize(_fetch(docs, distinct.join(dealt, "name"), id_col, text_col, length), "segment-bytes")
    spans = found.where("bundle >= 0").groupBy("bundle").applyInArrow(_bundle_repeats(length), f"name long, digest long, spans {RUNS}")
    if not dealt.where("bundle < 0").isEmpty():
        spans = spans.unionAll(_large_names(found.where("bundle < 0"), length))
    spans = materialize(spans.where(F.size("spans") > 0), "segment-spans")
    at_places = shared.where("mixed").join(spans, ["name", "digest"]).select(*KEY, "start", F.explode("spans").alias("s")).select(
        *KEY, (F.col("start") + F.col("s.lo")).alias("lo"), (F.col("start") + F.col("s.hi")).alias("hi"))
    whole = shared.where("NOT mixed").select(*KEY, F.col("start").alias("lo"), (F.col("start") + F.col("windows") + length - 1).alias("hi"))
    per_doc = at_places.unionAll(whole).groupBy(*KEY).agg(F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("runs"))
    return materialize(per_doc.select(*KEY, _merged(F.col("runs")).alias("runs")), "repeated-runs")


def remove_repeats(docs: DataFrame, length: int = LENGTH, bundle: int = BUNDLE, id_col: str = "doc_id", text_col: str = "text",
                   keep_text: bool = False) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, with ``keep_text``, ``kept``: the bytes left."""
    runs = repeated_runs(docs, length, bundle, id_col, text_col)
    small = few(runs, F.size("runs"))
    if small:
        rows = docs.select(*key_columns(id_col, text_col), empty_text(text_col).alias("text"), F.lit(0).alias("size"))
        runs = F.broadcast(runs)
    else:
        rows = packed_texts(docs, id_col, text_col).withColumnRenamed("packed", "text")
    joined = rows.join(runs, key_match(rows, runs), "left").select(rows[KEY[0]].alias("doc_id"), "text", "size", "runs")
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in batch.column(1).to_pylist()] if small else _unpacked(batch.column(1), batch.column(2))
            found = [[(s["lo"], s["hi"]) for s in r or []] for r in batch.column(3).to_pylist()]
            kept = [b"".join(t[a:b] for a, b in zip([0, *(hi for _, hi in r)], [*(lo for lo, _ in r), len(t)])) for t, r in zip(texts, found)]
            out = {"doc_id": batch.column(0), "n_bytes": pa.array(map(len, texts), pa.int64()),
                   "n_removed": pa.array([sum(b - a for a, b in r) for r in found], pa.int64()), "n_spans": pa.array(map(len, found), pa.int64()),
                   "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept])}
            if keep_text:
                out["kept"] = pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return arrow_map(joined, cut, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text)
