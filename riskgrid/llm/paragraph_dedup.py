"""Substring dedup: paragraph MinHash banding, exact check, removal by components.

Units of two kinds go through one search, from one scan of the texts:

* A paragraph is a line; a long line is cut further at sentence ends chosen by a hash of their last
  words, so that equal passages are cut alike wherever they stand. Paragraphs of at least
  ``MIN_WORDS`` words take part; a text without any, too short for a window, is one. Bands of two coordinates are tuned for recall (a pair at similarity
  0.8 shares one with a chance of 0.9992).
* A window is a piece of ``WINDOW`` words, cut at a content-defined place over all words of a text,
  whatever its line ends: of each ``SPREAD`` neighbouring starts the one whose five-word shingle has
  the smallest hash is taken, so two texts with ``PASSAGE`` equal words in a row (A-Z in lower case)
  hold an equal window. Windows have one band of their own: equal windows always share it, near ones
  (similarity 0.8) with a chance of 0.64 each. Windows whose bucket no other place holds are let go
  before the search.

The scan packs its units, so that few long rows are written. The bucket keys held at more than one place
are found from 42 bits of each, and set bits of a filter that is sent to all tasks (``FILTER_BITS`` at most; with
more keys more units pass). Units without a key that passes share no bucket and aren't equal to others:
they are let go. What passes is judged by whole keys, counts and places.

Colliding units of a kind are checked by the exact Jaccard similarity of their sets of five-word
shingles, and linked units form components. The first paragraph of a component (by document, then
place) stays; the others are removed. Of equal windows the first stays and the others are removed,
with the line ends inside them; where it is linked to other windows, and isn't the first of their
component, the words of the shingles that it shares with that one are removed. So every word removed
stands in a unit that stays. Windows of the same document that overlap the one that stays, stay too.
At most ``SPREAD`` - 1 words at either end of a passage repeated outside of paragraphs stay.

Equal units are one node of the search, however many documents hold them; large candidate groups are
cut into blocks as in ``near_dup``, whose search this uses.

Nulls and empty texts have no units: zeros and empty lists. An empty table gives an empty one. Null
ids match each other and come first, but aren't named in ``first_docs``. Very long texts are taken whole: memory grows with the longest
text and with ``BATCH_BYTES``, not with the batch. Repeated rows share a result: where theirs is the
first place, it stays in each of them. Extra columns are ignored. ``n_paragraphs``, ``n_repeated``
and ``n_removed`` count paragraphs; ``removed`` and ``first_docs`` hold the windows too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgrid.llm.common import KEY, arrow_map, batch_bytes, drop_tables, empty_text, key_columns, key_match, materialize, settings
from riskgrid.llm.near_dup import _band_table, _coordinates, _mix64, link_components

SHINGLE, PERCENT = 5, 80
BANDS, ROWS = 7, 2
MIN_WORDS = 8
#: Lines of more words are cut at one in SENTENCES of their sentence ends.
LONG_LINE, SENTENCES = 60, 3
#: Passages of over 50 words: of SPREAD neighbouring windows of WINDOW words, one is taken.
WINDOW, SPREAD = 32, 20
PASSAGE = WINDOW + SPREAD - 1
#: Bytes of text handed to a Python worker at a time, and cut at a time (a longer text comes alone); shingles signed at a time; words whose hashes are kept.
BATCH_BYTES, CUT_BYTES, SIGNED, WORDS = 8 << 20, 256 << 10, 8192, 1 << 18
#: Places of the rows that aren't paragraphs: a document's own row, and a window.
DOCUMENT, PIECE = -1, -2
#: Bits of a bucket key that name its range, and most bits of the filter (64 MB); keys sorted at a time; rows of packed texts read at a time.
RANGE_BITS, FILTER_BITS, NAMES, PARTS = 10, 29, 1 << 22, 16
#: The search writes many tables: the shuffle files of one go when it is written.
CLEANED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
_COLUMNS = [*KEY, "place", "start", "end", "node", "n_shingles", "buckets", "bucket", "words"]
_UNITS, _WINDOWS = [c for c in _COLUMNS if c not in ("bucket", "words")], [*KEY, "start", "end", "bucket", "words", "text"]
_CLOSING = np.isin(np.arange(256), (33, 46, 63))


def _word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray, seen: dict[bytes, int]) -> np.ndarray:
    """``xxh3_64`` of each word: those of up to 8 bytes all at once, by its formulas for short inputs, the others by the library.

    ``seen`` holds hashes of longer words.
    """
    raw = np.frombuffer(data + b"\0" * 4, np.uint8).astype(np.uint32)
    four = raw[:-3] | raw[1:-2] << 8 | raw[2:-1] << 16 | raw[3:] << 24
    size = ends - starts
    out = np.empty(len(size), np.uint64)
    k = np.flatnonzero(size < 4)
    a, n = starts[k], size[k]
    h = (raw[a] << 16 | raw[a + (n >> 1)] << 24 | raw[a + n - 1] | n.astype(np.uint32) << 8).astype(np.uint64) ^ np.uint64(0x87275A9B)
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ h >> np.uint64(29)) * np.uint64(0x165667B19E3779F9)
    out[k] = h ^ h >> np.uint64(32)
    k = np.flatnonzero((size >= 4) & (size <= 8))
    h = (four[ends[k] - 4].astype(np.uint64) + (four[starts[k]].astype(np.uint64) << np.uint64(32))) ^ np.uint64(0xC73AB174C5ECD5A2)
    h ^= (h << np.uint64(49) | h >> np.uint64(15)) ^ (h << np.uint64(24) | h >> np.uint64(40))
    h *= np.uint64(0x9FB21C651E98DF25)
    h ^= (h >> np.uint64(35)) + size[k].astype(np.uint64)
    h *= np.uint64(0x9FB21C651E98DF25)
    out[k] = h ^ h >> np.uint64(28)
    k = np.flatnonzero(size > 8)
    words = [data[a:b] for a, b in zip(starts[k].tolist(), ends[k].tolist())]
    out[k] = np.array([seen[w] if w in seen else seen.setdefault(w, xxhash.xxh3_64_intdigest(w)) for w in words], np.uint64)
    return out


class _Words:
    """Texts in one piece, joined by line ends: starts and ends of their words in its bytes, and each text's first word."""

    def __init__(self, texts: list[bytes], seen: dict[bytes, int]):
        self.data = b"\n".join(texts)
        self.raw = np.frombuffer(self.data, np.uint8)
        inside = np.zeros(len(self.raw) + 2, bool)
        inside[1:-1] = (self.raw != 32) & (self.raw - np.uint8(9) > 4)
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edge[::2], edge[1::2]
        self.begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.first = np.searchsorted(self.starts, self.begin)
        # Bytes that go on with a code point.
        self.follow = np.flatnonzero((self.raw & 0xC0) == 0x80)
        self.hashes = _word_hashes(self.data.lower(), self.starts, self.ends, seen)

    def points(self, at: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Bytes, each of a text, as places in the code points of that text."""
        begin = self.begin[text]
        return at - np.searchsorted(self.follow, at) - begin + np.searchsorted(self.follow, begin)


def _cuts(words: _Words) -> np.ndarray:
    """The paragraphs that take part, as rows (first word, word after the last)."""
    starts, ends, first = words.starts, words.ends, words.first
    edge = np.unique(np.concatenate([[0, len(starts)], np.searchsorted(starts, np.flatnonzero(words.raw == 10))]))
    long = np.diff(edge) > LONG_LINE
    if long.any():
        closing = np.flatnonzero(_CLOSING[words.raw[ends - 1]])
        line = np.searchsorted(edge, closing, side="right") - 1
        closing = closing[long[line] & (closing > edge[line])]
        chosen = [i for i, a, b in zip(closing.tolist(), starts[closing - 1].tolist(), ends[closing].tolist())
                  if xxhash.xxh3_64_intdigest(words.data[a:b]) % SENTENCES == 0]
        edge = np.union1d(edge, chosen).astype(np.int64)
    cuts = np.stack([edge[:-1], edge[1:]], axis=1)
    cuts = cuts[cuts[:, 1] - cuts[:, 0] >= MIN_WORDS]
    size = np.diff(first)
    alone = np.flatnonzero((np.diff(np.searchsorted(cuts[:, 0], first)) == 0) & (size >= MIN_WORDS) & (size < WINDOW))
    if len(alone):
        cuts = np.concatenate([cuts, np.stack([first[alone], first[alone + 1]], axis=1)])
        cuts = cuts[np.argsort(cuts[:, 0])]
    return cuts


def paragraphs(text: str) -> list[tuple[int, int]]:
    """(start, end) of the paragraphs that take part, in code points."""
    words = _Words([text.encode()], {})
    cuts = _cuts(words)
    none = np.zeros(len(cuts), np.int64)
    return list(zip(words.points(words.starts[cuts[:, 0]], none).tolist(), words.points(words.ends[cuts[:, 1] - 1], none).tolist()))


def _shingles(h: np.ndarray) -> np.ndarray:
    """Hashes of the shingles at each word, from those of the words; the same as in ``near_dup.shingles``."""
    out = np.full(len(h) - SHINGLE + 1, SHINGLE, np.uint64)
    for k in range(SHINGLE):
        out = _mix64(out ^ h[k:k + len(out)]) + np.uint64(k + 1)
    return out


def _buckets(shingle: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Bucket keys of paragraphs; they don't overlap, so their shingles are signed in stretches."""
    lo, hi = cuts[:, 0], cuts[:, 1] - SHINGLE + 1
    out, i = [np.empty((0, BANDS), np.int64)], 0
    while i < len(cuts):
        j = max(i + 1, int(np.searchsorted(hi, lo[i] + SIGNED, side="right")))
        part = _coordinates(shingle[lo[i]:hi[j - 1]], BANDS * ROWS)
        # Every second stretch lies between paragraphs; the last one has no end to name.
        at = np.stack([lo[i:j], hi[i:j]], axis=1).ravel()[:-1] - lo[i]
        out.append(_band_table(np.minimum.reduceat(part, at, axis=0)[::2], BANDS, ROWS))
        i = j
    return np.concatenate(out)


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` neighbouring values."""
    wide = 1
    while wide < size:
        step = min(wide, size - wide)
        values = np.minimum(values[step:], values[:-step])
        wide += step
    return values


def _first_least(values: np.ndarray, size: int) -> np.ndarray:
    """The first place of the least of each ``size`` neighbouring values."""
    at, wide = np.arange(len(values)), 1
    while wide < size:
        step = min(wide, size - wide)
        later = values[step:] < values[:-step]
        at = np.where(later, at[step:], at[:-step])
        values = np.minimum(values[step:], values[:-step])
        wide += step
    return at


def _taken(shingle: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of the windows taken from texts with these first words, and their bucket keys."""
    n = np.diff(first) - (WINDOW - 1)
    at = [np.array([a + shingle[a:a + k].argmin() for a, k in zip(first.tolist(), n.tolist()) if 0 < k < SPREAD], np.int64)]
    many = np.flatnonzero(n >= SPREAD)
    if len(many):
        near = _first_least(shingle, SPREAD)
        step = np.zeros(len(near) + 1, np.int8)
        step[first[many]] = 1
        step[first[many] + n[many] - SPREAD + 1] = -1
        near = near[np.cumsum(step[:-1], dtype=np.int8) == 1]
        at.append(near[np.diff(near, prepend=-1) != 0])
    at = np.sort(np.concatenate(at))
    if not len(at):
        return at, np.empty(0, np.int64)
    sigs = _least(_coordinates(shingle, ROWS), WINDOW - SHINGLE + 1)[at]
    # A band of their own: windows meet windows.
    return at, _mix64(_band_table(sigs, 1, ROWS)[:, 0].view(np.uint64) ^ np.uint64(BANDS)).view(np.int64)


def _units(texts: str | list[bytes], seen: dict[bytes, int]) -> dict[str, np.ndarray | list]:
    """The texts' own rows, then their paragraphs, then their windows, as columns; ``text`` numbers the texts. ``seen`` holds hashes of words."""
    texts = [texts.encode()] if isinstance(texts, str) else texts
    words = _Words(texts, seen)
    starts, ends, first, h = words.starts, words.ends, words.first, words.hashes
    cuts, at, buckets, keys = np.empty((0, 2), np.int64), np.empty(0, np.int64), np.empty((0, BANDS), np.int64), np.empty(0, np.int64)
    if len(h) >= MIN_WORDS:
        cuts, shingle = _cuts(words), _shingles(h)
        buckets, (at, keys) = _buckets(shingle, cuts), _taken(shingle, first)
    data, n, p, w = h.tobytes(), len(texts), len(cuts), len(at)
    of, place = np.searchsorted(first, cuts[:, 0], side="right") - 1, np.searchsorted(first, at, side="right") - 1
    text = np.concatenate([np.arange(n), of, place])
    none = np.zeros(n, np.int64)
    return {
        "text": text,
        "place": np.concatenate([np.full(n, DOCUMENT), np.arange(p) - np.searchsorted(of, of), np.full(w, PIECE)]),
        "start": np.concatenate([none, words.points(np.concatenate([starts[cuts[:, 0]], starts[at]]), text[n:])]),
        "end": np.concatenate([none, words.points(np.concatenate([ends[cuts[:, 1] - 1], ends[at + WINDOW - 1]]), text[n:])]),
        # Equal words, equal node; other units with an equal set are linked by the search.
        "node": [*[None] * n, *(hashlib.md5(data[8 * a:8 * b]).digest() for a, b in cuts.tolist()), *[None] * w],
        "n_shingles": np.concatenate([np.bincount(of, minlength=n), cuts[:, 1] - cuts[:, 0] - SHINGLE + 1, np.full(w, WINDOW - SHINGLE + 1)]),
        "buckets": np.concatenate([np.zeros((n, BANDS), np.int64), buckets, np.zeros((w, BANDS), np.int64)]),
        "bucket": np.concatenate([np.zeros(n + p, np.int64), keys]),
        "words": np.array([0] * (n + p) + [xxhash.xxh3_64_intdigest(data[8 * a:8 * (a + WINDOW)]) - (1 << 63) for a in at.tolist()], np.int64),
    }


def _unit_arrays(found: dict[str, np.ndarray | list]) -> list[pa.Array]:
    """The columns of ``_units`` from ``place`` on; those of other kinds of rows are null."""
    place = found["place"]
    paragraph, piece = place >= 0, place == PIECE
    ends = np.cumsum(np.append(0, paragraph)) * BANDS
    buckets = pa.ListArray.from_arrays(pa.array(ends, pa.int32(), mask=np.append(~paragraph, False)), pa.array(found["buckets"][paragraph].ravel()))
    return [*(pa.array(found[c], pa.int32()) for c in ("place", "start", "end")), pa.array(found["node"], pa.binary()), pa.array(found["n_shingles"], pa.int32()),
            buckets, *(pa.array(found[c], pa.int64(), mask=~piece) for c in ("bucket", "words"))]


def _packed(rows: pa.RecordBatch) -> bytes:
    """Rows as an Arrow stream."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(rows)
    return out.getvalue().to_pybytes()


def _opened(packed: pa.BinaryScalar, columns: list[int] | None = None) -> pa.RecordBatch:
    """The rows of ``_packed``, or some of their columns."""
    return pa.ipc.open_stream(packed.as_buffer(), options=pa.ipc.IpcReadOptions(included_fields=columns)).read_next_batch()


def unit_parts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row for some texts at a time: the rows of their documents (``n_shingles``: the paragraphs) and paragraphs, and those of their windows, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        for batch in batches:
            texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
            # Short texts are cut together, while their words stay in the cache.
            edge = np.cumsum([0, *map(len, texts)]) // CUT_BYTES
            parts = [0, *(np.flatnonzero(np.diff(edge)) + 1).tolist(), len(texts)]
            for a, b in zip(parts, parts[1:]):
                if a < b:
                    found = _units(texts[a:b], seen)
                    at = pa.array(a + found["text"], pa.int32())
                    rows = pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *_unit_arrays(found), at], names=[*_COLUMNS, "text"])
                    n = int(np.count_nonzero(found["place"] != PIECE))
                    packed = [_packed(rows.slice(0, n).select(_UNITS)), _packed(rows.slice(n).select(_WINDOWS))]
                    yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in packed], names=["units", "windows"])
            if len(seen) > WORDS:
                seen.clear()

    return arrow_map(docs.select(*key_columns(id_col, text_col), F.col(text_col).cast("string").alias("text")), run, "units binary, windows binary")


def _name(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The range of each bucket key, by its upper bits, and its next 32 bits."""
    upper = keys.view(np.uint64) >> np.uint64(32 - RANGE_BITS)
    return (upper >> np.uint64(32)).astype(np.int64), upper.astype(np.uint32)


def _held(windows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The bucket keys of each text's windows, once; and those that it holds at places that don't overlap."""
    text, key, start, end = (windows.column(c).to_numpy() for c in ("text", "bucket", "start", "end"))
    order = np.lexsort((key, text))
    text, key = text[order], key[order]
    at = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (key[1:] != key[:-1]))[:len(key)])
    last = order[np.append(at[1:], len(key))[:len(at)] - 1]
    return key[at], key[at][start[last] >= end[order[at]]]


def repeated_keys(parts: DataFrame) -> DataFrame:
    """``range, names``: of the bucket keys held at more than one place, sorted, by ``_name``. A few others may share a name."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            of, name = _name(np.concatenate(held))
            name = np.sort(of.astype(np.uint64) << np.uint64(32) | name)
            # Two of equal ones tell as much as all.
            name = name[np.append(np.ones(min(2, len(name)), bool), name[2:] != name[:-2])]
            edge = np.searchsorted(name, np.arange((1 << RANGE_BITS) + 1, dtype=np.uint64) << np.uint64(32))
            some = np.flatnonzero(np.diff(edge))
            data, name = name.astype(np.uint32), [edge[some].tolist(), edge[some + 1].tolist()]
            return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([data[a:b].tobytes() for a, b in zip(*name)], pa.binary())], names=["range", "names"])

        held, n = [], 0
        for batch in batches:
            for units, windows in zip(batch.column(0), batch.column(1)):
                keys = [_opened(units, [_UNITS.index("buckets")]).column(0).flatten().to_numpy(), *_held(_opened(windows))]
                held += keys
                n += sum(map(len, keys))
            if n >= NAMES:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for of, names in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(of, []).append(np.frombuffer(names, np.uint32))
        for of, names in held.items():
            name = np.sort(np.concatenate(names))
            name = np.unique(name[1:][name[1:] == name[:-1]])
            yield pa.RecordBatch.from_arrays([pa.array([of], pa.int32()), pa.array([name.tobytes()], pa.binary())], names=["range", "names"])

    schema = "range int, names binary"
    return arrow_map(arrow_map(parts, send, schema).repartition("range"), meet, schema)


def _spots(name: np.ndarray, width: int) -> list[np.ndarray]:
    """The two bits of a name among the ``1 << width`` of its range."""
    return [x >> np.uint32(32 - width) for x in (name, name * np.uint32(0x9E3779B1))]


def key_filter(keys: DataFrame) -> tuple[bytes, int]:
    """Bits that are set for all names of ``repeated_keys`` (and for few others), range by range, and the ``width`` of a range."""
    n = (keys.agg(F.sum(F.length("names"))).first()[0] or 0) // 4
    width = min(FILTER_BITS, max(RANGE_BITS + 3, (32 * n).bit_length())) - RANGE_BITS

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for of, names in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                on = np.zeros(1 << width, bool)
                for spot in _spots(np.frombuffer(names, np.uint32), width):
                    on[spot] = True
                yield pa.RecordBatch.from_arrays([pa.array([of], pa.int32()), pa.array([np.packbits(on, bitorder="little").tobytes()], pa.binary())], names=["range", "bits"])

    out = np.zeros((1 << RANGE_BITS, 1 << width >> 3), np.uint8)
    for r in arrow_map(keys, mark, "range int, bits binary").collect():
        out[r["range"]] = np.frombuffer(r["bits"], np.uint8)
    return out.tobytes(), width


def _may_repeat(keys: np.ndarray, bits: np.ndarray, width: int) -> np.ndarray:
    """Whether each key passes ``key_filter``."""
    of, name = _name(keys)
    out = np.ones(len(keys), bool)
    for spot in _spots(name, width):
        at = (of << width) + spot
        out &= (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return out


def unit_table(parts: DataFrame, held, width: int, id_type: str) -> DataFrame:
    """The documents' rows, and the paragraphs with a bucket key that passes the filter, with those keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(held.value, np.uint8)
        for batch in batches:
            for packed in batch.column(0):
                rows = _opened(packed)
                paragraph = rows.column("place").to_numpy() >= 0
                keys = rows.column("buckets").flatten().to_numpy()
                hit = _may_repeat(keys, bits, width)
                n = np.zeros(len(rows), np.int64)
                n[paragraph] = hit.reshape(-1, BANDS).sum(axis=1)
                keep = ~paragraph | (n > 0)
                ends = pa.array(np.cumsum(np.append(0, n[keep])), pa.int32(), mask=np.append(~paragraph[keep], False))
                rows = rows.filter(pa.array(keep)).drop_columns("buckets")
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.ListArray.from_arrays(ends, pa.array(keys[hit]))], names=_UNITS)

    return arrow_map(parts.select("units"), run, f"{KEY[0]} {id_type}, {KEY[1]} long, place int, start int, end int, node binary, n_shingles int, buckets array<long>")


def window_table(parts: DataFrame, held, width: int, id_type: str) -> DataFrame:
    """The windows whose bucket key passes the filter; equal bucket and words, equal ``node``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(held.value, np.uint8)
        for batch in batches:
            for packed in batch.column(0):
                rows = _opened(packed)
                rows = rows.filter(pa.array(_may_repeat(rows.column("bucket").to_numpy(), bits, width)))
                node = np.stack([rows.column(c).to_numpy() for c in ("bucket", "words")], axis=1).astype(">i8").tobytes()
                ends = pa.py_buffer(np.arange(0, 16 * len(rows) + 1, 16, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([*rows.drop_columns(["words", "text"]).columns, pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, ends, pa.py_buffer(node)])],
                                                 names=[*_WINDOWS[:-2], "node"])

    return arrow_map(parts.select("windows"), run, f"{KEY[0]} {id_type}, {KEY[1]} long, start int, end int, bucket long, node binary")


def units_that_may_repeat(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The tables of ``unit_table`` and ``window_table``: without the units that share no bucket key with another place."""
    spark, id_type = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    with batch_bytes(spark, BATCH_BYTES), settings(spark, {"spark.sql.parquet.columnarReaderBatchSize": str(PARTS)}):
        parts = materialize(unit_parts(docs, id_col, text_col), "unit-parts")
        keys = materialize(repeated_keys(parts), "repeated-keys")
        bits, width = key_filter(keys)
        held = spark.sparkContext.broadcast(bits)
        units = materialize(unit_table(parts, held, width, id_type), "units")
        windows = materialize(window_table(parts, held, width, id_type), "windows")
    held.destroy()
    drop_tables(parts, keys)
    return units, windows


#: A window whose bucket another document holds too, or the same one at a place that doesn't overlap; ``lo`` is null for paragraphs.
APART = "(lo IS NULL OR lo <> hi OR last >= first)"


def unit_sets(units: DataFrame) -> DataFrame:
    """A row for each ``node``: its first place, its buckets, the number of its copies; for windows, what tells how far apart they are."""
    row, piece = F.xxhash64(*KEY), F.col("place") == PIECE
    return units.groupBy("node").agg(
        F.min(F.struct(*KEY, "place", "start", "end")).alias("one"), F.first("n_shingles").alias("n_shingles"),
        F.first("buckets").alias("buckets"), F.count("*").alias("copies"), F.min(F.when(piece, row)).alias("lo"), F.max(F.when(piece, row)).alias("hi"),
        F.min(F.when(piece, F.col("end"))).alias("first"), F.max(F.when(piece, F.col("start"))).alias("last"))


def colliding(nodes: DataFrame) -> DataFrame:
    """The nodes that share a bucket with another one, with those of their buckets; counted before any node is moved."""
    held = nodes.select("node", "n_shingles", F.explode("buckets").alias("bucket"), "lo", "hi", "first", "last")
    counted = held.groupBy("bucket").agg(F.count("*").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("first").alias("first"), F.max("last").alias("last"))
    shared = materialize(counted.where(f"n > 1 AND {APART}").select("bucket"), "colliding-buckets")
    kept = held.select("node", "n_shingles", "bucket").join(shared, "bucket")
    out = materialize(kept.groupBy("node").agg(F.first("n_shingles").alias("n_shingles"), F.collect_list("bucket").alias("buckets")), "colliding")
    drop_tables(shared)
    return out


def _disjoint(spans: str) -> Column:
    """Sorted spans, with those that overlap or touch made one."""
    def add(out: Column, s: Column) -> Column:
        last = F.try_element_at(out, F.lit(-1))
        joined = F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end")))
        return F.when(s["start"] <= last["end"], F.concat(F.slice(out, F.lit(1), F.size(out) - 1), joined)).otherwise(F.concat(out, F.array(s)))

    return F.aggregate(spans, F.array().cast("array<struct<start:int,end:int>>"), add)


def shared_spans(near: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, shared``: the stretches of a window's text (from its start) whose shingles its ``first_node`` holds too."""
    def shingles(h: np.ndarray) -> np.ndarray:
        """A row of shingles for each window; those across two windows are left out."""
        return np.append(_shingles(h), np.zeros(SHINGLE - 1, np.uint64)).reshape(-1, WINDOW)[:, :WINDOW - SHINGLE + 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        for batch in batches:
            if not len(batch):
                continue
            own, other = (_Words(batch.column(k).cast(pa.binary()).to_pylist(), seen) for k in (1, 2))
            hit = (shingles(own.hashes)[:, :, None] == shingles(other.hashes)[:, None, :]).any(axis=2)
            inside = np.zeros((len(batch), WINDOW + 2), np.int8)
            for k in range(1, SHINGLE + 1):
                inside[:, k:k + hit.shape[1]] |= hit
            step = np.diff(inside, axis=1)
            (row, a), (_, b) = np.nonzero(step == 1), np.nonzero(step == -1)
            spans = pa.StructArray.from_arrays([pa.array(own.points(own.starts[row * WINDOW + a], row), pa.int32()),
                                                pa.array(own.points(own.ends[row * WINDOW + b - 1], row), pa.int32())], names=["start", "end"])
            shared = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(batch) + 1)), pa.int32()), spans)
            yield pa.RecordBatch.from_arrays([batch.column(0), shared], names=["node", "shared"])
            if len(seen) > WORDS:
                seen.clear()

    firsts = texts.select(F.col("node").alias("first_node"), F.col("text").alias("other"))
    return arrow_map(near.join(texts, "node").join(firsts, "first_node").select("node", "text", "other"), run, "node binary, shared array<struct<start:int,end:int>>")


def _marked(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame, bool]:
    """The documents' rows; the units that may repeat; ``one``, ``first`` and ``shared`` of the nodes that do; whether rows come twice."""
    units, windows = units_that_may_repeat(docs, id_col, text_col)
    searched = units.where("place >= 0").unionByName(windows.select(
        *KEY, F.lit(PIECE).alias("place"), "start", "end", "node", F.lit(WINDOW - SHINGLE + 1).alias("n_shingles"), F.array("bucket").alias("buckets")))
    nodes = materialize(unit_sets(searched), "unit-sets")
    rows = units.where(F.col("place") == DOCUMENT).groupBy(*KEY).agg(F.count("*").alias("copies"), F.first("n_shingles").alias("n_paragraphs"))
    rows = materialize(rows, "unit-documents")
    repeats = not rows.where("copies > 1").isEmpty()

    places, members = [], []

    def texts(wanted: DataFrame) -> DataFrame:
        places.append(materialize(nodes.select("node", "one.*").join(wanted, "node"), "wanted"))
        whole = docs.select(*key_columns(id_col, text_col), empty_text(text_col).alias("__doc"))
        cut = whole.join(places[-1], key_match(whole, places[-1])).select(
            *wanted.columns, F.substring(F.col("__doc"), F.col("start") + 1, F.col("end") - F.col("start")).alias("text"))
        return cut.dropDuplicates(["node"]) if repeats else cut

    searching = colliding(nodes)
    roots = link_components(searching, texts, SHINGLE, PERCENT, members)
    drop_tables(searching, *places)
    # Equal windows that all overlap stay, whatever their bucket holds besides.
    named = materialize(nodes.join(roots, "node", "left").where(f"root IS NOT NULL OR copies > 1 AND {APART}").select(
        "node", F.coalesce("root", "node").alias("root"), "one"), "repeated-units")
    drop_tables(nodes, roots)
    first = named.groupBy("root").agg(F.min(F.struct("one", "node")).alias("least")).select("root", F.col("least.one").alias("first"), F.col("least.node").alias("first_node"))
    marks = materialize(named.join(first, "root").drop("root"), "unit-marks")
    drop_tables(named)
    near = marks.where((F.col("one.place") == PIECE) & (F.col("node") != F.col("first_node"))).select("node", "first_node")
    # Both have a link, so the search had their texts.
    all_marks = materialize(marks.join(shared_spans(near, members[0].select("node", "text")), "node", "left"), "marks")
    drop_tables(marks, *members)
    return rows, searched.drop("buckets", "n_shingles"), all_marks, repeats


def repeated_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document key: ``n_paragraphs, n_repeated, n_removed, removed`` (spans) and ``first_docs`` (ids)."""
    with settings(docs.sparkSession, CLEANED):
        rows, searched, marks, repeats = _marked(docs, id_col, text_col)

    def own(of: str) -> Column:
        return F.col(KEY[0]).eqNullSafe(F.col(f"{of}.{KEY[0]}")) & (F.col(KEY[1]) == F.col(f"{of}.{KEY[1]}"))

    paragraph = F.col("place") >= 0
    whole, nothing = F.array(F.struct("start", "end")), F.array().cast("array<struct<start:int,end:int>>")
    moved = F.transform("shared", lambda x: F.struct((x["start"] + F.col("start")).alias("start"), (x["end"] + F.col("start")).alias("end")))
    same_place = own("one") & (F.col("start") == F.col("one.start"))
    # Of equal windows the first place stays, but for what it shares with its component's first window.
    piece = F.when(same_place, F.when(own("first") & (F.col("start") < F.col("first.end")), nothing).otherwise(F.coalesce(moved, nothing))).when(
        own("one") & (F.col("start") < F.col("one.end")), nothing).otherwise(whole)
    gone = F.when(paragraph, F.when(own("first") & (F.col("place") == F.col("first.place")), nothing).otherwise(whole)).otherwise(piece)
    seen = searched.select(*KEY, "place", "start", "end", "node").join(marks, "node").withColumn("gone", gone)
    removed = F.size("gone") > 0

    def places(of: Column) -> Column:
        # Repeated rows hold a place more than once.
        return F.size(F.collect_set(F.when(of, F.col("place")))).cast("long") if repeats else F.count(F.when(of, True))

    found = seen.groupBy(*KEY).agg(
        places(paragraph).alias("n_repeated"), places(paragraph & removed).alias("n_removed"),
        F.array_sort(F.flatten(F.collect_list("gone"))).alias("removed"),
        F.array_sort(F.collect_set(F.when(paragraph | removed, F.col(f"first.{KEY[0]}")))).alias("first_docs"))
    out = rows.join(found, key_match(rows, found), "left").select(
        *[rows[k] for k in KEY], "copies", F.col("n_paragraphs").cast("long").alias("n_paragraphs"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_repeated", "n_removed")],
        *[F.coalesce(c, F.array().cast(found.schema[c].dataType)).alias(c) for c in ("removed", "first_docs")])
    return out.withColumn("removed", _disjoint("removed"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_paragraphs, n_repeated, n_removed, removed, first_docs``."""
    found = repeated_paragraphs(docs, id_col, text_col)
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select(
        F.col(KEY[0]).alias("doc_id"), "n_paragraphs", "n_repeated", "n_removed", spans.alias("removed"),
        "first_docs", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("__copy")).drop("__copy")


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the removed paragraphs and windows cut out of the text; line ends outside of them stay."""
    found = repeated_paragraphs(docs, id_col, text_col).where(F.size("removed") > 0).select(*KEY, "removed")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), empty_text(text_col).alias("__doc"), *key_columns(id_col, text_col))
    joined = rows.join(found, key_match(rows, found), "left")
    cut = F.aggregate("removed", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), lambda a, s: F.struct(
        s["end"].alias("at"), F.concat(a["out"], F.substring(F.col("__doc"), a["at"] + 1, s["start"] - a["at"])).alias("out")))
    kept = F.concat(cut["out"], F.substring(F.col("__doc"), cut["at"] + 1, F.length("__doc")))
    return joined.select(F.col("row").withField(text_col, F.when(F.col("removed").isNull(), F.col("row")[text_col]).otherwise(kept)).alias("row")).select("row.*")
