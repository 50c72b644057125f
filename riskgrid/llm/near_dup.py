"""MinHash near-dedup with circulant permutations.

A document's set holds the hashes of its distinct word shingles. One permutation s spreads the
hashes over 32-bit numbers; a second, p, is used for all signature coordinates, each time shifted
round by one more place: ``h_k = min p(s(x) + k mod 2^32)``. Bands of ``rows`` coordinates are the
bucket keys. Documents that share a bucket, directly or over others, are a candidate group; inside
it, links (Jaccard similarity of the full sets) are checked exactly.

* Equal sets are one node, whatever their number: copies are counted, not compared.
* A candidate group of any size is cut into blocks of bounded size, each also given a few
  leaders of the group. What the blocks and leaders link is one label; then every node outside
  the group's largest label meets every node of another label, block by block. No pair is left
  out that could join two labels, and no pair inside a label is compared again.
* Components are found by joins and minima, with written tables between rounds.

Empty texts and nulls have no set: 0 shingles, linked with nothing, their own component. Fewer
words than a shingle count as one shingle. Null ids are never the smallest id; a component of null
ids alone has a null id. Repeated rows get the same result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.llm.common import KEY, arrow_map, drop_tables, empty_text, if_small, key_columns, key_match, materialize

#: 40 bands of 6: a pair at similarity 0.8 is missed with a chance of 5e-6.
BANDS, ROWS = 40, 6
#: Nodes, and shingles, of one block.
BLOCK, BLOCK_SHINGLES = 1024, 2_000_000
LEADERS = 16
#: Pairs of sets that share one of their rarest shingles, counted over the shingles: held at a time. Characters of small blocks worked on together.
PAIRS, TOGETHER = 1_000_000, 500_000
#: Pairs compared at a time.
COMPARED = 1 << 15

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x = x ^ (x >> np.uint64(33))
    x = x * _M2
    return x ^ (x >> np.uint64(33))


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text; A-Z in lower case, words split at ASCII white space."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    seen: dict[bytes, int] = {}
    h = np.array([seen[w] if w in seen else seen.setdefault(w, xxhash.xxh3_64_intdigest(w)) for w in words], np.uint64)
    n = min(size, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        out = _mix64(out ^ h[k:k + len(out)]) + np.uint64(k + 1)
    return np.unique(out)


def _coordinates(hashes: np.ndarray, coordinates: int) -> np.ndarray:
    """Each hash's value at each coordinate: spread by the first permutation, shifted round, then permuted."""
    x = (_mix64(hashes) >> np.uint64(32)).astype(np.uint32)[:, None] + np.arange(coordinates, dtype=np.uint32)
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signature(hashes: np.ndarray, coordinates: int) -> np.ndarray:
    """The circulant MinHash signature of a set that isn't empty."""
    out = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(hashes), 512):
        np.minimum(out, _coordinates(hashes[i:i + 512], coordinates).min(axis=0), out=out)
    return out


def _band_table(sigs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit bucket key for each signature and band, with the band's number in it."""
    parts = sigs[:, :bands * rows].reshape(len(sigs), bands, rows).astype(np.uint64)
    key = np.tile(np.arange(bands, dtype=np.uint64), (len(sigs), 1))
    for k in range(rows):
        key = _mix64((key << np.uint64(32)) ^ key ^ parts[:, :, k]) + np.uint64(k + 1)
    return key.view(np.int64)


def _flat_shingles(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of ``shingles`` of all texts, text by text, unsorted and with repeats, and the number of each one's text."""
    seen: dict[bytes, int] = {}
    words, lengths, short = [], [], {}
    for i, t in enumerate(texts):
        own = t.encode().lower().split()
        if 0 < len(own) < size:
            short[i] = shingles(t, size)
        words += own
        lengths.append(len(own))
    for w in set(words):
        seen[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
    length = np.array(lengths, np.int64)
    out = np.full(max(len(h) - size + 1, 0), size, np.uint64)
    for k in range(size):
        out = _mix64(out ^ h[k:k + len(out)]) + np.uint64(k + 1)
    text = np.repeat(np.arange(len(length)), length)[:len(out)]
    inside = np.arange(len(out)) + size <= np.cumsum(length)[text]
    values = np.concatenate([out[inside], *short.values()])
    text = np.concatenate([text[inside], *(np.full(len(v), i) for i, v in short.items())]).astype(np.int64)
    if short:
        order = np.argsort(text, kind="stable")
        values, text = values[order], text[order]
    return values, text


def describe(texts: list[str | None], size: int, bands: int, rows: int):
    """For a batch: set sizes, set keys (128 bits; None: no set) and bucket keys (None without bands).

    The same as ``shingles``, ``signature`` and ``band_keys`` text by text, but over all texts at once.
    """
    number: dict[str, int] = {}
    of = [number.setdefault(t or "", len(number)) for t in texts]
    values, text = _flat_shingles(list(number), size)
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    if len(values):
        first = np.append(True, (values[1:] != values[:-1]) | (text[1:] != text[:-1]))
        values, text = values[first], text[first]
    counts = np.bincount(text, minlength=len(number))
    end = np.cumsum(counts)
    data, ends = values.tobytes(), end.tolist()
    keys = [hashlib.md5(data[8 * (e - n):8 * e]).digest() if n else None for e, n in zip(ends, counts.tolist())]
    held: list = [None] * len(number)
    if bands:
        full = np.flatnonzero(counts)
        lo = 0
        while lo < len(full):
            # Whole texts of about 1000 shingles together: the block stays in the cache.
            hi = max(lo + 1, int(np.searchsorted(end[full], end[full[lo]] - counts[full[lo]] + 1000, side="right")))
            start = end[full[lo:hi]] - counts[full[lo:hi]]
            if hi == lo + 1:
                sig = signature(values[start[0]:end[full[lo]]], bands * rows)[None]
            else:
                sig = np.minimum.reduceat(_coordinates(values[start[0]:end[full[hi - 1]]], bands * rows), start - start[0], axis=0)
            for i, keys_ in zip(full[lo:hi].tolist(), _band_table(sig, bands, rows)):
                held[i] = keys_
            lo = hi
    sizes = counts.tolist()
    return [sizes[i] for i in of], [keys[i] for i in of], [held[i] for i in of]


def signatures(docs: DataFrame, size: int, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: key, ``n_shingles``, ``set_key`` (null: no set) and ``buckets``."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, keys, buckets = describe(batch.column(2).to_pylist(), size, bands, rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(buckets, pa.list_(pa.int64()))], names=[*KEY, "n_shingles", "set_key", "buckets"])

    return arrow_map(docs.select(*key_columns(id_col, text_col), F.col(text_col).cast("string").alias("text")), run,
                     f"{KEY[0]} {id_type}, {KEY[1]} long, n_shingles long, set_key binary, buckets array<long>")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for all nodes of the edges ``a, b``: the smallest node of its component is its root.

    Each round, every node points to the smallest node among its neighbours and itself, then one
    step further; edges are redrawn between what is pointed to, until none is left. A round's nodes
    are the roots of the one before, so the rounds are put together from the last, smallest one on.
    """
    edges = materialize(edges.where("a <> b").distinct(), "edges")
    rounds = []
    while not rounds or not edges.isEmpty():
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root"))
        up = parent.select(F.col("node").alias("root"), F.col("root").alias("top"))
        jump = materialize(parent.join(up, "root").select("node", F.col("top").alias("root")), "jumps")
        rounds.append(jump)
        ja, jb = jump.select(F.col("node").alias("a"), F.col("root").alias("ra")), jump.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        redrawn = materialize(edges.join(ja, "a").join(jb, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")).where("a <> b").distinct(), "edges")
        drop_tables(edges)
        edges = redrawn
    drop_tables(edges)
    mapping = rounds[-1]
    if len(rounds) == 1:
        return mapping
    for jump in reversed(rounds[:-1]):
        to = mapping.select(F.col("node").alias("root"), F.col("root").alias("top"))
        mapping = jump.join(to, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    mapping = materialize(mapping, "roots")
    drop_tables(*rounds)
    return mapping


def linked(sets: list[np.ndarray], labels: np.ndarray, percent: int) -> np.ndarray:
    """Labels after joining those of all sets with ``100 * intersection >= percent * union``. Exact."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1] if n else np.empty(0, int)
    end = np.cumsum(size)
    start = end - size
    mark = np.zeros(int(flat.max(initial=-1)) + 1, bool)
    total = np.zeros(len(flat) + 1, np.int64)
    for v in range(n):
        least, most = size * 100 >= size[v] * percent, size * percent <= size[v] * 100
        others = (labels != labels[v]) & least & most
        others[:v + 1] = False
        if not others.any():
            continue
        own = flat[start[v]:end[v]]
        mark[own] = True
        np.cumsum(mark[flat], out=total[1:])
        mark[own] = False
        both = total[end] - total[start]
        hit = others & (100 * both >= percent * (size + size[v] - both))
        if hit.any():
            labels[np.isin(labels, labels[hit])] = labels[v]
    return labels


def _pairs_of_runs(run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (the smaller place first) of places that hold the same number; equal numbers stand side by side."""
    end = np.flatnonzero(np.diff(run, append=-1)) + 1
    after = np.repeat(end, np.diff(end, prepend=0)) - np.arange(len(run)) - 1
    left = np.repeat(np.arange(len(run)), after)
    return left, left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(after) - after, after)


def _group_links(groups: list[dict[bytes, tuple[bytes, str]]], size: int, percent: int) -> tuple[list[bytes], list[bytes]]:
    """Edges between the nodes of each group (node: label, text) whose sets, or labels, are linked.

    Shingles are looked up once for all groups. Linked sets share one of those that are left when each gives up as many
    of its most common shingles as it needs to share, less one; the pairs that share one of those are compared where
    they are few, and a group with more than ``PAIRS`` goes node by node.
    """
    nodes = [sorted(g) for g in groups]
    flat = [x for own in nodes for x in own]
    rows = [g[x] for g, own in zip(groups, nodes) for x in own]
    edge = np.cumsum([0, *map(len, nodes)])
    group = np.repeat(np.arange(len(groups)), np.diff(edge))
    values, text = _flat_shingles([t for _, t in rows], size)
    order = np.lexsort((values, group[text]))
    values, text = values[order], text[order]
    first = np.append(True, (values[1:] != values[:-1]) | (text[1:] != text[:-1]))[:len(values)]
    values, text = values[first], text[first]
    sizes, of = np.bincount(text, minlength=len(rows)), group[text]
    run = np.cumsum(np.append(True, (values[1:] != values[:-1]) | (of[1:] != of[:-1]))[:len(values)])
    length = np.bincount(run)[run] if len(run) else run
    by_text = np.lexsort((run, length, text))
    end = np.cumsum(sizes)
    rarest = np.arange(len(run)) - (end - sizes)[text[by_text]] <= (sizes - -(-percent * sizes // 100))[text[by_text]]
    at = np.sort(by_text[rarest])
    at = at[np.bincount(run[at], minlength=1)[run[at]] > 1]
    few, few_of = run[at], of[at]
    pairs = np.bincount(few_of, weights=(np.bincount(few, minlength=1)[few] - 1) / 2, minlength=len(groups)).round().astype(np.int64)
    a: list[bytes] = []
    b: list[bytes] = []
    known: dict[tuple, int] = {}
    parent = [known.setdefault((g, label), k) for k, (g, (label, _)) in enumerate(zip(group.tolist(), rows))]

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    by_text = np.lexsort((run, text))
    runs, wide = run[by_text], int(run.max(initial=0)) + 1
    held = text[by_text] * wide + runs

    def shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The number of shingles that the sets ``x`` and ``y`` share, pair by pair."""
        n = sizes[x]
        pair = np.repeat(np.arange(len(x)), n)
        want = y[pair] * wide + runs[np.arange(len(pair)) + np.repeat(end[x] - np.cumsum(n), n)]
        return np.bincount(pair[held[np.minimum(np.searchsorted(held, want), len(held) - 1)] == want], minlength=len(x))

    some = np.flatnonzero((pairs > 0) & (pairs <= PAIRS))
    place = np.searchsorted(few_of, np.arange(len(groups) + 1))
    for part in np.split(some, np.flatnonzero(np.diff(np.cumsum(pairs[some]) // PAIRS)) + 1):
        if len(part):
            own = np.concatenate([np.arange(place[g], place[g + 1]) for g in part.tolist()])
            i, j = _pairs_of_runs(few[own])
            pair = np.unique(text[at][own][i] * len(rows) + text[at][own][j])
            i, j = pair // len(rows), pair % len(rows)
            alike = (100 * sizes[i] >= percent * sizes[j]) & (100 * sizes[j] >= percent * sizes[i])
            i, j = i[alike], j[alike]
            while len(i):
                # What is joined by now needs no look.
                tops = np.array([top(x) for x in range(len(rows))])
                apart = tops[i] != tops[j]
                i, j = i[apart], j[apart]
                x, y, i, j = i[:COMPARED], j[:COMPARED], i[COMPARED:], j[COMPARED:]
                both = shared(x, y)
                hit = 100 * both >= percent * (sizes[x] + sizes[y] - both)
                for x, y in zip(x[hit].tolist(), y[hit].tolist()):
                    one, other = top(x), top(y)
                    if one != other:
                        parent[other] = one
                        a.append(flat[x])
                        b.append(flat[y])
    for g in np.flatnonzero(pairs > PAIRS).tolist():
        own = nodes[g]
        names = {x: k for k, x in enumerate(sorted({groups[g][x][0] for x in own}))}
        before = np.array([names[groups[g][x][0]] for x in own])
        ends: dict[int, int] = {}
        for k, new in enumerate(linked([shingles(groups[g][x][1], size) for x in own], before.copy(), percent)):
            root = ends.setdefault(int(new), k)
            if before[root] != before[k]:
                a.append(own[k])
                b.append(own[root])
    return a, b


def block_links(rows: DataFrame, block: list[str], size: int, percent: int) -> DataFrame:
    """Edges ``a, b`` inside the blocks of ``rows`` (the block's columns, node, label, text); many small blocks are worked on together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(groups):
            a, b = _group_links(groups, size, percent)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

        key, held, n = None, [], 0
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
            for *own, node, label, text in zip(*columns):
                if own != key:
                    if n >= TOGETHER:
                        yield flush(held)
                        held, n = [], 0
                    key = own
                    held.append({})
                if node not in held[-1]:  # some nodes come twice to a block
                    held[-1][node] = label, text
                    n += len(text)
        if held:
            yield flush(held)

    dealt = rows.select(*block, "node", "label", "text").repartition(*block).sortWithinPartitions(*block)
    return arrow_map(dealt, run, "a binary, b binary")


def bucket_edges(nodes: DataFrame) -> DataFrame:
    """Edges from each node to the smallest node of each of its buckets."""
    held = nodes.select("node", F.explode("buckets").alias("bucket"))
    first = held.groupBy("bucket").agg(F.min("node").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return held.join(first, "bucket").where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))


def link_components(nodes: DataFrame, texts, size: int, percent: int, kept: list[DataFrame] | None = None) -> DataFrame:
    """``node, root`` of all nodes with a link. ``nodes``: node, n_shingles, buckets.

    ``texts(wanted)`` returns ``wanted``'s columns (it has ``node``) with the column ``text``. The table of
    these texts, of all nodes that share a bucket, goes to ``kept`` if it is given, and else is dropped.
    """
    groups = components(bucket_edges(nodes))
    known = nodes.select("node", "n_shingles").join(groups.withColumnRenamed("root", "grp"), "node")
    sizes = materialize(known.groupBy("grp").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s")).select(
        "grp", F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int").alias("blocks"), "n"), "group-sizes")
    deal = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    leads = (F.col("blocks") > 1) & (F.pmod(F.xxhash64("node", F.lit(1)), F.ceil(F.col("n") / LEADERS).cast("long")) == 0)
    members = materialize(texts(known.join(sizes, "grp").select("node", "grp", "blocks", deal.alias("block"), leads.alias("leads"), "n_shingles")), "members")
    places = F.when(F.col("leads"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    first = members.select("grp", F.explode(places).alias("block"), "node", F.col("node").alias("label"), "text")
    links = materialize(block_links(first, ["grp", "block"], size, percent), "links")
    done = [members] if kept is None else []
    if kept is not None:
        kept.append(members)
    large = members.where("blocks > 1").select("node", "grp", "blocks", "block", "text")
    roots = components(links)
    drop_tables(groups, sizes)
    if large.isEmpty():
        drop_tables(*done, links)
        return roots
    labelled = materialize(large.join(roots, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root"), "labelled")
    counted = labelled.groupBy("grp", "label").agg(F.count("*").alias("c"))
    main = counted.groupBy("grp").agg(F.max_by("label", F.struct("c", "label")).alias("main"), (F.sum("c") - F.max("c")).alias("rest")).where("rest > 0")
    rest = labelled.join(main, "grp").withColumn("rblocks", F.ceil(F.col("rest") / BLOCK).cast("int"))
    left = rest.where("label <> main").select("grp", "node", "label", "text", F.pmod(F.xxhash64("node", F.lit(2)), F.col("rblocks")).cast("int").alias("rblock"),
                                              F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("xblock"))
    right = rest.select("grp", "node", "label", "text", F.explode(F.sequence(F.lit(0), F.col("rblocks") - 1)).alias("rblock"), F.col("block").alias("xblock"))
    more = block_links(left.unionByName(right), ["grp", "rblock", "xblock"], size, percent)
    more = materialize(more, "links")
    drop_tables(*done, labelled)
    every = components(links.unionAll(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))).unionAll(more))
    drop_tables(links, more, roots)
    return every


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                    id_col: str = "doc_id", text_col: str = "text", groups: bool = False) -> DataFrame:
    """Per row: the key columns, ``doc_id, n_shingles, component_id, kept``; with ``groups``, also ``group``.

    ``group`` names the component by its root set, whatever the ids (null: no set).
    """
    signed = materialize(signatures(docs, size, bands, rows, id_col, text_col), "signatures")
    nodes = materialize(signed.where("set_key IS NOT NULL").groupBy(F.col("set_key").alias("node")).agg(
        F.min(F.struct(*KEY)).alias("one"), F.min(KEY[0]).alias("least"), F.first("n_shingles").alias("n_shingles"),
        F.first("buckets").alias("buckets")), "sets")

    def texts(wanted: DataFrame) -> DataFrame:
        """Each wanted set's text, from one of its documents."""
        place = if_small(materialize(nodes.select("node", "one.*").join(wanted, "node"), "wanted"))
        rows_ = docs.select(*key_columns(id_col, text_col), empty_text(text_col).alias("text"))
        found = rows_.join(place, key_match(rows_, place)).select(*wanted.columns, "text")
        return found.dropDuplicates(["node"]) if has_repeats else found

    has_repeats = not signed.groupBy(*KEY).count().where("count > 1").isEmpty()
    roots = link_components(nodes, texts, size, percent)
    smallest = nodes.join(roots, "node").groupBy("root").agg(F.min("least").alias("component_id"))
    named = nodes.join(roots, "node", "left").join(smallest, "root", "left").select(
        F.col("node").alias("set_key"), F.coalesce("component_id", "least").alias("component_id"), F.coalesce("root", "node").alias("group"))
    out = signed.drop("buckets").join(named, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col(KEY[0])).otherwise(F.col("component_id"))
    return out.select(*KEY, F.col(KEY[0]).alias("doc_id"), "n_shingles", component.alias("component_id"),
                      (F.col(KEY[0]) == component).alias("kept"), *["group"] * groups)
