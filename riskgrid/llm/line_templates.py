"""Line dedup with a fixed-depth template tree (DataFrame functions only).

A line is cut into words at white space; words with a digit become ``<*>``. The tree's
path is the word count and the first ``depth`` words; what follows is the variable part,
summarised in ``PARTS`` equal parts, of which short lines fill only some.

* Boilerplate recurs in documents that are otherwise different; lines of copied documents recur among documents that
  are otherwise alike. So the holders of a path are counted by representatives: for each holder, the first of its
  *other* paths in an order by hash; in ``ORDERS`` orders, of which the mean counts. Copies of one document, edited ones
  too, mostly share it, different pages do not.
* A path is recurring boilerplate if it has at least ``min_docs`` representatives, and one for every ``ALIKE`` holders at
  least. Pages that share three lines of four have about one for three; copies with one line in ten edited one for ten.
* A part's value is fixed if more than half of the holders have it. A path forms a template if at least half of
  the parts that its lines fill have a fixed value (a line without such parts is its path). All its lines that agree with at least
  half of the fixed parts are dropped, in every document, copies included.

Nulls and empty texts have no lines to drop: n_lines 0, an empty text. Empty lines, and lines of fewer than ``min_words``
words, are kept. Null ids match each other. Repeated rows count as one document and get the same result. Very long texts are cut into
lines like all others. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgrid.llm.common import KEY, empty_text, if_small, key_columns, key_match, materialize, split_lines

PARTS = 4
DEPTH = 5
MIN_DOCS = 10
#: Holders of a path for each of its representatives, at most.
ALIKE = 5
#: Orders of the paths: the path's number with its first bits (as many as count the orders) changed by exclusive or.
ORDERS = 16
MIN_WORDS = 1
#: Hexadecimal digits of the MD5 that number the paths.
DIGITS = 15
SHIFT = 4 * DIGITS - (ORDERS - 1).bit_length()
#: White space inside a line; the same class works in Java's and RE2's syntax.
SPACE = "[ \\t\\r\\f\\x0B]+"
WITH_DIGIT = "[^ \\t\\r\\f\\x0B]*[0-9][^ \\t\\r\\f\\x0B]*"


def _words(line: Column) -> Column:
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, WITH_DIGIT, "<*>")).otherwise(line)
    return F.filter(F.split(masked, SPACE, -1), lambda w: w != "")


def _part(words: Column, depth: int, n: Column, i: int) -> Column:
    """Hash of the i-th of PARTS equal parts of the words behind the path; null if it holds no word."""
    start = F.floor((n - depth) * i / PARTS).cast("int")
    end = F.floor((n - depth) * (i + 1) / PARTS).cast("int")
    return F.when((n > depth) & (end > start), F.xxhash64(F.concat_ws(" ", F.slice(words, start + 1 + depth, F.greatest(end - start, F.lit(0))))))


def line_paths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
               min_words: int = MIN_WORDS) -> DataFrame:
    """One compact row per countable line: document key, line number, path, parts. No text."""
    lines = docs.select(*key_columns(id_col, text_col), F.posexplode(split_lines(empty_text(text_col))).alias("line_no", "line"))
    words = lines.select(*KEY, "line_no", _words(F.col("line")).alias("words")).where(F.size("words") >= min_words)
    n = F.size("words")
    # Numbered by MD5, whose order SQL can repeat.
    path = F.conv(F.substring(F.md5(F.concat_ws(" ", n.cast("string"), F.slice("words", 1, depth)).cast("binary")), 1, DIGITS), 16, 10).cast("long")
    return words.select(*KEY, "line_no", path.alias("path"), *[_part(F.col("words"), depth, n, i).alias(f"p{i}") for i in range(PARTS)])


def templates(lines: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """(recurring paths with the fixed values of each part, the lines on paths that enough documents hold)."""
    holders = lines.select(*KEY, "path").distinct().groupBy("path").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
    # Only lines on such paths go on; the rest of the corpus ends here.
    holders = materialize(holders, "line-holders")
    hot = materialize(lines.join(if_small(holders).select("path"), "path", "left_semi"), "line-paths")
    # The two first paths of each document in each order; a document's lines lie together, so one row each goes to the shuffle.
    orders = F.sequence(F.lit(0).cast("long"), F.lit(ORDERS - 1).cast("long"))
    least = lines.groupBy(*KEY).agg(F.collect_set("path").alias("paths")).select(*KEY, F.transform(orders, lambda k: F.slice(
        F.sort_array(F.transform("paths", lambda p: p.bitwiseXOR(k * F.lit(2**SHIFT)))), 1, 2)).alias("least"))
    held = materialize(hot.select(*KEY, "path", *[f"p{i}" for i in range(PARTS)]).distinct(), "line-held")
    pairs = held.select(*KEY, "path").distinct()
    seen = pairs.join(least, key_match(pairs, least)).select("path", F.posexplode("least").alias("k", "two"))
    own = F.col("path").bitwiseXOR(F.col("k").cast("long") * F.lit(2**SHIFT))
    rep = F.when(F.get("two", F.lit(0)) == own, F.coalesce(F.get("two", F.lit(1)), F.lit(-1))).otherwise(F.get("two", F.lit(0)))  # -1: no other line
    reps = seen.select("path", "k", rep.alias("rep")).distinct().groupBy("path").agg(F.count("*").alias("reps"))
    found = holders.join(reps, "path").where((F.col("reps") >= min_docs * ORDERS) & (F.col("reps") * ALIKE >= F.col("docs") * ORDERS))
    parts = held.select(*KEY, "path", F.posexplode(F.array(*[f"p{i}" for i in range(PARTS)])).alias("part", "value")).where("value IS NOT NULL").distinct()
    values = parts.groupBy("path", "part", "value").agg(F.count("*").alias("n")).join(found.select("path", "docs"), "path")
    fixed = values.groupBy("path").agg(F.count_distinct("part").alias("filled"), *[
        F.collect_set(F.when((F.col("part") == i) & (F.col("n") * 2 > F.col("docs")), F.col("value"))).alias(f"f{i}") for i in range(PARTS)])
    # A path whose lines fill no part has no row there.
    whole = found.select("path").join(fixed, "path", "left").select("path", F.coalesce("filled", F.lit(0)).alias("filled"), *[
        F.coalesce(f"f{i}", F.array().cast("array<long>")).alias(f"f{i}") for i in range(PARTS)])
    n_fixed = _count([F.size(f"f{i}") > 0 for i in range(PARTS)])
    return whole.withColumn("fixed", n_fixed).where(F.col("fixed") * 2 >= F.col("filled")).drop("filled"), hot


def _count(flags: list[Column]) -> Column:
    out = flags[0].cast("int")
    for f in flags[1:]:
        out = out + f.cast("int")
    return out


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
                  min_docs: int = MIN_DOCS, min_words: int = MIN_WORDS) -> DataFrame:
    """Per document key with a dropped line: the sorted numbers of the lines to drop."""
    lines = materialize(line_paths(docs, id_col, text_col, depth, min_words), "lines")
    found, hot = templates(lines, min_docs)
    found = if_small(materialize(found, "line-templates"), sum((F.size(f"f{i}") for i in range(PARTS)), F.lit(0)))
    same = _count([F.coalesce(F.array_contains(f"f{i}", F.col(f"p{i}")), F.lit(False)) for i in range(PARTS)])
    hits = hot.join(found, "path").where(same * 2 >= F.col("fixed"))
    return hits.groupBy(*KEY).agg(F.sort_array(F.collect_set("line_no")).alias("__drops"))


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
                         min_docs: int = MIN_DOCS, min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``docs`` in a struct ``row``, with ``text_kept``, ``n_lines`` and ``n_dropped``."""
    drops = if_small(materialize(dropped_lines(docs, id_col, text_col, depth, min_docs, min_words), "dropped-lines"), F.size("__drops"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), empty_text(text_col).alias("__text"),
                       *key_columns(id_col, text_col))
    joined = rows.join(drops, key_match(rows, drops), "left")
    lines = split_lines(F.col("__text"))
    # The kept stretches lie between the dropped lines: no line is looked up in the list.
    ends = F.concat(F.col("__drops"), F.array(F.size(lines)))
    starts = F.concat(F.array(F.lit(0)), F.transform("__drops", lambda i: i + 1))
    stretches = F.filter(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda z: z["e"] > z["s"])
    kept = F.array_join(F.flatten(F.transform(stretches, lambda z: F.slice(lines, z["s"] + 1, z["e"] - z["s"]))), "\n")
    return joined.select(
        "row", F.when(F.col("__drops").isNull(), F.col("__text")).otherwise(kept).alias("text_kept"),
        F.when(F.col("__text") == "", 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__drops"), F.lit(0)).cast("long").alias("n_dropped"))


def sql(depth: int = DEPTH, min_docs: int = MIN_DOCS, min_words: int = MIN_WORDS) -> str:
    """DuckDB SQL for the per-document result (the strings themselves in place of the parts' hashes)."""
    space = "[ \\t\\r\\f\\x0B]+"
    digit = "[^ \\t\\r\\f\\x0B]*[0-9][^ \\t\\r\\f\\x0B]*"
    at = lambda i: f"CAST(floor(greatest(len(w) - {depth}, 0) * {i} / {PARTS}) AS INT)"
    parts = ",".join(f"CASE WHEN {at(i + 1)} > {at(i)} THEN array_to_string(list_slice(w, {depth} + {at(i)} + 1, {depth} + {at(i + 1)}), ' ') END AS p{i}" for i in range(PARTS))
    votes = " UNION ALL ".join(f"SELECT DISTINCT doc_id, text, path, {i} AS part, p{i} AS value FROM held WHERE p{i} IS NOT NULL" for i in range(PARTS))
    same = " + ".join(f"(SELECT count(*) FROM fixed f WHERE f.path = h.path AND f.part = {i} AND f.value = h.p{i})" for i in range(PARTS))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
cut AS (SELECT doc_id, text, unnest(range(len(string_split(text, chr(10))))) AS line_no,
               unnest(string_split(text, chr(10))) AS line FROM (SELECT DISTINCT doc_id, text FROM d)),
tok AS (SELECT doc_id, text, line_no,
               list_filter(string_split_regex(regexp_replace(line, '{digit}', '<*>', 'g'), '{space}'), lambda x: x <> '') AS w FROM cut),
lines AS (SELECT doc_id, text, line_no,
                 CAST('0x' || substr(md5(len(w) || ' ' || array_to_string(list_slice(w, 1, {depth}), ' ')), 1, {DIGITS}) AS BIGINT) AS path, {parts}
          FROM tok WHERE len(w) >= {min_words}),
holders AS (SELECT path, count(*) AS docs FROM (SELECT DISTINCT doc_id, text, path FROM lines) GROUP BY path HAVING count(*) >= {min_docs}),
hot AS (SELECT l.* FROM lines l JOIN holders USING (path)),
least AS (SELECT doc_id, text, k, list_sort(list(DISTINCT xor(path, k * {2**SHIFT})))[1:2] AS least
          FROM lines CROSS JOIN (SELECT CAST(unnest(range({ORDERS})) AS BIGINT) AS k) GROUP BY doc_id, text, k),
held AS (SELECT DISTINCT doc_id, text, path, p0, p1, p2, p3 FROM hot),
reps AS (SELECT path, count(*) AS reps FROM (
           SELECT DISTINCT h.path, k, CASE WHEN m.least[1] = xor(h.path, k * {2**SHIFT}) THEN coalesce(m.least[2], -1) ELSE m.least[1] END AS rep
           FROM hot h JOIN least m ON h.doc_id IS NOT DISTINCT FROM m.doc_id AND h.text = m.text) GROUP BY path),
boiler AS (SELECT path, docs FROM holders JOIN reps USING (path) WHERE reps >= {min_docs * ORDERS} AND reps * {ALIKE} >= docs * {ORDERS}),
vote AS (SELECT path, part, value, count(*) AS n FROM ({votes}) v GROUP BY ALL),
fixed AS (SELECT path, part, value FROM vote JOIN boiler USING (path) WHERE n * 2 > docs),
found AS (SELECT b.path, count(DISTINCT f.part) AS fixed FROM boiler b LEFT JOIN fixed f USING (path) LEFT JOIN
            (SELECT path, count(DISTINCT part) AS filled FROM vote GROUP BY path) v USING (path)
          GROUP BY b.path, filled HAVING count(DISTINCT f.part) * 2 >= coalesce(filled, 0)),
gone AS (SELECT h.doc_id, h.text, h.line_no FROM hot h JOIN found USING (path) WHERE ({same}) * 2 >= found.fixed),
per_doc AS (SELECT doc_id, text, count(*) AS n_dropped, list(line_no) AS drops FROM gone GROUP BY ALL)
SELECT d.doc_id, CASE WHEN d.text = '' THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines,
       coalesce(n_dropped, 0) AS n_dropped,
       CASE WHEN n_dropped IS NULL THEN d.text ELSE coalesce(array_to_string(list_transform(list_filter(
           list_zip(string_split(d.text, chr(10)), range(len(string_split(d.text, chr(10))))),
           lambda z: NOT list_contains(drops, z[2])), lambda z: z[1]), chr(10)), '') END AS text_kept
FROM d LEFT JOIN per_doc p ON d.doc_id IS NOT DISTINCT FROM p.doc_id AND d.text = p.text
"""
