"""Benchmark decontamination (DataFrame functions only).

A-Z is lower-cased; words are runs of characters other than ASCII marks, spaces and controls.
The windows of ``size`` consecutive item words form a hash set, broadcast after its rows are
counted against ``BROADCAST_WINDOWS``; a larger set is joined by shuffle. An item of fewer words,
but not none, is one window. Each window's longest word is its anchor. Documents are scanned for
anchors, and only the windows around an anchor are built and looked up, as whole strings: a hit
is an equal window, never a hash alone. Beyond ``SCAN_ANCHORS`` anchors all windows are looked up.

Null and empty texts have no words: zeros, an empty item list, not contaminated. Repeated rows
share a key and a result; null ids match each other. An item without an id counts under the
empty id. An empty benchmark marks nothing. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgrid.llm.common import KEY, empty_text, key_columns, key_match

SIZE = 10
#: Windows, and items in their lists, of a broadcast; at about 100 bytes each, this is 100 MB on each executor.
BROADCAST_WINDOWS = 1_000_000
#: Anchors that are tested inside the scan; they are part of the plan, at about 20 bytes each.
SCAN_ANCHORS = 50_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Upper-case letters beyond ASCII, which lower() would change too.
OTHER_UPPER = "[\\p{Lu}\\p{Lt}\\u2160-\\u216F\\u24B6-\\u24CF&&[^A-Z]]"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case. lower() is far faster than translate(), and equal without other capitals."""
    return F.when(text.rlike(OTHER_UPPER), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), NOT_WORD, -1), "")


def _gram(words: Column, start: Column, size: int) -> Column:
    """One window as a string, word by word: slice() would copy the whole array for each window."""
    return F.concat_ws(" ", *[F.get(words, start + k) for k in range(size)])


def _grams_at(words: Column, starts: Column, size: int) -> Column:
    return F.transform(starts, lambda i: F.struct(i.alias("pos"), _gram(words, i, size).alias("gram")))


def _starts(words: Column, size: int) -> Column:
    """The starts of all windows of ``size`` words."""
    n = F.size(words)
    return F.when(n >= size, F.sequence(F.lit(0), F.greatest(n - size, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def _starts_near(at: Column, words: Column, size: int) -> Column:
    """The starts of the windows of ``size`` words that cover one of the positions ``at``."""
    around = F.array_distinct(F.flatten(F.transform(at, lambda p: F.sequence(p - (size - 1), p))))
    return F.filter(around, lambda i: (i >= 0) & (i <= F.size(words) - size))


def item_windows(benchmark: DataFrame, size: int = SIZE, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows with their word count and the ids of the items that hold them."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                             words_of(empty_text(text_col)).alias("w")).where(F.size("w") > 0)
    short = F.size("w") < size
    wins = items.select("item", F.when(short, F.size("w")).otherwise(size).alias("len"),
                        F.explode(F.when(short, F.array(F.array_join("w", " "))).otherwise(
                            F.transform(_starts(F.col("w"), size), lambda i: _gram(F.col("w"), i, size)))).alias("gram"))
    longest = F.element_at(F.array_sort(F.transform(F.split("gram", " "), lambda x: F.struct((-F.length(x)).alias("n"), x.alias("x")))), 1)["x"]
    return wins.groupBy("gram").agg(F.first("len").alias("len"), F.collect_set("item").alias("items")).withColumn("anchor", longest)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id") -> DataFrame:
    """Per distinct document key: n_words, the sorted items, and the numbers of the hit words (from 0)."""
    grams = item_windows(benchmark, size, item_col)
    # At most ``size`` lengths, one aggregate row each; then the anchors, if they are few enough.
    counted = {r["len"]: r["n"] for r in grams.groupBy("len").agg(F.sum(1 + F.size("items")).alias("n")).collect()}
    small = sum(counted.values()) <= BROADCAST_WINDOWS
    words = docs.select(*key_columns(id_col, text_col), words_of(empty_text(text_col)).alias("w"))
    w = F.col("w")
    anchors = grams.select("anchor").distinct().limit(SCAN_ANCHORS + 1).collect() if small else []
    if small and 0 < len(anchors) <= SCAN_ANCHORS:
        # Words hold no ASCII marks, so they need no escapes.
        among = ",".join(f"'{r['anchor']}'" for r in anchors)
        words = words.withColumn("at", F.expr(f"filter(sequence(0, size(w)), i -> get(w, i) IN ({among}))"))
        starts = {n: _starts_near(F.col("at"), w, n) for n in counted}
    else:
        starts = {n: _starts(w, n) for n in counted}
    lists = [_grams_at(w, starts[n], n) for n in sorted(starts)]
    # One row more for each document, so that a document without hits keeps its word count.
    own = F.array(F.struct(F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("gram")))
    rows = words.select(*KEY, F.size(w).cast("long").alias("n_words"), F.explode(F.concat(own, *lists) if lists else own).alias("x"))
    rows = rows.select(*KEY, "n_words", "x.pos", "x.gram")
    hits = rows.join(F.broadcast(grams) if small else grams, "gram", "left").where((F.col("pos") < 0) | F.col("len").isNotNull())
    # Within a document: bounded by its own words.
    spans = hits.groupBy(*KEY, "n_words").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.collect_set(F.when(F.col("len").isNotNull(), F.struct("pos", (F.col("pos") + F.col("len")).alias("end"))))).alias("spans"))
    # The spans in order of their start; each adds what lies beyond the furthest end so far.
    merged = F.aggregate("spans", F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")), lambda a, s: F.struct(
        F.greatest(a["upto"], s["end"]).alias("upto"),
        (a["n"] + F.greatest(s["end"] - F.greatest(s["pos"], a["upto"]), F.lit(0))).alias("n")))
    return spans.select(*KEY, "n_words", "items", "spans", merged["n"].cast("long").alias("n_hit"))


def report(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id") -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    found = contamination(docs, benchmark, size, id_col, text_col, item_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), *key_columns(id_col, text_col)).groupBy(*KEY).agg(F.count("*").alias("copies"))
    out = found.join(rows, key_match(found, rows)).select(
        found[KEY[0]].alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return out.drop("copy")


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, remove: str = "documents", id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``docs`` without its contaminated documents, or (``remove="spans"``) without the hit words.

    A hit word goes with the marks and spaces behind it; all other characters stay.
    """
    found = contamination(docs, benchmark, size, id_col, text_col, item_col).where("n_hit > 0")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *key_columns(id_col, text_col))
    if remove == "documents":
        return rows.join(found, key_match(rows, found), "left_anti").select("row.*")
    joined = rows.join(found, key_match(rows, found), "left")
    text = F.coalesce(F.col("row")[text_col].cast("string"), F.lit(""))
    word, other = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]", "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]"
    lead = F.regexp_extract(text, f"^({other}*)", 1)
    pieces = F.regexp_extract_all(text, F.lit(f"({word}+{other}*)"), F.lit(1))
    hit = lambda i: F.exists("spans", lambda s: (s["pos"] <= i) & (i < s["end"]))
    kept = F.concat(lead, F.array_join(F.filter(pieces, lambda p, i: ~hit(i)), ""))
    return joined.select(F.col("row").withField(text_col, F.when(F.col("spans").isNull(), F.col("row")[text_col]).otherwise(kept)).alias("row")).select("row.*")


def sql(size: int = SIZE) -> str:
    """DuckDB SQL for ``report``."""
    words = f"list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{NOT_WORD}'), lambda x: x <> '')"
    return f"""
WITH item AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {words} AS w FROM benchmark),
gram AS (SELECT DISTINCT item, len, gram FROM (
    SELECT item, {size} AS len, unnest(list_transform(range(1, len(w) - {size} + 2), lambda i: array_to_string(list_slice(w, i, i + {size} - 1), ' '))) AS gram
    FROM item WHERE len(w) >= {size}
    UNION ALL SELECT item, len(w), array_to_string(w, ' ') FROM item WHERE len(w) BETWEEN 1 AND {size} - 1)),
doc AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
lens AS (SELECT DISTINCT len FROM gram),
win AS (SELECT r, len, unnest(range(1, len(w) - len + 2)) AS pos,
               unnest(list_transform(range(1, len(w) - len + 2), lambda i: array_to_string(list_slice(w, i, i + len - 1), ' '))) AS gram
        FROM doc, lens WHERE len(w) >= len),
hit AS (SELECT r, pos, g.len, item FROM win JOIN gram g ON win.gram = g.gram AND win.len = g.len),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(pos, pos + len)) AS p FROM hit) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN n USING (r) LEFT JOIN i USING (r)
"""
