"""Feature-collection ingest, catalog scans and sinks.

A feature collection is read with an explicit schema (no inference) and
flattened with ``explode`` + struct/array access; nothing is parsed in Python.
Sinks overwrite whole datasets (a re-run never duplicates) and lay files out
by region, sorted by time inside each file, so Parquet min/max statistics
prune time ranges the way the reference's (region, time) index did.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid.functions.columns import nan_to_null
from riskgrid.schema import CHUNK_LIMIT, FEATURE_COLLECTION, MIN_MAGNITUDE, RAW_CATALOG

RAW_COLUMNS = [f.name for f in RAW_CATALOG.fields]


# ---------------------------------------------------------------------------
# S1 / S2 flatten
# ---------------------------------------------------------------------------

def flatten_features(collections: DataFrame, region: Column | str) -> DataFrame:
    """One row per feature of a ``features`` array column, as the 15-column raw catalog.

    coordinates = [lon, lat, depth_km]; ``mag`` -> magnitude, ``magType`` ->
    mag_type; epoch milliseconds -> UTC timestamp; NaN magnitudes -> null.
    """
    region = F.lit(region) if isinstance(region, str) else region
    f = collections.select(region.alias("_region"), F.explode("features").alias("f"))
    p, xyz = F.col("f.properties"), F.col("f.geometry.coordinates")
    return f.select(
        F.col("f.id").alias("id"),
        F.col("_region").alias("region"),
        F.timestamp_millis(p["time"]).alias("time"),
        p["place"].alias("place"),
        nan_to_null(p["mag"]).alias("magnitude"),
        p["magType"].alias("mag_type"),
        xyz[0].alias("longitude"),
        xyz[1].alias("latitude"),
        xyz[2].alias("depth_km"),
        p["nst"].alias("nst"),
        p["gap"].alias("gap"),
        p["dmin"].alias("dmin"),
        p["rms"].alias("rms"),
        p["type"].alias("type"),
        p["status"].alias("status"),
    )


def read_feature_collections(spark: SparkSession, path: str | list, region: str | None = None) -> DataFrame:
    """Landed feature-collection files (one JSON document per file), schema given.

    Without ``region`` the tag is the ``region=<name>`` folder of each file. A document is one
    task's work here; ``read_features`` cuts large ones.
    """
    raw = (spark.read.schema(FEATURE_COLLECTION).option("multiLine", True).json(path)
           .select("features", F.col("_metadata.file_path").alias("_path")))
    return flatten_features(raw, _tag(region))


def _tag(region: str | None) -> Column:
    """The given region, or the ``region=<name>`` folder in ``_path`` (a URL: blanks stand as %20, a plus for itself)."""
    if region:
        return F.lit(region)
    return F.url_decode(F.regexp_replace(F.regexp_extract("_path", r"region=([^/]+)", 1), r"\+", "%2B"))


#: What separates the features of a collection: each begins ``{"type": "Feature"``, with any white space.
BORDER = '"Feature"'
_NEXT, _FIRST = r',\s*\{\s*"type"\s*:\s*$', r'"features"\s*:\s*\[\s*\{\s*"type"\s*:\s*$'
_DOCUMENT, _EMPTY = '"FeatureCollection"', r'"features"\s*:\s*\[\s*\]'


def read_features(spark: SparkSession, path: str, region: str | None = None) -> DataFrame:
    """The same rows as ``read_feature_collections``, from documents of any size.

    Files are read as text records that end at ``"Feature"``, so Spark cuts one large document over many tasks
    at feature borders, and no task holds more than a feature or two. Strings of a document hold no bare quote, so
    the border is only ever a whole string; a record must end in the opening of the first or the next feature of a
    collection. Features between two borders (without a type) are read with the one before them. Files may hold several
    documents. A file is read whole instead (one document, one task, as ``read_feature_collections`` does) if a feature of
    it has its type elsewhere, holds a bare ``"Feature"`` inside or does not parse; one pass over the records finds such files.
    """
    text = spark.read.option("lineSep", BORDER).text(path).select("value", F.col("_metadata.file_path").alias("_path"))
    follows = F.col("value").rlike(r"^\s*,")
    body = F.concat(F.lit(f'[{{"type":{BORDER}'), F.regexp_replace("value", _NEXT, "]"))  # a collection's last feature brings its own end
    records = text.select("_path", follows.alias("follows"), F.col("value").rlike(_FIRST).alias("first"), F.col("value").rlike(_NEXT).alias("next"),
                          (F.regexp_count("value", F.lit(_DOCUMENT)) - F.regexp_count("value", F.lit(_EMPTY))).alias("filled"),
                          F.when(follows, F.from_json(body, FEATURE_COLLECTION["features"].dataType)).alias("features"))
    # Per file: all records but the last open a feature, all but the head go on with one, and every collection that is not empty opens its first.
    found = records.groupBy("_path").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("first") | F.col("next")).alias("opens"), F.count_if("follows").alias("follows"),
        F.count_if("first").alias("first"), F.sum("filled").alias("filled"), F.count_if(F.col("follows") & F.col("features").isNull()).alias("broken"))
    odd = found.where("opens != n - 1 OR follows != n - 1 OR first != filled OR broken > 0")
    odd = [r[0] for r in odd.select("_path").collect()]  # names of odd files
    cut = records.where("follows" if not odd else F.col("follows") & ~F.col("_path").isin(odd))
    out = flatten_features(cut.select("features", "_path"), _tag(region))
    if odd:
        out = out.unionByName(read_feature_collections(spark, [unquote(p) for p in odd], region))
    return out


def land_collections(events: DataFrame, path: str, page: int = CHUNK_LIMIT) -> None:
    """Write events as multi-feature collections, ``region=<tag>`` folders, pages of some ``page`` features (a service's
    page limit): what the service would have landed. Pages are numbered by hash, so no order of the whole is needed."""
    features = events_as_collections(events).select(
        F.col("source").alias("region"), F.get_json_object("json", "$.features[0]").alias("feature"), F.xxhash64("json").alias("_h"))
    counts = features.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / page).alias("_pages"))
    paged = features.join(counts, "region").withColumn("_page", F.pmod("_h", F.col("_pages")))
    docs = paged.groupBy("region", "_page").agg(F.array_join(F.sort_array(F.collect_list(F.regexp_replace("feature", r"^\{", '{"type":"Feature",'))), ",\n").alias("body"))
    text = F.concat(F.lit('{"type":"FeatureCollection","metadata":{"status":200},"features":['), F.col("body"), F.lit('],"bbox":[-180,-90,180,90]}'))
    docs.select("region", text.alias("value")).write.mode("overwrite").partitionBy("region").text(path)


def events_as_collections(events: DataFrame) -> DataFrame:
    """The events table re-shaped as one-feature collections (a JSON string per row).

    Gives the flatten path real input from the given tables: id, epoch ms, the
    ``props`` JSON, value as magnitude, event_type as the source tag.
    """
    key = F.col("event_id")
    feature = F.struct(
        F.concat(F.lit("ev"), key.cast("string")).alias("id"),
        F.struct(
            F.unix_millis(F.col("ts").cast("timestamp")).alias("time"),
            F.col("props").alias("place"),
            F.col("value").alias("mag"),
            F.lit("ml").alias("magType"),
            F.from_json("props", "k INT")["k"].alias("nst"),
            F.lit(None).cast("double").alias("gap"),
            F.lit(None).cast("double").alias("dmin"),
            F.lit(None).cast("double").alias("rms"),
            F.col("event_type").alias("type"),
            F.lit("reviewed").alias("status"),
        ).alias("properties"),
        F.struct(F.array(((key * 37) % 3600).cast("double") / 10 - 180,
                         ((key * 53) % 1800).cast("double") / 10 - 90,
                         F.col("value")).alias("coordinates")).alias("geometry"),
    )
    doc = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features")))
    return events.select(F.col("event_type").alias("source"), doc.alias("json"))


def parse_collections(docs: DataFrame, json_col: str = "json", tag_col: str = "source") -> DataFrame:
    parsed = docs.select(F.col(tag_col).alias("_tag"), F.from_json(json_col, FEATURE_COLLECTION).alias("fc"))
    return flatten_features(parsed.select("_tag", "fc.features"), F.col("_tag"))


# ---------------------------------------------------------------------------
# S3 / S6 / S7 / S9 sinks, S4 / S10 scans, S5 guard
# ---------------------------------------------------------------------------

def write_by_region(df: DataFrame, path: str, fmt: str = "parquet", time_col: str = "time",
                    partitions: int | None = None) -> None:
    """Overwrite ``path`` with one folder per region, files sorted by time.

    Range partitioning on (region, time) spreads a hot region over many tasks
    instead of sending it to one (a plain ``repartition(region)`` would).
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = df.repartitionByRange(n, "region", time_col).sortWithinPartitions("region", time_col)
    w = laid.write.mode("overwrite").partitionBy("region")
    if fmt == "csv":
        w.option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)
    else:
        w.format(fmt).save(path)


def read_catalog(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """Scan every region folder at once (the union of the per-region files)."""
    r = spark.read.schema(schema)
    if fmt == "csv":
        return r.option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").csv(path)
    return r.format(fmt).load(path)


def check_sources(df: DataFrame, expected) -> None:
    """Fail clearly when an expected region partition is absent."""
    present = {r[0] for r in df.select("region").distinct().collect()}
    missing = sorted(set(expected) - present)
    if missing:
        raise FileNotFoundError(f"missing input for regions: {missing}")


# ---------------------------------------------------------------------------
# S8 load verification, S11 recent snapshot, A6 chunk audit
# ---------------------------------------------------------------------------

def load_verify(df: DataFrame) -> DataFrame:
    """Total and per-region row counts (rollup: region null = total)."""
    return df.rollup("region").agg(F.count(F.lit(1)).alias("n"))


def recent_snapshot(events: DataFrame, ts: str = "ts", value: str = "value",
                    min_value: float = MIN_MAGNITUDE, hours: int = 24) -> DataFrame:
    """Events in [asof - hours, asof] above the floor; asof = the latest timestamp in the data."""
    asof = events.select(F.max(ts)).scalar()
    lo = asof - F.expr(f"INTERVAL {hours} HOURS")
    recent = events.filter((F.col(ts) >= lo) & (F.col(ts) <= asof) & (F.col(value) >= min_value))
    return recent.agg(
        F.count(F.lit(1)).alias("n_recent"),
        F.max(ts).alias("latest_ts"),
        F.max_by("event_id", F.struct(F.col(ts), F.col("event_id"))).alias("latest_event_id"),
        F.max(value).alias("max_value"),
    )


def chunk_audit(df: DataFrame, time_col: str = "time", limit: int = CHUNK_LIMIT) -> DataFrame:
    """Events per (region, year) and whether a per-year pull would hit the page limit."""
    return (df.groupBy("region", F.year(time_col).alias("year"))
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("at_limit", F.col("n") >= F.lit(limit)))
