"""The corpus pipeline: five stages, each on all that the one before it kept.

Classifier, line dedup, near-dedup, benchmark decontamination, mixing. Each stage takes
``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as
the next stage's ``docs``. All but the last return the columns of ``docs``, whatever they are;
texts that change get a new ``n_chars`` if there is one. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid.llm import decontaminate, line_templates, mixing, near_dup, pu_classifier
from riskgrid.llm.common import KEY, if_small, key_columns, key_match, materialize, read


def _rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as one struct, beside their keys: no clash with any column."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *key_columns("doc_id", "text"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    judged = pu_classifier.classify(docs, read(spark, sf_dir, "labels"), keyed=True).where("predicted = 0").select(*KEY).distinct()
    rows = _rows(docs)
    return rows.join(judged, key_match(rows, judged), "left_anti").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go; every document stays."""
    out = line_templates.drop_recurring_lines(docs)
    row = F.col("row").withField("text", F.when(F.col("n_dropped") > 0, F.col("text_kept")).otherwise(F.col("row.text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.when(F.col("n_dropped") > 0, F.length("text_kept").cast(kind)).otherwise(F.col("row.n_chars")))
    return out.select(row.alias("row")).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: that with the smallest id, then text hash (null ids last); of equal rows, one."""
    found = materialize(near_dup.near_duplicates(docs, size=5, percent=80, groups=True).where("n_shingles > 0").select(*KEY, "group"), "groups")
    order = F.struct(F.col(KEY[0]).isNull(), *KEY)
    first = if_small(materialize(found.groupBy("group").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1"), "group-firsts"))
    gone = found.join(first, "group").where(order != F.col("first")).select(*KEY).distinct()
    rows = _rows(docs)
    kept = rows.join(gone, key_match(rows, gone), "left_anti")
    repeated = docs.select(*key_columns("doc_id", "text")).groupBy(*KEY).count().where("count > 1")
    return (kept if repeated.isEmpty() else kept.dropDuplicates(list(KEY))).select("row.*")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All sources get the same weight; the mix is as large as the stage's input."""
    return mixing.mix(docs)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("source_mixing", mixing_weights),
]

#: The classifier and the near-duplicate links have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
