"""Counts choose how a side is joined or tested; every way gives the same rows."""

import random

import pytest

pytest.importorskip("riskgrid.llm")

from riskgrid.llm import common, decontaminate, near_dup, pu_classifier, secrets, suffix_dedup  # noqa: E402

SF = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon".split()


def tables(spark):
    rnd = random.Random(8)
    items = [(i, " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 30)))) for i in range(40)] + [(40, "rho sigma"), (41, None), (None, "xi mu nu")]
    # One passage that stands in many items.
    items += [(100 + i, "one two three four five six seven eight nine ten") for i in range(30)]
    docs = []
    for i in range(150):
        text = " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 60)))
        if i % 3 == 0:
            text += ". " + (items[rnd.randrange(40)][1] or "").upper() + "! " + text[:40]
        if i % 10 == 0:
            text += " One two, three four five six seven eight nine TEN."
        docs.append((i, text))
    docs += [(3, docs[3][1]), (None, docs[6][1]), (500, None), (501, "")]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)



def test_decontamination_without_anchors_and_without_broadcast(spark, monkeypatch):
    docs, bench = tables(spark)
    want, spans = rows(decontaminate.report(docs, bench)), rows(decontaminate.decontaminate(docs, bench, remove="spans"))
    assert sum(r[5] for r in want) > 40
    for name, most in (("SCAN_ANCHORS", 3), ("BROADCAST_WINDOWS", 3), ("BROADCAST_WINDOWS", 0)):
        with monkeypatch.context() as m:
            m.setattr(decontaminate, name, most)
            assert rows(decontaminate.report(docs, bench)) == want
            assert rows(decontaminate.decontaminate(docs, bench, remove="spans")) == spans


def test_the_broadcast_of_windows_counts_the_items_in_them(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    bench = spark.createDataFrame([(i, "one two") for i in range(50)], "item_id long, text string")
    seen = []
    real = decontaminate.F.broadcast
    monkeypatch.setattr(decontaminate.F, "broadcast", lambda df: seen.append(1) or real(df))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 50)
    shuffled = rows(decontaminate.report(docs, bench))
    assert not seen
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 51)
    assert rows(decontaminate.report(docs, bench)) == shuffled and seen and shuffled[0][2:4] == (2, 50)


def test_small_sides_joined_by_shuffle_give_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    runs = {"suffix": lambda: suffix_dedup.remove_repeats(docs, 60), "near": lambda: near_dup.near_duplicates(docs, size=4).select("doc_id", "component_id", "kept"),
            "classifier": lambda: pu_classifier.classify(docs, labels), "secrets": lambda: secrets.find_secrets(docs)}
    want = {k: rows(run()) for k, run in runs.items()}
    monkeypatch.setattr(common, "BROADCAST_ITEMS", -1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {k: rows(run()) for k, run in runs.items()} == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
