"""Feature collections cut at feature borders over many tasks."""

import json

import pytest

from riskgrid.sources.ingest import read_feature_collections, read_features


def feature(i, **more):
    return {"type": "Feature", "properties": {"time": 1262304000000 + i, "mag": i % 9 / 2, "magType": "mw", "place": f'near "Feature {i}" \\ é\n{{"type": ', "type": "earthquake",
                                              "status": "reviewed", "nst": i, "felt": None, **more}, "geometry": {"type": "Point", "coordinates": [i % 360 - 180.0, i % 180 - 90.0, 5.0]}, "id": f"x{i}"}


def collection(features):
    return {"type": "FeatureCollection", "metadata": {"title": "a Feature list"}, "features": features, "bbox": [0, 1, 2]}


def land(root, name, text, region="middle east+1"):
    folder = root / f"region={region}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def rows(df):
    return sorted(map(str, df.collect()))


def test_one_large_document_is_read_by_many_tasks(spark, tmp_path):
    land(tmp_path, "big.json", json.dumps(collection([feature(i) for i in range(3000)])))
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        cut, whole = read_features(spark, str(tmp_path)), read_feature_collections(spark, str(tmp_path))
        assert cut.rdd.getNumPartitions() > 5 and whole.rdd.getNumPartitions() == 1
        got = rows(cut)
    finally:
        for k, v in zip(("maxPartitionBytes", "openCostInBytes"), kept):
            spark.conf.set(f"spark.sql.files.{k}", v)
    assert got == rows(whole) and len(got) == 3000
    assert cut.first()["region"] == "middle east+1" and cut.schema == whole.schema


@pytest.mark.parametrize("style", [{"separators": (",", ":")}, {"indent": 2}, {"ensure_ascii": False}])
def test_styles_of_writing(spark, tmp_path, style):
    land(tmp_path, "a.json", json.dumps(collection([feature(i) for i in range(20)]), **style), "a")
    land(tmp_path, "b.json", json.dumps(collection([]), **style), "b")
    land(tmp_path, "c.json", json.dumps(collection([feature(99)]), **style), "c")
    assert rows(read_features(spark, str(tmp_path))) == rows(read_feature_collections(spark, str(tmp_path)))


def test_several_documents_in_a_file(spark, tmp_path):
    land(tmp_path, "pages.json", "\n".join(json.dumps(collection([feature(i) for i in range(s, s + n)])) for s, n in ((0, 3), (3, 0), (3, 4))), "a")
    assert sorted(r["id"] for r in read_features(spark, str(tmp_path)).collect()) == [f"x{i}" for i in range(7)]


@pytest.mark.parametrize("odd", [
    {"id": "y", **feature(1)},  # the type is not the first key
    {k: v for k, v in feature(1).items() if k != "type"},
    feature(1, place="Feature"),  # a value that looks like the border
    feature(1, parent=feature(2)),  # a feature inside
    {**feature(1), "geometry": None},
])
def test_odd_files_are_read_whole(spark, tmp_path, odd):
    land(tmp_path, "odd.json", json.dumps(collection([feature(5), odd, feature(6)])), "odd one")
    land(tmp_path, "even.json", json.dumps(collection([feature(i) for i in range(10, 15)])), "b")
    got = read_features(spark, str(tmp_path))
    assert rows(got) == rows(read_feature_collections(spark, str(tmp_path))) and got.count() == 8
