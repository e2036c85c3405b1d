"""Splittable feature collections against a plain JSON parser."""
import json
import random

import pytest

from panelmart.operators import spatial
from panelmart.sources import feature_collection, readers


def feature(i, r):
    ring = [[r.uniform(0, 9), r.uniform(0, 9)] for _ in range(r.randint(4, 30))]
    name = r.choice(["plain", "br}ace{", 'quo"te', "back\\slash", "[x]", "\\\"}", "features\": [", "né 漢字"])
    return {"type": "Feature", "properties": {"ID_KAB": str(i), "KABKOT": name, "more": {"a": [1, {"b": "]}"}]}},
            "geometry": {"type": "Polygon", "coordinates": [ring]}}


def document(n, seed):
    r = random.Random(seed)
    return {"type": "FeatureCollection", "name": "x \"features\": [ {", "crs": {"type": "name", "properties": {"name": "y}"}},
            "other": [{"not": "a feature"}, {"features": [{"nested": 1}]}], "features": [feature(i, r) for i in range(n)],
            "after": [{"neither": 1}], "bbox": [0, 0, 9, 9]}


@pytest.fixture
def split_small(spark):
    """Byte ranges of a few hundred bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def got(spark, path, **kw):
    rows = feature_collection.feature_texts(spark, path, **kw).orderBy("file", "block", "row").collect()
    return [json.loads(r["text"]) for r in rows]


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("chunk, cut", [(1 << 20, "}"), (200, "}"), (1, "]")])
def test_features_in_file_order(spark, tmp_root, split_small, indent, chunk, cut):
    doc = document(25, 3)
    path = f"{tmp_root}/a.json"
    with open(path, "w", encoding="utf-8") as f:
        json.dump(doc, f, indent=indent, ensure_ascii=bool(indent))
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 5
    assert got(spark, path, cut=cut, most=chunk) == doc["features"]


def test_many_files_and_empty_ones(spark, tmp_root, split_small):
    docs = {"a": document(7, 1), "b": {"type": "FeatureCollection", "features": []}, "c": {}, "d": document(3, 2)}
    for name, doc in docs.items():
        with open(f"{tmp_root}/{name}.json", "w", encoding="utf-8") as f:
            f.write(json.dumps(doc) + "\n" * (name != "d"))
    open(f"{tmp_root}/e.json", "w").close()
    assert got(spark, tmp_root) == docs["a"]["features"] + docs["d"]["features"]


def test_reader_equals_the_json_reader(spark, tmp_root, split_small):
    path = f"{tmp_root}/a.json"
    with open(path, "w", encoding="utf-8") as f:
        json.dump(document(20, 5), f)
    rows = lambda df: [(r["kode_bps"], r["nama_geo"], r["latitude"], r["longitude"])
                       for r in spatial.centroids(df).orderBy("_input_order").collect()]
    split = rows(readers.read_geojson(spark, path))
    assert split == rows(readers.read_geojson(spark, path, split=False)) and len(split) == 20
    with open(f"{tmp_root}/lines.json", "w", encoding="utf-8") as f:
        f.writelines(json.dumps(x) + "\n" for x in document(20, 5)["features"])
    assert split == rows(readers.read_geojson(spark, f"{tmp_root}/lines.json", per_line=True))
