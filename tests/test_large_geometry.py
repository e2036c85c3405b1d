"""Centroids from chunks of vertices against those of whole rows."""
import json
import math
import random

import pytest

from panelmart.operators import large_geometry, spatial
from panelmart.schemas import GEOJSON_FEATURE_COLLECTION
from panelmart.sources import readers
from tests.test_centroids import some

FEATURE = GEOJSON_FEATURE_COLLECTION["features"].dataType.elementType


def write(root, geometries, indent=None, coordinates_first=False):
    def feature(i, g):
        g = dict(reversed(g.items())) if coordinates_first and g else g
        extra = {"ID_KAB": str(i), "KABKOT": 'n"[{', "coordinates": [[1, 2]], "box": {"geometry": {"coordinates": [[[9, 9]]]}}}
        return {"type": "Feature", "geometry": g, "bbox": [0, 0, 1, 1], "properties": extra}

    doc = {"type": "FeatureCollection", "other": [{"geometry": {"type": "Point", "coordinates": [5, 5]}}],
           "features": [feature(i, g) for i, g in enumerate(geometries)]}
    path = f"{root}/a.json"
    with open(path, "w", encoding="utf-8") as f:
        json.dump(doc, f, indent=indent)
    return path


def streamed(spark, path, most):
    rows = large_geometry.read_centroids(spark, path, FEATURE, most).collect()
    return {int(r["properties"]["ID_KAB"]): (r["longitude"], r["latitude"]) for r in rows}


def whole(spark, path):
    rows = spatial.centroids(readers.read_geojson(spark, path, split=False)).collect()
    return {int(r["kode_bps"]): (r["longitude"], r["latitude"]) for r in rows}


@pytest.mark.parametrize("most, indent, turned", [(1, None, False), (90, 2, True), (1 << 20, None, True)])
def test_equal_to_whole_rows(spark, tmp_root, most, indent, turned):
    r = random.Random(21)
    geometries = [g for g in (some(r, 3) for _ in range(120)) if g["type"] != "GeometryCollection"] + [None]
    path = write(tmp_root, geometries, indent, turned)
    got, want = streamed(spark, path, most), whole(spark, path)
    assert got.keys() == want.keys()
    for i, g in enumerate(geometries):
        assert got[i] == (pytest.approx(want[i], abs=1e-9) if want[i][0] is not None else want[i]), (g, got[i], want[i])


def test_one_ring_in_many_chunks(spark, tmp_root):
    n, cx, cy = 60_000, 1.0e6, -2.0e5
    ring = [[cx + math.cos(2 * math.pi * i / n), cy + 2 * math.sin(2 * math.pi * i / n)] for i in range(n)]
    hole = [[cx + x, cy + y] for x, y in ((0.1, 0.1), (0.1, 0.3), (0.3, 0.3), (0.3, 0.1))]
    path = write(tmp_root, [{"type": "Polygon", "coordinates": [[*ring, ring[0]], [*hole, hole[0]]]}])
    stored = large_geometry.chunks(spark, path, "]", 50_000)
    assert stored.count() > 20
    (got,) = streamed(spark, path, 50_000).values()
    area = n / 2 * math.sin(2 * math.pi / n) * 2
    want = (cx - 0.04 * 0.2 / (area - 0.04), cy - 0.04 * 0.2 / (area - 0.04))
    assert got == pytest.approx(want, rel=0, abs=1e-9)


def test_runs_hold_one_chunk():
    """No run is longer than its chunk, and every vertex is in one run."""
    text = json.dumps({"features": [{"geometry": {"type": "Polygon", "coordinates": [[[i, i * i] for i in range(50)]]}}]}).encode()
    rows = large_geometry.runs_of(text, 0, 0)
    assert [len(r["xs"]) // 8 for r in rows if "xs" in r] == [50] and rows[-1]["rings"] == 1 and rows[-1]["features"] == 1
