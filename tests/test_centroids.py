"""Centroids of every geometry type against exact fractions."""
import json
import math
import random
from fractions import Fraction as Q

import pytest

from panelmart.operators import spatial

SCHEMA = ("properties struct<ID_KAB:string,KABKOT:string>, "
          "geometry struct<type:string,coordinates:string,geometries:string>")


def simple(g):
    if g["type"] == "GeometryCollection":
        return [x for m in g["geometries"] for x in simple(m)]
    t, c = g["type"], g["coordinates"]
    if t == "Point":
        return [("p", 1, [c])]
    if t == "MultiPoint":
        return [("p", 1, [x]) for x in c]
    if t == "LineString":
        return [("l", 1, c)]
    if t == "MultiLineString":
        return [("l", 1, x) for x in c]
    return [("r", 1 if i == 0 else -1, ring) for poly in ([c] if t == "Polygon" else c) for i, ring in enumerate(poly)]


def centroid(g):
    """By exact areas; lengths in doubles."""
    found = [(k, s, [(Q(p[0]), Q(p[1])) for p in pts]) for k, s, pts in simple(g) if pts]
    a = mx = my = Q(0)
    for k, s, pts in found:
        if k == "r":
            ring = [(p, q, p[0] * q[1] - q[0] * p[1]) for p, q in zip(pts, pts[1:] + pts[:1], strict=True)]
            area = sum(c for *_, c in ring)
            turn = (1 if area > 0 else -1 if area < 0 else 0) * s
            a += turn * area
            mx += turn * sum((p[0] + q[0]) * c for p, q, c in ring)
            my += turn * sum((p[1] + q[1]) * c for p, q, c in ring)
    if a:
        return float(mx / (3 * a)), float(my / (3 * a))
    parts = [(math.hypot(q[0] - p[0], q[1] - p[1]), (p[0] + q[0]) / 2, (p[1] + q[1]) / 2) for k, _, pts in found if k != "p"
             for p, q in zip(pts, pts[1:] + (pts[:1] if k == "r" else []), strict=False)]
    total = sum(d for d, *_ in parts)
    if total:
        return sum(d * float(x) for d, x, _ in parts) / total, sum(d * float(y) for d, _, y in parts) / total
    dots = [pts[0] for _, _, pts in found]
    return (float(sum(x for x, _ in dots) / len(dots)), float(sum(y for _, y in dots) / len(dots))) if dots else (None, None)


def run(spark, geometries):
    rows = [({"ID_KAB": str(i), "KABKOT": "x"}, g and {
        "type": g["type"], "coordinates": json.dumps(g["coordinates"]) if "coordinates" in g else None,
        "geometries": json.dumps(g["geometries"]) if "geometries" in g else None}) for i, g in enumerate(geometries)]
    got = {int(r["kode_bps"]): (r["longitude"], r["latitude"]) for r in spatial.centroids(spark.createDataFrame(rows, SCHEMA)).collect()}
    return [got[i] for i in range(len(rows))]


def some(r, depth=0):
    t = r.choice(["Point", "MultiPoint", "LineString", "MultiLineString", "Polygon", "MultiPolygon", "GeometryCollection"][:7 if depth < 3 else 6])
    pt = lambda: [r.randint(-8, 8), r.randint(-8, 8) / 4]
    pts = lambda n: [pt() for _ in range(n)]
    if t == "GeometryCollection":
        return {"type": t, "geometries": [some(r, depth + 1) for _ in range(r.randint(0, 3))]}
    box = lambda x, y, s: [[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]
    poly = lambda: r.choice([[box(*pt(), 8), box(1, 1, 1)[::r.choice([1, -1])]], [pts(5)], [[[0, 0], [1, 0], [3, 0]]], [[[2, 2]] * 4]])
    c = {"Point": pt, "MultiPoint": lambda: pts(r.randint(0, 4)), "LineString": lambda: r.choice([pts(3), [[1, 1], [1, 1]]]),
         "MultiLineString": lambda: [pts(2), pts(3)], "Polygon": poly, "MultiPolygon": lambda: [poly() for _ in range(r.randint(0, 3))]}
    return {"type": t, "coordinates": c[t]()}


def test_any_geometry(spark):
    r = random.Random(11)
    geometries = [some(r) for _ in range(250)]
    for g, got in zip(geometries, run(spark, geometries), strict=True):
        want = centroid(g)
        assert got == pytest.approx(want, abs=1e-9) if want[0] is not None else got == (None, None), (g, got, want)


def test_nothing_to_take_a_centroid_of(spark):
    odd = [None, {"type": "Polygon", "coordinates": []}, {"type": "Unknown", "coordinates": [1, 2]}, {"type": "GeometryCollection", "geometries": []},
           {"type": "Point", "coordinates": []}, {"type": "LineString"}, {"type": "Polygon", "coordinates": [[]]}]
    assert run(spark, odd) == [(None, None)] * len(odd)


def test_small_region_far_away_keeps_its_digits(spark):
    x, y, s = 1.0e7 + 0.125, -5.0e6, 2.0 ** -20
    ring = [[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]
    (got,) = run(spark, [{"type": "Polygon", "coordinates": [ring]}])
    assert got == (x + s / 2, y + s / 2)


def test_deep_collections(spark):
    g = {"type": "Point", "coordinates": [3, 4]}
    for _ in range(300):
        g = {"type": "GeometryCollection", "geometries": [g]}
    assert run(spark, [g]) == [(3.0, 4.0)]


def test_collinear_rings_count_by_length(spark):
    ring = [[0.1 * i, 0.3 * i] for i in (0, 1, 2, 7)]
    (got,) = run(spark, [{"type": "Polygon", "coordinates": [ring]}])
    assert got == pytest.approx((0.35, 1.05))
