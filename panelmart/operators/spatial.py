"""Region centroid from GeoJSON geometry (G1) and code from property.

Planar centroid in source coordinates, of every geometry type.  The parts of
the highest dimension count: areas (holes subtracted), else lengths, else
points.  A polygon without area counts by the length of its rings, a line
without length as a point, a collection by all that it holds.

A geometry becomes an array of paths (points, lines and rings); each ring's
signed area and first moments come from the shoelace formula evaluated with
``aggregate`` over its points (JVM-side higher-order functions).  Shells count
positive and holes negative whatever their winding, as the common geometry
libraries do.  Sums are taken about the geometry's first vertex, so that a
small region far from the origin keeps its digits.  One feature is one row
and all work is per row: no shuffle.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from panelmart.functions.columns import normalize_code
from panelmart.session import ship_package
from panelmart.sources.readers import INPUT_ORDER

_POINT = ArrayType(DoubleType())
_RING = ArrayType(_POINT)
_POLY = ArrayType(_RING)
_MULTI = ArrayType(_POLY)
_PARTS = ArrayType(StructType([StructField("type", StringType()), StructField("coordinates", StringType())]))

#: Kinds of paths.
POINT, LINE, RING = range(3)
#: A ring's area counts when it is more than this share of its squared length:
#: rounding gives collinear rings areas of this size.
FLAT = 1e-14


def flat_parts(geometries: str | None) -> list[dict] | None:
    """The simple geometries in the JSON text of a collection's members, in
    order, collections in collections at any depth included."""
    if geometries is None:
        return None
    todo, out = [json.loads(geometries)], []
    while todo:
        g = todo.pop()
        if isinstance(g, list):
            todo.extend(reversed(g))
        elif isinstance(g, dict) and g.get("geometries") is not None:
            todo.append(g["geometries"])
        elif isinstance(g, dict) and g.get("coordinates") is not None:
            out.append({"type": g.get("type"), "coordinates": json.dumps(g["coordinates"])})
    return out


def parts(features: DataFrame, geometry: str = "geometry") -> F.Column:
    """array<type, coordinates text> of a feature's geometry.  Only
    collections, whose nesting has no bound, go through Python."""
    one = F.array(F.struct(F.col(f"{geometry}.type").alias("type"), F.col(f"{geometry}.coordinates").alias("coordinates")))
    if "geometries" not in features.schema[geometry].dataType.names:
        return one
    ship_package(features.sparkSession)

    @F.pandas_udf(_PARTS)
    def flat(texts: pd.Series) -> pd.Series:
        return texts.map(flat_parts)

    inner = F.when(F.col(f"{geometry}.type") == "GeometryCollection", F.col(f"{geometry}.geometries"))
    return F.when(inner.isNotNull(), flat(inner)).otherwise(one)


def _at(values, i) -> F.Column:
    """Element of an array, NULL where there is none."""
    return F.get(values, F.lit(i) if isinstance(i, int) else i)


def _path(kind: int, points, sign=None) -> F.Column:
    return F.struct(F.lit(kind).alias("kind"), (F.lit(0.0) if sign is None else sign).alias("sign"), points.alias("points"))


def _rings(poly) -> F.Column:
    return F.transform(poly, lambda r, i: _path(RING, r, F.when(i == 0, 1.0).otherwise(-1.0)))


def paths(parts_col) -> F.Column:
    """array<kind, sign, points> of the parts; empty ones are left out."""
    def of(p):
        t, c = p["type"], p["coordinates"]
        read = lambda kind: F.from_json(c, kind)
        return (F.when(t == "MultiPolygon", F.flatten(F.transform(read(_MULTI), _rings)))
                .when(t == "Polygon", _rings(read(_POLY)))
                .when(t == "MultiLineString", F.transform(read(_POLY), lambda x: _path(LINE, x)))
                .when(t == "LineString", F.array(_path(LINE, read(_RING))))
                .when(t == "MultiPoint", F.transform(read(_RING), lambda x: _path(POINT, F.array(x))))
                .when(t == "Point", F.array(_path(POINT, F.array(read(_POINT))))))

    found = F.flatten(F.array_compact(F.transform(parts_col, of)))
    return F.filter(found, lambda p: p["points"].isNotNull() & (F.size(_at(p["points"], 0)) > 1))


def _sums(**zero: float) -> F.Column:
    return F.struct(*[F.lit(v).alias(k) for k, v in zero.items()])


def _plus(acc, **more) -> F.Column:
    return F.struct(*[(acc[k] + v).alias(k) for k, v in more.items()])


def _seen_from(path, o) -> F.Column:
    """A path with its points as struct(x, y), seen from ``o``."""
    return F.struct(path["kind"].alias("kind"), path["sign"].alias("sign"), F.transform(path["points"], lambda p: F.struct(
        (_at(p, 0) - _at(o, 0)).alias("x"), (_at(p, 1) - _at(o, 1)).alias("y"))).alias("points"))


def _segments(path) -> F.Column:
    """array<sx, sy, cross, d>: a path's segments, each with the sums of its
    ends' coordinates, their cross product and its length; rings are closed.
    All that a segment adds to sums is made of these, computed once."""
    points = path["points"]
    n = F.size(points)
    ends = F.concat(F.slice(points, 2, n - 1), F.slice(points, 1, 1))
    closed = F.zip_with(points, ends, lambda a, b: F.struct(
        (a["x"] + b["x"]).alias("sx"), (a["y"] + b["y"]).alias("sy"),
        (a["x"] * b["y"] - b["x"] * a["y"]).alias("cross"),
        F.hypot(b["x"] - a["x"], b["y"] - a["y"]).alias("d")))
    return F.slice(closed, 1, F.when(path["kind"] == RING, n).otherwise(n - 1))


_ZERO = dict(a=0.0, mx=0.0, my=0.0, len=0.0, lx=0.0, ly=0.0)


def _measure(path) -> F.Column:
    """struct(a, mx, my, len, lx, ly, closed) of a path: a ring's doubled area
    and 6x first moments, shells positive, holes negative, whatever their
    winding; the length, the sums of the segments' lengths times their middles
    and the squared length of a ring."""
    def step(acc, s):
        return _plus(acc, a=s["cross"], mx=s["sx"] * s["cross"], my=s["sy"] * s["cross"],
                     len=s["d"], lx=s["d"] * s["sx"] / 2.0, ly=s["d"] * s["sy"] / 2.0)

    def finish(s):
        ring = path["kind"] == RING
        of_ring = lambda x: F.when(ring, x).otherwise(0.0)
        turn = F.signum(s["a"]) * path["sign"]
        return F.struct(*[of_ring(s[k] * turn).alias(k) for k in ("a", "mx", "my")],
                        *[s[k].alias(k) for k in ("len", "lx", "ly")], of_ring(s["len"] * s["len"]).alias("closed"))

    return F.aggregate(_segments(path), _sums(**_ZERO), step, finish)


def with_centroid(df: DataFrame, parts_col, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Add planar centroid columns for an array of simple geometries.

    Evaluated per row in a few projections, so that each sum is computed
    once and then read: one step per point, whatever is summed."""
    p, o = F.col("_paths"), F.col("_origin")
    seen = F.transform(F.filter(p, lambda x: x["kind"] != POINT), lambda x: _seen_from(x, o))
    sums = F.aggregate(F.transform(seen, _measure), _sums(**_ZERO, closed=0.0),
                       lambda acc, s: _plus(acc, **{k: s[k] for k in (*_ZERO, "closed")}))
    # where no path has a length, each is a point
    first = lambda x, axis: _at(_at(x["points"], 0), axis) - _at(o, axis)
    point = F.aggregate(p, _sums(n=0.0, px=0.0, py=0.0), lambda acc, x: _plus(
        acc, n=F.lit(1.0), px=first(x, 0), py=first(x, 1)))
    t, pt = F.col("_total"), F.col("_point")

    def at(axis: int, m: str, l: str, q: str) -> F.Column:  # noqa: E741
        return _at(o, axis) + (F.when(F.col("_flat"), F.when(t["len"] > 0, t[l] / t["len"]).when(pt["n"] > 0, pt[q] / pt["n"]))
                          .otherwise(t[m] / (t["a"] * 3.0)))

    out = (df.withColumn("_paths", paths(parts_col)).withColumn("_origin", _at(_at(p, 0)["points"], 0))
           .withColumn("_total", sums)
           .withColumn("_flat", F.abs(t["a"]) <= FLAT * t["closed"])
           .withColumn("_point", F.when(F.col("_flat") & (t["len"] == 0), point)))
    return (out.withColumns({lat: at(1, "my", "ly", "py"), lon: at(0, "mx", "lx", "px")})
            .drop("_paths", "_origin", "_total", "_flat", "_point"))


def centroids(features: DataFrame, id_field: str = "ID_KAB", name_field: str = "KABKOT",
              code_col: str = "kode_bps", name_col: str = "nama_geo") -> DataFrame:
    """features(properties, geometry{type, coordinates, geometries}) ->
    (code, name, latitude, longitude).  A feature without a geometry, or with
    an empty one, gets NULLs; ``geometries`` (text) may be left out.
    A recorded ``_input_order`` is passed through (stg_geo keeps the first
    feature per code as the file lists it)."""
    keep = [INPUT_ORDER] if INPUT_ORDER in features.columns else []
    base = features.select(
        normalize_code(F.col(f"properties.{id_field}")).alias(code_col),
        F.col(f"properties.{name_field}").alias(name_col),
        parts(features).alias("_parts"), *keep)
    return with_centroid(base, F.col("_parts")).select(code_col, name_col, "latitude", "longitude", *keep)
