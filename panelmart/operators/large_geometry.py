"""Centroids of geometries of any size (G1), their vertices in chunks.

A row can't hold a coast line of a hundred million vertices.  Here the text of
a feature collection is split at every vertex, its chunks become runs of
consecutive vertices of one ring or line, and each run's partial sums of the
shoelace formula are combined by ring, then by feature.  An edge between two
runs belongs to the second; a ring's last edge is added when its sums are
complete.  No task holds more than a chunk of vertices.

The rule is that of :mod:`spatial`: areas, else lengths, else points.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StructType

from panelmart.operators.spatial import FLAT
from panelmart.session import cut_lineage, ship_package
from panelmart.sources.feature_collection import CHUNK, chunks, states, structure

_VERTEX = re.compile(rb"\[([^\[\]]*)\]")
_KEYS = {2: re.compile(rb'"features"\s*:\s*\Z'), 4: re.compile(rb'"geometry"\s*:\s*\Z'), 5: re.compile(rb'"coordinates"\s*:\s*\Z')}

_RUNS = ("file string, block long, seq long, run long, feature long, ring long, first boolean, listed long, geometry long, "
         "coordinates long, xs binary, ys binary, text string, inner boolean, features long, rings long")
_SCHEMA = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}[t])
                     for n, t in (f.split() for f in _RUNS.split(", "))])


def runs_of(text: bytes, in_string: int, depth: int) -> list[dict]:
    """Runs of vertices in one chunk, texts of features beside their
    coordinates, and as the last row what the next chunk inherits.

    ``feature`` and ``ring`` count from 0 in the chunk; -1 began before.
    ``listed``, ``geometry`` and ``coordinates`` say whether the run is in the
    features array, its geometry and the coordinates (null: as the chunk
    began).  Levels: features 2, feature 3, geometry 4, coordinates 5."""
    data = np.frombuffer(text, np.uint8)
    change, _ = structure(data, in_string)
    events = np.flatnonzero(change)
    level = np.cumsum(change[events], dtype=np.int64) + depth
    opens = change[events] == 1
    state: dict[int, int | None] = {2: None, 4: None, 5: None}
    features = rings = 0
    inside = depth >= 5             # in what may be coordinates
    plain = 0 if depth >= 3 and not inside else None
    out: list[dict] = []

    def flags() -> dict:
        return {"feature": features - 1, "listed": state[2], "geometry": state[4], "coordinates": state[5]}

    def rest(end: int) -> None:
        """Text of the feature up to here, coordinates left out."""
        if plain is not None and end > plain:
            out.append({**flags(), "text": text[plain:end].decode()})

    def segment(begin: int, end: int, lo: int, hi: int) -> None:
        """Vertices of text[begin:end], whose events are lo to hi.  Where the
        chunk can't tell that they are coordinates, the text goes out too."""
        nonlocal rings
        if None in (state[4], state[5]) and end > begin:
            out.append({**flags(), "text": text[begin:end].decode(), "inner": True})
        up, deep = opens[lo:hi], level[lo:hi]
        vertex = up & np.append(~up[1:], False) if hi > lo else up
        if not vertex.any():
            point = text[begin:end].split(b",") if hi == lo else []
            if len(point) > 1 and all(v.strip() for v in point[:2]):  # a Point's coordinates are its only vertex
                x, y = (np.array([float(v)]).tobytes() for v in point[:2])
                out.append({**flags(), "ring": rings - 1, "first": None, "xs": x, "ys": y})
            return
        ring_at = int(deep[vertex][0]) - 1
        starts = up & (deep == ring_at)
        owner = (np.cumsum(starts) - 1)[vertex]
        begins = np.flatnonzero(starts)
        shell = [bool(opens[lo + i - 1]) if lo + i else None for i in begins]  # the ring's "[" follows another one
        values = [v.split(b",") for v in _VERTEX.findall(text, begin, end)]
        points = np.array([(float(v[0]), float(v[1])) if len(v) > 1 else (np.nan, np.nan) for v in values])
        for r in range(-1, len(begins)):  # -1: goes on from before, or a line, which opens no ring
            mine = points[owner == r]
            mine = mine[~np.isnan(mine[:, 0])]
            if len(mine):
                out.append({**flags(), "ring": rings + r, "first": shell[r] if r >= 0 else None,
                            "xs": mine[:, 0].tobytes(), "ys": mine[:, 1].tobytes()})
        rings += len(begins)

    start, lo = 0, 0
    shallow = np.flatnonzero((opens & (level <= 5)) | (~opens & (level <= 4)))
    for i in shallow.tolist():
        at, n, up = int(events[i]), int(level[i]), bool(opens[i])
        if up and n in _KEYS:
            here = bool(_KEYS[n].search(text[max(0, at - 4096):at])) and data[at] == ord("{" if n == 4 else "[")
            here &= n != 5 or state[4] != 0  # a property may have that name
            state[n] = int(here)
            if n == 4:
                state[5] = 0
            if n == 5 and here:
                rest(at + 1)
                inside, start, lo, plain = True, at + 1, i + 1, None
        elif up and n == 3:
            features += 1
            plain, state[4], state[5] = at, 0, 0
        elif not up:
            if n == 4 and inside:
                segment(start, at, lo, i)
                inside, plain, state[5] = False, at, 0
            elif n == 3:
                state[4] = 0
            elif n == 2:
                rest(at + 1)
                plain = None
            elif n <= 1:
                state[2] = 0
    if inside:
        segment(start, len(text), lo, len(events))
    rest(len(text))
    out.append({"listed": state[2], "geometry": state[4], "coordinates": state[5], "features": features, "rings": rings})
    return out


def runs(chunk: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(runs, texts): the runs of vertices that are coordinates of features,
    with the numbers of feature and ring in the file; and the features' texts
    without coordinates, joined from their pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows = runs_of(r["text"], r["in_string"], r["depth"])
                place = {c: r[c] for c in ("file", "block", "seq")}
                cols = [pa.array([{**x, **place, "run": i}.get(f.name) for i, x in enumerate(rows)], f.type) for f in _SCHEMA]
                yield pa.record_batch(cols, schema=_SCHEMA)

    found = cut_lineage(chunk.select("file", "block", "seq", "text", "in_string", "depth").mapInArrow(run, _RUNS), "geojson-runs")
    order = W.partitionBy("file").orderBy("block", "seq").rowsBetween(W.unboundedPreceding, -1)
    sums = lambda c: F.coalesce(F.sum(c).over(order), F.lit(0))
    was = lambda c: F.coalesce(F.last(c, ignorenulls=True).over(order), F.lit(0))
    before = found.where("features is not null").select(
        "file", "block", "seq", sums("features").alias("f"), sums("rings").alias("r"), was("listed").alias("l"),
        was("geometry").alias("g"), was("coordinates").alias("c"))
    found = (found.where("features is null").join(before, ["file", "block", "seq"])
             .where(F.coalesce("listed", "l") == 1)
             .withColumns({"feature": F.col("f") + F.col("feature"), "ring": F.col("r") + F.col("ring")}))
    shape = (F.coalesce("geometry", "g") == 1) & (F.coalesce("coordinates", "c") == 1)
    texts = (found.where("text is not null").where(F.col("inner").isNull() | ~shape).groupBy("file", "feature")
             .agg(F.sort_array(F.collect_list(F.struct("block", "seq", "run", "text"))).alias("p"))
             .select("file", "feature", F.array_join(F.transform("p", lambda p: p["text"]), "").alias("text")))
    return found.where("xs is not null").where(shape).select("file", "feature", "ring", "block", "seq", "run", "first", "xs", "ys"), texts


def chain_sums(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Sums over the edges of an open chain about the origin: twice the area,
    six times its moments, length, and length times middles."""
    cross = x[:-1] * y[1:] - x[1:] * y[:-1]
    d = np.hypot(np.diff(x), np.diff(y))
    return (cross.sum(), ((x[:-1] + x[1:]) * cross).sum(), ((y[:-1] + y[1:]) * cross).sum(), d.sum(),
            (d * (x[:-1] + x[1:])).sum() / 2, (d * (y[:-1] + y[1:])).sum() / 2)


SUMS = ("a", "mx", "my", "len", "lx", "ly")


def ring_sums(vertices: DataFrame) -> DataFrame:
    """file, feature, ring, first, ox, oy (the feature's first vertex) and,
    about it: the sums of the ring's open chain, its ends, and n, px, py."""
    stored = cut_lineage(_ends(vertices), "geojson-ends")
    key, place = ["file", "feature"], F.struct("block", "seq", "run")
    origin = stored.groupBy(*key).agg(F.min_by(F.struct(F.col("x0").alias("ox"), F.col("y0").alias("oy")), place).alias("o"))
    before = W.partitionBy(*key, "ring").orderBy("block", "seq", "run")
    linked = (stored.withColumns({"px": F.lag("x1").over(before), "py": F.lag("y1").over(before)})
              .join(origin, key).select("file", "block", "seq", "run", "px", "py", "o.ox", "o.oy"))
    schema = pa.schema([("file", pa.string()), ("feature", pa.int64()), ("ring", pa.int64()), ("first", pa.bool_()),
                        ("block", pa.int64()), ("seq", pa.int64()), ("run", pa.int64()),
                        *((c, pa.float64()) for c in ("ox", "oy", *SUMS, "n", "px", "py", "x0", "y0", "x1", "y1"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                x, y = np.frombuffer(r["xs"]) - r["ox"], np.frombuffer(r["ys"]) - r["oy"]
                joined = (np.append(r["px"] - r["ox"], x), np.append(r["py"] - r["oy"], y)) if r["px"] is not None else (x, y)
                rows.append((*(r[c] for c in ("file", "feature", "ring", "first", "block", "seq", "run", "ox", "oy")), *chain_sums(*joined),
                             float(len(x)), x.sum(), y.sum(), x[0], y[0], x[-1], y[-1]))
            cols = list(zip(*rows, strict=True)) or [()] * len(schema)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    kinds = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean", pa.float64(): "double"}
    parts = vertices.join(linked, ["file", "block", "seq", "run"]).mapInArrow(
        run, ", ".join(f"{f.name} {kinds[f.type]}" for f in schema))
    return parts.groupBy("file", "feature", "ring").agg(
        F.max("first").alias("first"), F.first("ox").alias("ox"), F.first("oy").alias("oy"),
        *[F.sum(c).alias(c) for c in (*SUMS, "n", "px", "py")],
        F.min_by(F.struct("x0", "y0"), place).alias("begin"), F.max_by(F.struct("x1", "y1"), place).alias("end"))


def _ends(vertices: DataFrame) -> DataFrame:
    """First and last vertex of each run (narrow)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = ([np.frombuffer(v) for v in batch.column(c).to_pylist()] for c in ("xs", "ys"))
            ends = [[v[i] for v in vs] for vs, i in ((xs, 0), (ys, 0), (xs, -1), (ys, -1))]
            keep = ["file", "feature", "ring", "block", "seq", "run"]
            yield pa.record_batch([*(batch.column(c) for c in keep), *(pa.array(e, pa.float64()) for e in ends)],
                                  names=[*keep, "x0", "y0", "x1", "y1"])

    return vertices.mapInArrow(run, "file string, feature long, ring long, block long, seq long, run long, "
                               "x0 double, y0 double, x1 double, y1 double")


def read_centroids(spark: SparkSession, path, feature: StructType, most: int = CHUNK) -> DataFrame:
    """properties, type, latitude, longitude of the features of GeoJSON
    collections, geometries of any size; NULL where there is no vertex.
    Geometry collections aren't read (their coordinates lie deeper)."""
    ship_package(spark)
    stored = cut_lineage(chunks(spark, path, "]", most), "geojson-chunks")
    vertices, texts = runs(states(stored))
    rings = ring_sums(cut_lineage(vertices, "geojson-vertices"))
    named = texts.select("file", "feature", F.from_json("text", feature).alias("f")).select(
        "file", "feature", "f.properties", F.col("f.geometry.type").alias("type"))
    rings = rings.join(named.select("file", "feature", "type"), ["file", "feature"])
    area = F.col("type").isin("Polygon", "MultiPolygon")
    x0, y0, x1, y1 = F.col("end.x1"), F.col("end.y1"), F.col("begin.x0"), F.col("begin.y0")
    cross, d = x0 * y1 - x1 * y0, F.hypot(x1 - x0, y1 - y0)
    closing = {"a": cross, "mx": (x0 + x1) * cross, "my": (y0 + y1) * cross, "len": d, "lx": d * (x0 + x1) / 2, "ly": d * (y0 + y1) / 2}
    rings = rings.withColumns({c: F.col(c) + F.when(area, v).otherwise(0.0) for c, v in closing.items()})
    turn = F.when(area, F.signum("a") * F.when(F.col("first"), 1.0).otherwise(-1.0)).otherwise(0.0)
    total = rings.groupBy("file", "feature").agg(
        F.first("ox").alias("ox"), F.first("oy").alias("oy"), F.first("type").alias("type"),
        F.sum(F.col("a") * turn).alias("a"), F.sum(F.col("mx") * turn).alias("mx"), F.sum(F.col("my") * turn).alias("my"),
        F.sum(F.when(area, F.col("len") * F.col("len")).otherwise(0.0)).alias("closed"),
        *[F.sum(c).alias(c) for c in ("len", "lx", "ly", "n", "px", "py")],
        # without any length each ring or line is a point
        F.count(F.lit(1)).alias("rings"), F.sum("begin.x0").alias("bx"), F.sum("begin.y0").alias("by"))
    flat, dots = F.abs("a") <= FLAT * F.col("closed"), F.col("type").isin("Point", "MultiPoint")

    def at(o: str, m: str, l: str, p: str, b: str) -> F.Column:  # noqa: E741
        return F.col(o) + (F.when(dots, F.col(p) / F.col("n")).when(~flat, F.col(m) / (3.0 * F.col("a")))
                           .when(F.col("len") > 0, F.col(l) / F.col("len")).otherwise(F.col(b) / F.col("rings")))

    total = total.select("file", "feature", at("oy", "my", "ly", "py", "by").alias("latitude"),
                         at("ox", "mx", "lx", "px", "bx").alias("longitude"))
    return named.join(total, ["file", "feature"], "left").select("properties", "type", "latitude", "longitude")
