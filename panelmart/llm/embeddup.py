"""Near-duplicate embeddings by collision-counting projections.

Vectors of a label are projected on many random directions.  On each, the
sorted values give every query a window of half-width ``WINDOW`` times the
largest distance that two linked unit vectors can have.  A pair whose windows
collide on at least ``threshold`` of the projections is verified; the
threshold is calibrated so that a pair at the wanted cosine is missed with a
chance below ``MISSED``.

Blocks are runs of vectors in the order of the first projection; a tile is
a pair of blocks of one label that are near enough on it.  A tile sends a
row for each vector at most: how many it links with, and a spanning link.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmart.llm.common import cut_lineage, prepare
from panelmart.llm.components import components
from panelmart.llm.vectors import cosine, matrix, unit, valid

COSINE = 0.93
PROJECTIONS = 48
WINDOW = 1.0
MISSED = 1e-6
BLOCK = 1024
SEED = 5

SCHEMA = "part int, seq int, label int, dim int, lo double, hi double, n long, ids binary, counts binary, vectors binary"


def largest_distance(cos: float) -> float:
    """Distance of unit vectors with that cosine."""
    return math.sqrt(2 - 2 * cos)


def normal_within(z: float) -> float:
    """Chance that a standard normal value lies within +-z."""
    return math.erf(z / math.sqrt(2))


@functools.lru_cache(maxsize=8)
def threshold(projections: int = PROJECTIONS, window: float = WINDOW, missed: float = MISSED) -> int:
    """Most collisions that a pair at the wanted cosine fails to reach with a
    chance below ``missed``: on each direction its difference is normal."""
    p, below = normal_within(window), 0.0
    for count in range(projections + 1):
        below += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if below > missed:
            return count
    return projections


def reach(missed: float = MISSED) -> float:
    """Difference on the first projection, in units of the largest distance,
    that a linked pair exceeds with a chance below ``missed``."""
    z = 1.0
    while 1 - normal_within(z) > missed:
        z += 0.01
    return z


@functools.lru_cache(maxsize=8)
def directions(dim: int, projections: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    """Random directions: normal components, one column each."""
    return np.random.default_rng(seed).standard_normal((dim, projections))


def classes(vectors: DataFrame) -> DataFrame:
    """id (smallest vec_id), copies, label, vector, first (projection) of the
    vectors that take part, one row for each distinct vector of a label."""
    rows = vectors.where("vec_id is not null AND label is not null").select(
        F.col("vec_id").cast("long"), F.col("label").cast("int"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.distinct().groupBy("label", "vector").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(valid(batch.column("vector"))))
            first = np.zeros(batch.num_rows)
            dims = np.array([len(v) for v in batch.column("vector")], np.int64)
            for dim in np.unique(dims):
                some = dims == dim
                first[some] = unit(matrix(batch.column("vector").filter(pa.array(some)))) @ directions(int(dim))[:, 0]
            yield batch.append_column("dim", pa.array(dims, pa.int32())).append_column("first", pa.array(first))

    return rows.mapInArrow(run, "label int, vector array<double>, id long, copies long, dim int, first double")


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Runs of at most ``size`` rows of one label and length, in the order of
    the first projection."""
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("label", pa.int32()), ("dim", pa.int32()),
                        ("lo", pa.float64()), ("hi", pa.float64()), ("n", pa.int64()), ("ids", pa.binary()),
                        ("counts", pa.binary()), ("vectors", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq, held, key = TaskContext.get().partitionId(), 0, [], None

        def block() -> pa.RecordBatch:
            ids, copies, first, x = (np.concatenate(c) for c in zip(*held, strict=True))
            row = [part, seq, *key, first.min(), first.max(), len(ids), ids.tobytes(), copies.tobytes(), x.tobytes()]
            held.clear()
            return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            label, dim = (batch.column(c).to_numpy() for c in ("label", "dim"))
            cuts = np.nonzero((np.diff(label) != 0) | (np.diff(dim) != 0))[0] + 1
            for a, b in zip([0, *cuts], [*cuts, len(label)], strict=True):
                if a == b:
                    continue
                if held and key != (int(label[a]), int(dim[a])):
                    yield block()
                    seq += 1
                key = (int(label[a]), int(dim[a]))
                while a < b:
                    have = sum(len(x[0]) for x in held)
                    piece = batch.slice(a, min(b - a, size - have))
                    held.append((piece.column("id").to_numpy(), piece.column("copies").to_numpy(),
                                 piece.column("first").to_numpy(), matrix(piece.column("vector"))))
                    a += piece.num_rows
                    if have + piece.num_rows >= size:
                        yield block()
                        seq += 1
        if held:
            yield block()

    return (rows.repartitionByRange("label", "dim", "first").sortWithinPartitions("label", "dim", "first", "id")
            .mapInArrow(run, SCHEMA))


class Side:
    """A block of a tile, with its projections sorted."""

    def __init__(self, dim: int, n: int, ids: bytes, counts: bytes, vectors: bytes, **_):
        self.ids, self.counts = np.frombuffer(ids, np.int64), np.frombuffer(counts, np.int64)
        self.vectors = np.frombuffer(vectors).reshape(n, dim)
        self.values = unit(self.vectors) @ directions(dim)
        self.sorted = np.sort(self.values, axis=0)
        self.ranks = np.empty(self.values.shape, np.uint16)
        np.put_along_axis(self.ranks, np.argsort(self.values, axis=0), np.arange(n, dtype=np.uint16)[:, None], axis=0)


def collisions(a: Side, b: Side, half: float) -> np.ndarray:
    """On how many projections each vector of ``b`` lies in the window around
    each of ``a``: a window is a run of ranks of the sorted values."""
    count = np.zeros((len(a.ids), len(b.ids)), np.uint8)
    for p in range(a.values.shape[1]):
        lo = np.searchsorted(b.sorted[:, p], a.values[:, p] - half, "left").astype(np.uint16)
        width = np.searchsorted(b.sorted[:, p], a.values[:, p] + half, "right").astype(np.uint16) - lo
        count += (b.ranks[None, :, p] - lo[:, None]) < width[:, None]
    return count


def links_of(a: Side, b: Side, cos: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of the verified pairs of a tile, i < j in one block."""
    count = collisions(a, b, WINDOW * largest_distance(cos))
    i, j = np.nonzero(count >= threshold())
    if same:
        i, j = i[i < j], j[i < j]
    good = np.zeros(len(i), bool)
    for at in range(0, len(i), 50_000):
        some = slice(at, at + 50_000)
        good[some] = cosine(a.vectors[i[some]], b.vectors[j[some]]) >= cos
    return i[good], j[good]


def _roots(n: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id of each of ``n`` nodes' component under the pairs."""
    root = ids.copy()
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == root).all():
            return root
        root = new


def near_duplicates(vectors: DataFrame, cos: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Reads vec_id, embedding and label.  Only vectors of one label and length
    are compared.  A null vec_id or label, or a vector that is null, empty,
    zero or holds null or non-finite components, links with nothing; a null
    vec_id has a null component and is not kept.  Repeated rows count as one
    vector and each give a row; rows with one vec_id and different vectors
    count as one in the components.  Empty table: no rows.
    """
    prepare(vectors.sparkSession)
    distinct = cut_lineage(classes(vectors), "vectors")
    runs = cut_lineage(blocks(distinct, BLOCK), "blocks")
    a = runs.select("label", "dim", *[F.col(c).alias(f"a_{c}") for c in ("part", "seq", "lo", "hi")])
    b = runs.select("label", "dim", *[F.col(c).alias(f"b_{c}") for c in ("part", "seq", "lo", "hi")])
    gap = reach() * largest_distance(cos)
    tiles = a.join(b, ["label", "dim"]).where(
        ((F.col("a_part") < F.col("b_part")) | ((F.col("a_part") == F.col("b_part")) & (F.col("a_seq") <= F.col("b_seq"))))
        & (F.col("b_lo") - F.col("a_hi") <= gap)).drop("a_lo", "a_hi", "b_lo", "b_hi")
    load = F.struct("dim", "n", "ids", "counts", "vectors")
    for side in ("a", "b"):
        side_rows = runs.select("label", "dim", F.col("part").alias(f"{side}_part"),
                                F.col("seq").alias(f"{side}_seq"), load.alias(side))
        tiles = tiles.join(side_rows, ["label", "dim", f"{side}_part", f"{side}_seq"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row_a, row_b in zip(batch.column("a"), batch.column("b"), strict=True):
                row_a, row_b = row_a.as_py(), row_b.as_py()
                same = row_a["ids"] == row_b["ids"]
                left = Side(**row_a)
                right = left if same else Side(**row_b)
                i, j = links_of(left, right, cos, same)
                ids = left.ids if same else np.concatenate([left.ids, right.ids])
                copies = left.counts if same else np.concatenate([left.counts, right.counts])
                j = j if same else j + len(left.ids)
                more = (np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))).astype(np.int64)
                hit = np.nonzero(more)[0]
                root = _roots(len(ids), i, j, ids)
                yield pa.record_batch([pa.array(ids[hit]), pa.array(more[hit]), pa.array(root[hit])],
                                      names=["id", "n", "root"])

    found = cut_lineage(tiles.select("a", "b").mapInArrow(run, "id long, n long, root long"), "tile_links")
    sums = found.groupBy("id").agg(F.sum("n").alias("n"))
    joined = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    lead = (distinct.select("label", "vector", "id", "copies").join(sums, "id", "left")
            .join(joined, "id", "left")
            .select(F.col("label").alias("label_"), F.col("vector").alias("vector_"),
                    (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                    F.coalesce("component", "id").alias("component")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"),
                          F.col("embedding").cast("array<double>").alias("vector"))
    out = rows.join(lead, (rows["label"] == lead["label_"]) & (rows["vector"] == lead["vector_"])
                    & rows["vec_id"].isNotNull(), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
