"""Nearest neighbours by a block matrix join of int8 codes.

Vectors are packed into blocks.  Every block of queries meets every block of
candidates in a tile: one matrix product of their int8 codes gives all cosines
of the tile up to a bound, by the codes' exact quantisation errors.  A
candidate whose upper bound is below a query's k-th highest score so far (at
first: its k-th highest lower bound) of different vec_ids can't be near; the
survivors are computed again from the original vectors in double precision.
A table merges a query's hits over the tiles of a task, and a window over the
tasks.  The result is exact.

Blocks travel in groups: a cell of the grid joins a group of query blocks with
a group of candidate blocks, so that a candidate is copied once a query group
(65,536 queries of 64 components) and a query once a candidate group.  Blocks
hold the vectors as given; a task codes a block once it comes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from panelmart.llm.common import cut_lineage, prepare
from panelmart.llm.vectors import matrix, running_dot, unit, valid

K = 5
QUERY_BLOCK = 1024
BLOCK = 2048
#: Components of a group's vectors: a task holds a query group and streams
#: candidate groups past it.
QUERY_GROUP = 4 << 20
GROUP = 16 << 20
#: Cells of the grid at least, for as many tasks; a cell has a candidate block at least.
CELLS = 32
#: Components of the survivors that are computed again at a time.
CHUNK = 4 << 20

BLOCKS = "part int, seq int, n long, dim int, ids binary, vectors binary"


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales and errors (length of what the codes miss) of unit rows."""
    scale = np.abs(x).max(axis=1) / 127
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    return codes, scale, np.sqrt(((x - codes * scale[:, None]) ** 2).sum(axis=1))


def blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` vectors of one length (column vec_id, vector)."""
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n", pa.int64()), ("dim", pa.int32()),
                        ("ids", pa.binary()), ("vectors", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        held: dict[int, list] = {}

        def block(dim: int) -> pa.RecordBatch:
            nonlocal seq
            ids = np.concatenate([a for a, _ in held[dim]])
            x = np.concatenate([b for _, b in held[dim]])
            held[dim] = []
            seq += 1
            row = [part, seq, len(ids), dim, ids.tobytes(), x.tobytes()]
            return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            batch = batch.filter(pa.array(valid(batch.column("vector"))))
            kind = np.float32 if pa.types.is_float32(batch.column("vector").type.value_type) else np.float64
            dims = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                some = batch.filter(pa.array(dims == dim))
                for at in range(0, some.num_rows, size):
                    piece = some.slice(at, size)
                    held.setdefault(int(dim), []).append(
                        (piece.column("vec_id").to_numpy(), matrix(piece.column("vector")).astype(kind)))
                    if sum(len(a) for a, _ in held[int(dim)]) >= size:
                        yield block(int(dim))
        for dim in [d for d, x in held.items() if x]:
            yield block(dim)

    return vectors.mapInArrow(run, BLOCKS)


class Block:
    """A block as arrays."""

    def __init__(self, n: int, dim: int, ids: bytes, codes: bytes, scales: bytes, errors: bytes, vectors: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.errors = np.frombuffer(errors)
        # single precision makes a fast product; near() adds its rounding to the bound
        kind = np.float32 if dim <= 1040 else np.float64
        self.coded = (np.frombuffer(codes, np.int8).reshape(n, dim) * np.frombuffer(scales)[:, None]).astype(kind)
        self.vectors = floats(vectors, n, dim)
        x = self.vectors.astype(np.float64)
        self.lengths = np.sqrt(running_dot(x, x))

    @classmethod
    def of(cls, n: int, dim: int, ids: bytes, vectors: bytes) -> Block:
        """A stored block, with its codes, scales and errors."""
        codes, scale, error = encode(unit(floats(vectors, n, dim).astype(np.float64)))
        return cls(n, dim, ids, codes.tobytes(), scale.tobytes(), error.tobytes(), vectors)


def floats(vectors: bytes, n: int, dim: int) -> np.ndarray:
    """Rows of a block, in single or double precision as stored."""
    return np.frombuffer(vectors, np.float32 if len(vectors) == 4 * n * dim else np.float64).reshape(n, dim)


def near(q: Block, c: Block, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of queries and of candidates that can be among their k nearest in
    this tile, and their cosines, by query.  ``floor``: cosines that k other
    vec_ids are known to reach, by query; -inf where there are none yet."""
    # |u.v - u'.v'| <= |u - u'| |v| + |u'| |v - v'| with unit u, v; the last
    # component of the product adds the second term, so that it is an upper bound
    kind = q.coded.dtype
    slack = 1e-9 + 4 * (q.coded.shape[1] + 8) * np.finfo(kind).eps
    wide, error = (1 + q.errors).astype(kind), c.errors.astype(kind)
    upper = np.column_stack([q.coded, wide]) @ np.column_stack([c.coded, error]).T
    new = np.flatnonzero(np.isneginf(floor))
    if len(new):
        low = upper[new] - 2 * wide[new][:, None] * error[None, :]
        low -= (q.errors[new] + slack).astype(kind)[:, None]
        own = np.flatnonzero(np.isin(q.ids[new], c.ids))
        low[own] = np.where(q.ids[new][own][:, None] == c.ids[None, :], -np.inf, low[own])
        # the best of each vec_id: rows that repeat one are one candidate
        order = np.argsort(c.ids, kind="stable")
        starts = np.flatnonzero(np.append(True, np.diff(c.ids[order]) != 0))
        best = low if len(starts) == low.shape[1] else np.maximum.reduceat(low[:, order], starts, axis=1)
        if best.shape[1] > k:
            floor = floor.copy()
            floor[new] = np.partition(best, best.shape[1] - k, axis=1)[:, best.shape[1] - k]
    found = np.zeros(-(-upper.size // 8) * 8, bool)
    np.greater_equal(upper, (floor - q.errors - slack).astype(kind)[:, None],
                     out=found[:upper.size].reshape(upper.shape))
    eights = np.flatnonzero(found.view(np.uint64))  # few are found: eight at a time
    at = (eights[:, None] * 8 + np.arange(8))[found.reshape(-1, 8)[eights]]
    i, j = np.divmod(at, len(c.ids))
    other = q.ids[i] != c.ids[j]
    i, j = i[other], j[other]
    step = max(1, CHUNK // c.coded.shape[1])
    score = np.concatenate([np.empty(0), *(
        running_dot(q.vectors[i[a:a + step]].astype(np.float64), c.vectors[j[a:a + step]].astype(np.float64))
        for a in range(0, len(i), step))])
    return i, j, score / (q.lengths[i] * c.lengths[j])


def tile(q: Block, c: Block, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, candidate ids, cosines) of candidates that can be among the
    k nearest of the query in this tile."""
    i, j, score = near(q, c, k, np.full(len(q.ids), -np.inf))
    rows, starts, counts = np.unique(i, return_index=True, return_counts=True)
    return [(int(q.ids[r]), c.ids[j[a:a + n]], score[a:a + n]) for r, a, n in zip(rows, starts, counts, strict=True)]


class Best:
    """The k nearest so far of a block's queries, the nearest first."""

    def __init__(self, q: Block, k: int):
        self.q, self.k = q, k
        self.ids, self.scores = np.zeros((len(q.ids), k), np.int64), np.full((len(q.ids), k), -np.inf)

    def meet(self, c: Block) -> None:
        """Take in a block of candidates."""
        i, j, score = near(self.q, c, self.k, self.scores[:, -1])
        rows = np.unique(i)
        row = np.concatenate([np.repeat(rows, self.k), i])
        ids, score = np.concatenate([self.ids[rows].ravel(), c.ids[j]]), np.concatenate([self.scores[rows].ravel(), score])
        there = np.isfinite(score) & (score >= self.scores[row, -1])
        row, ids, score = row[there], ids[there], score[there]
        # a vec_id counts once, with its nearest row
        order = np.lexsort((-score, ids, row))
        row, ids, score = row[order], ids[order], score[order]
        once = np.append(True, (np.diff(row) != 0) | (np.diff(ids) != 0))[:len(row)]
        row, ids, score = row[once], ids[once], score[once]
        order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        first = place < self.k
        self.scores[rows] = -np.inf
        self.ids[row[first], place[first]], self.scores[row[first], place[first]] = ids[first], score[first]

    def found(self) -> pa.RecordBatch:
        i, place = np.nonzero(np.isfinite(self.scores))
        return pa.record_batch([pa.array(self.q.ids[i]), pa.array(self.ids[i, place]), pa.array(self.scores[i, place])],
                               names=["query_id", "vec_id", "score"])


def grid(q_size: int, c_size: int, n_blocks: int) -> tuple[int, int]:
    """Query groups and candidate groups, of so many components in ``n_blocks``
    candidate blocks."""
    n_q = max(1, -(-q_size // QUERY_GROUP))
    return n_q, max(1, min(n_blocks, max(-(-c_size // GROUP), -(-CELLS // n_q))))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k candidates of highest
    cosine, ties to the smaller vec_id, of each row of ``queries``.

    Both tables have vec_id and embedding.  Rows with a null vec_id, and
    vectors that are null, empty, zero or hold null or non-finite components,
    take no part; vectors are compared with those of their length only.  A
    candidate with the query's vec_id is the query's own.  Rows that repeat a
    vec_id and vector count once; of other rows with one vec_id the nearest
    counts.  Fewer than k candidates: all; empty tables: no rows.
    """
    prepare(vectors.sparkSession)

    def rows(t: DataFrame) -> DataFrame:
        kind = t.schema["embedding"].dataType.simpleString()
        vector = F.col("embedding") if kind == "array<float>" else F.col("embedding").cast("array<double>")
        return t.where("vec_id is not null").select(F.col("vec_id").cast("long"), vector.alias("vector")).distinct()

    c = cut_lineage(blocks(rows(vectors), BLOCK), "candidates")
    q = cut_lineage(blocks(rows(queries), QUERY_BLOCK), "queries")
    # a cell of a grid: a group of query blocks with a group of candidate blocks
    size = F.coalesce(F.sum(F.col("n") * F.col("dim")), F.lit(0))
    n_blocks, c_size = c.agg(F.count(F.lit(1)), size).first()
    n_q, n_c = grid(q.agg(size).first()[0], c_size, n_blocks)
    load = F.struct("n", "dim", "ids", "vectors")
    group = lambda n: F.pmod(F.xxhash64("part", "seq"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = c.select(group(n_c).alias("cg"), "dim", F.struct("part", "seq").alias("c_at"), load.alias("c"), every(n_q).alias("qg"))
    right = q.select(group(n_q).alias("qg"), F.col("dim").alias("q_dim"), F.struct("part", "seq").alias("q_at"), load.alias("q"),
                     every(n_c).alias("cg"))
    # Spark's size of a side leaves out the copies: by it a side that copies
    # make many times larger would go through the driver as a broadcast
    pairs = left.hint("merge").join(right, ["qg", "cg"]).where("dim = q_dim").select("qg", "c_at", "c", "q_at", "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Best] = {}
        last, last_c, c_block = None, None, None
        for batch in batches:
            for qg, c_at, c_row, q_at, q_row in zip(*batch.columns, strict=True):
                qg, c_at, q_at = qg.as_py(), tuple(c_at.as_py().values()), tuple(q_at.as_py().values())
                if qg != last:  # the cells of a query group come one after the other
                    yield from (x.found() for x in held.values())
                    last, held = qg, {}
                if c_at != last_c:
                    last_c, c_block = c_at, Block.of(**c_row.as_py())
                if q_at not in held:
                    held[q_at] = Best(Block.of(**q_row.as_py()), k)
                held[q_at].meet(c_block)
        yield from (x.found() for x in held.values())

    hits = pairs.mapInArrow(run, "query_id long, vec_id long, score double")
    hits = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # at most k rows a task
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
