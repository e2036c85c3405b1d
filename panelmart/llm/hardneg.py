"""Hard negatives from Hilbert-ordered blocks with zone maps.

Vectors become whole numbers and are sorted by label and by their place on a
Hilbert curve, so that a Parquet row holds a block of vectors that lie close
together, with the least and the largest value of each dimension: its zone
map.  Interval arithmetic on a zone map bounds the inner products of an anchor
with the block's rows from both sides.  An anchor's positives need the blocks
of its label whose upper bound reaches the scores of its home block; its
negatives need the blocks of other labels whose interval meets a window below
a positive's score.  Only chosen blocks are sent to the anchors.  Products of
whole numbers are exact, so that the result is too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from panelmart.llm.common import cut_lineage, prepare

POSITIVES, NEGATIVES = 5, 3
#: Window of negative scores, in percent of the positive's score.
LOW, HIGH = 50, 95
#: Components become floor(SCALE * x).
SCALE = 256
#: Rows of a block, zone maps of a chunk, anchors of a chunk.
BLOCK, ZONES, ANCHORS = 128, 256, 512
#: Blocks of a reading cell (one task's work for one chunk of anchors), and
#: blocks multiplied at a time.
CELL, AT_ONCE = 256, 8
#: Bits of a dimension on the curve, and bytes of the curve's key that sort.
BITS, KEY_BYTES = 4, 16


# --- blocks ------------------------------------------------------------------

def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve through a grid of 2**bits cells a dimension,
    as rows of bits, highest first (Skilling's transform, column by column)."""
    x = cells.astype(np.int64).T.copy()
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(len(x)):
            swap = np.where(x[i] & q, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(x[i] & q, q - 1, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn, q = np.zeros(x.shape[1], np.int64), 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    planes = [(x >> b) & 1 for b in reversed(range(bits))]
    return np.concatenate(planes).T.astype(np.uint8)


def _kind(least: int, most: int, dim: int) -> tuple[np.dtype, np.dtype]:
    """Types of codes, and of products that hold all scores exactly."""
    for name in ("i1", "i2", "i4", "i8"):
        code = np.dtype(name)
        if np.iinfo(code).min <= least and most <= np.iinfo(code).max:
            break
    return code, np.dtype("f8" if dim * max(abs(least), abs(most)) ** 2 < 1 << 53 else "i8")


def take_part(vectors: DataFrame) -> DataFrame:
    """vec_id, label, anchor and codes of the rows that take part."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    code = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    return (vectors.where("vec_id is not null and label is not null and size(embedding) > 0").where(good)
            .select(F.col("vec_id").cast("long"), F.col("label").cast("long"),
                    F.coalesce("anchor", F.lit(False)).alias("anchor"), code.alias("codes")))


def keyed(points: DataFrame, least: int, most: int, dim: int) -> DataFrame:
    """The points with their key on the curve, codes as bytes."""
    code, _ = _kind(least, most, dim)
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("anchor", pa.bool_()), ("dim", pa.int32()),
                        ("key", pa.binary()), ("codes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("codes")
            sizes = lists.value_lengths().to_numpy()
            for d in np.unique(sizes):
                some = batch.filter(pa.array(sizes == d))
                x = some.column("codes").flatten().to_numpy().reshape(-1, d)
                cells = ((x.astype(np.float64) - least) * ((1 << BITS) / (most - least + 1))).astype(np.int64)
                keys = np.packbits(hilbert(np.clip(cells, 0, (1 << BITS) - 1), BITS), axis=1)[:, :KEY_BYTES]
                yield pa.record_batch([some.column("vec_id"), some.column("label"), some.column("anchor"),
                                       pa.array(np.full(len(x), d, np.int32)), pa.array([k.tobytes() for k in keys], pa.binary()),
                                       pa.array([c.tobytes() for c in x.astype(code)], pa.binary())], schema=schema)

    return points.mapInArrow(run, "vec_id long, label long, anchor boolean, dim int, key binary, codes binary")


BLOCKS = "block long, dim int, label long, n int, ids binary, anchors binary, codes binary, lows binary, highs binary, first long"


def blocks(points: DataFrame, code: np.dtype) -> DataFrame:
    """Blocks of up to ``BLOCK`` rows of one label that follow each other on
    the curve; rows in a block are in order of vec_id.  Rows that repeat
    vec_id, label and codes are one row."""
    names = [f.split()[0] for f in BLOCKS.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 5, pa.int64()]
    schema = pa.schema(list(zip(names, types, strict=True)))
    size = BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq, held, group, last = TaskContext.get().partitionId(), 0, [], None, None

        def block() -> list:
            nonlocal seq, held
            held.sort()
            x = np.frombuffer(b"".join(c for _, c, _ in held), code).reshape(len(held), -1)
            row = [(part << 32) + seq, group[0], group[1], len(held), np.array([i for i, _, _ in held], np.int64).tobytes(),
                   np.array([a for _, _, a in held], np.bool_).tobytes(), x.tobytes(),
                   x.min(axis=0).tobytes(), x.max(axis=0).tobytes(), held[0][0]]
            seq, held = seq + 1, []
            return row

        for batch in batches:
            rows = []
            for dim, label, vec_id, codes, anchor in zip(*(batch.column(c).to_pylist() for c in ("dim", "label", "vec_id", "codes", "anchor")), strict=True):
                if (dim, label, vec_id, codes) == last:
                    continue
                if held and ((dim, label) != group or len(held) == size):
                    rows.append(block())
                group, last = (dim, label), (dim, label, vec_id, codes)
                held.append((vec_id, codes, anchor))
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], schema=schema)
        if held:
            yield pa.record_batch([pa.array([v], t) for v, t in zip(block(), types, strict=True)], schema=schema)

    order = ["dim", "label", "key", "vec_id"]
    return points.repartitionByRange(*order).sortWithinPartitions(*order, "codes", F.desc("anchor")).mapInArrow(run, BLOCKS)


# --- anchors and zones -------------------------------------------------------

CHUNKS = "chunk long, dim int, ids binary, labels binary, codes binary, floors binary, floor_ids binary"


def _none(kind: np.dtype) -> float | int:
    """Stands for the score of a row that is none."""
    return -np.inf if kind.kind == "f" else int(np.iinfo(kind).min)


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores of each row and their columns, the first of equal
    ones; ``scores`` is used up."""
    rows, high, out = np.arange(len(scores)), [], []
    for _ in range(min(k, scores.shape[1])):
        at = scores.argmax(axis=1)
        out.append(at)
        high.append(scores[rows, at])
        scores[rows, at] = _none(scores.dtype)
    return np.stack(high, 1), np.stack(out, 1)


def anchor_chunks(stored: DataFrame, code: np.dtype, product: np.dtype, k: int) -> DataFrame:
    """Chunks of up to ``ANCHORS`` anchors, with the score and vec_id of the
    k-th best row in the anchor's home block, below which a positive can't
    lie (lowest numbers where the block has fewer rows)."""
    names = [f.split()[0] for f in CHUNKS.split(", ")]
    types = [pa.int64(), pa.int32(), *[pa.binary()] * 5]
    schema = pa.schema(list(zip(names, types, strict=True)))
    lowest, size = np.iinfo(np.int64).min, ANCHORS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        held: dict[int, list[tuple]] = {}

        def chunk(dim: int) -> pa.RecordBatch:
            nonlocal seq
            ids, labels, codes, floors, floor_ids = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
            seq += 1
            row = [(part << 32) + seq, dim, ids.tobytes(), labels.tobytes(), codes.tobytes(), floors.tobytes(), floor_ids.tobytes()]
            return pa.record_batch([pa.array([v], t) for v, t in zip(row, types, strict=True)], schema=schema)

        for batch in batches:
            for r in batch.to_pylist():
                mine = np.flatnonzero(np.frombuffer(r["anchors"], np.bool_))
                if not len(mine):
                    continue
                ids, x = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["codes"], code).reshape(r["n"], -1)
                floors, floor_ids = np.full(len(mine), lowest), np.full(len(mine), lowest)
                scores = x[mine].astype(product) @ x.astype(product).T
                own = ids[mine][:, None] == ids[None, :]
                enough = (~own).sum(axis=1) >= k
                if enough.any():
                    scores[own] = _none(product)
                    high, kth = _best(scores[enough], k)
                    floors[enough] = high[:, -1].astype(np.int64)
                    floor_ids[enough] = ids[kth[:, -1]]
                have = held.setdefault(r["dim"], [])
                have.append((ids[mine], np.full(len(mine), r["label"]), x[mine], floors, floor_ids))
                if sum(len(h[0]) for h in have) >= size:
                    yield chunk(r["dim"])
        for dim in list(held):
            yield chunk(dim)

    return (stored.select("dim", "label", "n", "ids", "anchors", "codes").where(F.instr(F.hex("anchors"), "01") > 0)
            .mapInArrow(run, CHUNKS))


ZONE_CHUNKS = "part long, dim int, blocks binary, labels binary, firsts binary, lows binary, highs binary"


def zone_chunks(stored: DataFrame) -> DataFrame:
    """Zone maps of up to ``ZONES`` blocks in a row."""
    names = [f.split()[0] for f in ZONE_CHUNKS.split(", ")]
    types = [pa.int64(), pa.int32(), *[pa.binary()] * 5]
    schema = pa.schema(list(zip(names, types, strict=True)))
    size = ZONES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[dict]] = {}

        def chunk(dim: int) -> pa.RecordBatch:
            rows = held.pop(dim)
            row = [rows[0]["block"], dim, *(np.array([r[c] for r in rows], np.int64).tobytes() for c in ("block", "label", "first")),
                   b"".join(r["lows"] for r in rows), b"".join(r["highs"] for r in rows)]
            return pa.record_batch([pa.array([v], t) for v, t in zip(row, types, strict=True)], schema=schema)

        for batch in batches:
            for r in batch.to_pylist():
                held.setdefault(r["dim"], []).append(r)
                if len(held[r["dim"]]) == size:
                    yield chunk(r["dim"])
        for dim in list(held):
            yield chunk(dim)

    return stored.select("block", "dim", "label", "first", "lows", "highs").mapInArrow(run, ZONE_CHUNKS)


def bounds(anchors: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each anchor with any vector between
    ``lows`` and ``highs`` of each zone."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return up @ lows.T + down @ highs.T, up @ highs.T + down @ lows.T


class Chunk:
    """A chunk of anchors as arrays; ``positives`` once they are known."""

    def __init__(self, r: dict, code: np.dtype, product: np.dtype, low: int, high: int):
        self.chunk = r["chunk"]
        self.ids, self.labels = (np.frombuffer(r[c], np.int64) for c in ("ids", "labels"))
        self.x = np.frombuffer(r["codes"], code).reshape(len(self.ids), -1).astype(product)
        self.floors, self.floor_ids = (np.frombuffer(r[c], np.int64) for c in ("floors", "floor_ids"))
        self.owner = self.positive = self.score = np.empty(0, np.int64)
        if r.get("positives"):
            self.owner, self.positive, self.score = np.array(
                [(p["anchor"], p["vec_id"], p["score"]) for p in r["positives"]], np.int64).T.copy()
        self.low, self.high = -((-low * self.score) // 100), (high * self.score) // 100

    def wants(self, negatives: bool, labels: np.ndarray, firsts: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Which anchors (rows) need which zones (columns)."""
        same = self.labels[:, None] == labels[None, :]
        if not negatives:
            floor = self.floors[:, None]
            return same & ((most > floor) | ((most == floor) & (firsts[None, :] <= self.floor_ids[:, None])))
        window = (most[self.owner] >= self.low[:, None]) & (least[self.owner] <= self.high[:, None]) & (self.low <= self.high)[:, None]
        out = np.zeros(same.shape, bool)
        np.logical_or.at(out, self.owner, window)
        return out & ~same


def chosen(chunks: DataFrame, zones: DataFrame, code: np.dtype, product: np.dtype, negatives: bool, low: int, high: int) -> DataFrame:
    """(chunk, block, upper): the blocks that some anchor of the chunk needs,
    and the chunk's highest upper bound.  Chunks and zone maps meet in a grid
    of groups."""
    n_z = max(1, zones.count())
    left = chunks.select("dim", F.struct(*chunks.columns).alias("a"), F.explode(F.sequence(F.lit(0), F.lit(n_z - 1))).alias("g"))
    right = zones.select("dim", F.struct(*zones.columns).alias("z"), F.pmod(F.xxhash64("part"), F.lit(n_z)).cast("int").alias("g"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                c = Chunk(batch.column("a")[i].as_py(), code, product, low, high)
                z = batch.column("z")[i].as_py()
                ids, labels, firsts = (np.frombuffer(z[n], np.int64) for n in ("blocks", "labels", "firsts"))
                lows, highs = (np.frombuffer(z[n], code).reshape(len(ids), -1).astype(product) for n in ("lows", "highs"))
                least, most = bounds(c.x, lows, highs)
                need = c.wants(negatives, labels, firsts, least, most)
                at = np.flatnonzero(need.any(axis=0))
                upper = np.where(need, most, most.min())[:, at].max(axis=0).astype(np.int64) if len(at) else at
                yield pa.record_batch([pa.array(np.full(len(at), c.chunk)), pa.array(ids[at]), pa.array(upper)],
                                      names=["chunk", "block", "upper"])

    return left.join(right, ["dim", "g"]).select("a", "z").mapInArrow(run, "chunk long, block long, upper long")


# --- reading -----------------------------------------------------------------

def _merge(have: tuple[np.ndarray, np.ndarray], scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest of what a row has and of ``scores`` (columns in order of
    ``ids``; used up), equal ones by id."""
    high, top = _best(scores, k)
    score = np.concatenate([have[0], high], axis=1)
    vec = np.concatenate([have[1], ids[top]], axis=1)
    order = np.lexsort((vec, -score), axis=1)[:, :k]
    return np.take_along_axis(score, order, 1), np.take_along_axis(vec, order, 1)


def read(chunks: DataFrame, stored: DataFrame, picks: DataFrame, code: np.dtype, product: np.dtype, k: int,
         negatives: bool, low: int, high: int) -> DataFrame:
    """(chunk, anchor, positive, vec_id, score): the best ``k`` of each anchor
    (or of each of its positives' windows) in each cell.  A cell is a chunk
    of anchors with some of its blocks, best first, read one after another."""
    most = picks.groupBy("chunk").count().agg(F.max("count")).first()[0] or 0
    salt = F.pmod(F.xxhash64("block"), F.lit(max(1, -(-most // CELL)))).cast("int").alias("salt")
    cells = picks.select("chunk", salt).distinct()
    extra = [c for c in chunks.columns if c not in ("chunk", "dim", "ids", "codes")]
    nothing = [F.lit(None).cast(chunks.schema[c].dataType).alias(c) for c in extra]
    rows = picks.join(stored.select("block", "label", "ids", "codes"), "block").select(
        "chunk", salt, (-F.col("upper")).alias("place"), "label", "ids", "codes", *nothing)
    heads = chunks.join(cells, "chunk").select(
        "chunk", "salt", F.lit(None).cast("long").alias("place"), F.lit(None).cast("long").alias("label"), "ids", "codes", *extra)
    lined = rows.unionByName(heads).repartition("chunk", "salt").sortWithinPartitions("chunk", "salt", F.asc_nulls_first("place"))
    schema = pa.schema([("chunk", pa.int64()), ("anchor", pa.int64()), ("positive", pa.int64()), ("anchor_id", pa.int64()),
                        ("positive_id", pa.int64()), ("positive_score", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    none, at_once = _none(product), AT_ONCE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: Chunk | None = None
        best, held = None, []

        def multiply() -> None:
            nonlocal best
            ids = np.concatenate([i for i, _, _ in held])
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            labels = np.concatenate([np.full(len(i), x) for i, _, x in held])[order]
            x = np.concatenate([c for _, c, _ in held])[order].astype(product)
            held.clear()
            scores = head.x @ x.T
            free = (head.labels[:, None] == labels[None, :]) != negatives
            free &= head.ids[:, None] != ids[None, :]
            scores[~free] = none
            if negatives:
                scores = scores[head.owner]
                scores[(scores < head.low[:, None]) | (scores > head.high[:, None])] = none
            best = _merge(best, scores, ids, k)

        def hits() -> pa.RecordBatch:
            score, vec = best
            row, _ = np.nonzero(score != none)
            at = score != none
            owner = head.owner[row] if negatives else row
            blank = np.full(len(row), -1)
            cols = [np.full(len(row), head.chunk), owner, row if negatives else blank, head.ids[owner],
                    head.positive[row] if negatives else blank, head.score[row] if negatives else blank,
                    vec[at], score[at].astype(np.int64)]
            return pa.record_batch([pa.array(c, pa.int64()) for c in cols], schema=schema)

        for batch in batches:
            for r in batch.to_pylist():
                if r["place"] is None:
                    if head is not None:
                        if held:
                            multiply()
                        yield hits()
                    head = Chunk(r, code, product, low, high)
                    n = len(head.owner) if negatives else len(head.ids)
                    best = np.empty((n, 0), product), np.empty((n, 0), np.int64)
                else:
                    ids = np.frombuffer(r["ids"], np.int64)
                    held.append((ids, np.frombuffer(r["codes"], code).reshape(len(ids), -1), r["label"]))
                    if len(held) == at_once:
                        multiply()
        if head is not None:
            if held:
                multiply()
            yield hits()

    return lined.mapInArrow(run, ", ".join(f"{f.name} long" for f in schema))


def mine(vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, a whole-number label, embedding and anchor (a
    boolean; null: no).  Other columns are not read.  An anchor's positives
    are the ``positives`` other rows of its label with the highest inner
    products of codes; for each, the ``negatives`` highest rows of other
    labels within ``low`` to ``high`` percent of the positive's score are
    returned, equal scores by vec_id.

    Rows with a null vec_id, label or vector, an empty vector, or a null or
    non-finite component take no part; zero vectors do.  Vectors meet those of
    their length only.  Rows that repeat vec_id, label and codes are one row;
    other rows with the anchor's vec_id are not its positives or negatives.
    Fewer rows than asked for: all.  Empty tables: no rows.  Codes and inner
    products must fit 64-bit integers.
    """
    prepare(vectors.sparkSession)
    points = take_part(vectors)
    least, most, dim = points.agg(F.min(F.array_min("codes")), F.max(F.array_max("codes")), F.max(F.size("codes"))).first()
    least, most, dim = (least, most, dim) if dim else (0, 0, 1)
    code, product = _kind(least, most, dim)
    curve = cut_lineage(keyed(points, least, most, dim), "curve")
    stored = cut_lineage(blocks(curve, code), "blocks")
    chunks = cut_lineage(anchor_chunks(stored, code, product, positives), "anchors")
    zones = cut_lineage(zone_chunks(stored), "zones")

    def ranked(hits: DataFrame, by: list[str], k: int) -> DataFrame:
        order = W.partitionBy(*by).orderBy(F.desc("score"), "vec_id")  # at most k rows of a cell
        return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    picks = cut_lineage(chosen(chunks, zones, code, product, False, low, high), "picks")
    found = ranked(read(chunks, stored, picks, code, product, positives, False, low, high), ["chunk", "anchor"], positives)
    of = found.groupBy("chunk").agg(F.collect_list(F.struct("anchor", "vec_id", "score")).alias("positives"))  # bounded by the chunk
    chunks = cut_lineage(chunks.join(of, "chunk"), "anchors")
    picks = cut_lineage(chosen(chunks, zones, code, product, True, low, high), "picks")
    found = ranked(read(chunks, stored, picks, code, product, negatives, True, low, high), ["chunk", "positive"], negatives)
    return found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                        F.col("score").alias("negative_score"))


def with_noise(vectors: DataFrame, anchor: Column) -> DataFrame:
    """vec_id, label, embedding and anchor, where rows with vec_id divisible
    by 7 carry the next of ten labels."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.select("vec_id", label.alias("label"), "embedding", anchor.alias("anchor"))
