"""Splittable scan of GeoJSON feature collections.

A feature collection is one JSON value, often on one line, so a JSON reader
must give it to one task.  Here the text reader splits the file at a closing
bracket, wherever a byte range begins, and the pieces are put together to
chunks of bounded size.  Each chunk is summed up by what it does to the
nesting of brackets, for a chunk that begins inside or outside a string.
Running sums over a file's chunks tell the state in which each one begins;
then every chunk can be cut into features by itself.  A feature that crosses
chunks is joined from its pieces.
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

from panelmart.session import cut_lineage, ship_package

#: Bytes of a chunk (a single piece between two brackets may be longer).
CHUNK = 1 << 20
#: Bracket at which the text is split: one piece holds a feature's geometry.
#: With "]" a piece holds one vertex, for files with very large geometries.
CUT = "}"

_KEY = re.compile(rb'"features"\s*:\s*\Z')


def structure(data: np.ndarray, in_string: int) -> tuple[np.ndarray, np.ndarray]:
    """(change of nesting at each byte, real quotes) of JSON text that begins
    inside (1) or outside (0) a string; brackets in strings change nothing."""
    quote = data == ord('"')
    slash = data == ord("\\")
    if slash.any():  # a quote after an odd number of backslashes is escaped
        at = np.arange(len(data))
        plain = np.maximum.accumulate(np.where(slash, -1, at))
        run = np.append(0, (at - plain)[:-1])
        quote &= run % 2 == 0
    outside = (np.cumsum(quote) - quote + in_string) % 2 == 0
    change = np.zeros(len(data), np.int8)
    change[outside & ((data == ord("{")) | (data == ord("[")))] = 1
    change[outside & ((data == ord("}")) | (data == ord("]")))] = -1
    return change, quote


def chunks(spark: SparkSession, path, cut: str = CUT, most: int = CHUNK) -> DataFrame:
    """file, block, seq, text and its summary: whether it ends in the other
    string state (``flips``), and the change of nesting if it begins outside
    or inside a string (``d0``, ``d1``)."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("seq", pa.int64()), ("text", pa.binary()),
                        ("flips", pa.int64()), ("d0", pa.int64()), ("d1", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, held, size, place, seq = cut.encode(), [], 0, None, 0

        def chunk() -> pa.RecordBatch:
            nonlocal held, size, seq
            text = end.join([*held, b""])
            data = np.frombuffer(text, np.uint8)
            out, quote = structure(data, 0)
            into, _ = structure(data, 1)
            row = [*place, seq, text, int(quote.sum()) % 2, int(out.sum(dtype=np.int64)), int(into.sum(dtype=np.int64))]
            held, size, seq = [], 0, seq + 1
            return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            for file, block, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place != (file, block):
                    if held:
                        yield chunk()
                    place, seq = (file, block), 0
                raw = value.encode()
                held.append(raw)
                size += len(raw) + 1
                if size >= most:
                    yield chunk()
        if held:
            yield chunk()

    ship_package(spark)
    raw = spark.read.option("lineSep", cut).text(path)
    return raw.select("_metadata.file_path", "_metadata.file_block_start", "value").mapInArrow(
        run, "file string, block long, seq long, text binary, flips long, d0 long, d1 long")


def states(stored: DataFrame) -> DataFrame:
    """Chunks with the state in which they begin: ``in_string`` and ``depth``.
    The running sums read the narrow summaries only."""
    order = W.partitionBy("file").orderBy("block", "seq").rowsBetween(W.unboundedPreceding, -1)
    total = lambda c: F.coalesce(F.sum(c).over(order), F.lit(0))
    narrow = stored.select("file", "block", "seq", "flips", "d0", "d1").withColumn("in_string", total("flips") % 2)
    moved = F.when(F.col("in_string") == 0, F.col("d0")).otherwise(F.col("d1"))
    narrow = narrow.withColumn("_d", moved).withColumn("depth", total("_d"))
    return stored.select("file", "block", "seq", "text").join(
        narrow.select("file", "block", "seq", "in_string", "depth"), ["file", "block", "seq"])


def pieces(chunk: DataFrame) -> DataFrame:
    """Objects in arrays of the document's root, and parts of those that cross
    chunks: file, block, seq, nth (object begun in the chunk; -1: begun before),
    whole, listed (1: in ``features``, 0: in another array, null: as the chunk
    before), text.  A last row (nth null) tells what the next chunk inherits:
    begun (objects begun here) and listed at the end (null: unchanged)."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("seq", pa.int64()), ("nth", pa.int64()),
                        ("whole", pa.bool_()), ("listed", pa.int64()), ("text", pa.string()), ("begun", pa.int64())])

    def cut_up(text: bytes, in_string: int, depth: int) -> tuple[list[tuple], tuple]:
        data = np.frombuffer(text, np.uint8)
        change, _ = structure(data, in_string)
        level = np.cumsum(change, dtype=np.int64) + depth
        events = np.flatnonzero((change != 0) & (((change == 1) & (level <= 3)) | ((change == -1) & (level <= 2))))
        listed, ended, begun, rows = None, None, 0, []
        start, nth = (0, -1) if depth >= 3 else (None, None)
        for at in events.tolist():
            if change[at] == 1 and level[at] == 2 and data[at] == ord("["):
                listed = ended = int(bool(_KEY.search(text[max(0, at - 4096):at])))
            elif change[at] == 1 and level[at] == 3:
                start, nth = at, begun
                begun += 1
            elif change[at] == -1 and level[at] == 2 and start is not None:
                rows.append((nth, nth >= 0, listed, text[start:at + 1]))
                start = None
            elif change[at] == -1 and level[at] <= 1:
                listed = ended = 0
        if start is not None:
            rows.append((nth, False, listed, text[start:]))
        return rows, (None, None, ended, None, begun)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows, last = cut_up(r["text"], r["in_string"], r["depth"])
                place = (r["file"], r["block"], r["seq"])
                cols = list(zip(*[(*place, *x[:3], x[3].decode(), None) for x in rows], (*place, *last), strict=True))
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return chunk.select("file", "block", "seq", "text", "in_string", "depth").mapInArrow(
        run, "file string, block long, seq long, nth long, whole boolean, listed long, text string, begun long")


def feature_texts(spark: SparkSession, path, cut: str = CUT, most: int = CHUNK) -> DataFrame:
    """file, block, row and JSON text of each object in the root's
    ``features`` arrays; (file, block, row) is the files' own order."""
    stored = cut_lineage(chunks(spark, path, cut, most), "geojson-chunks")
    found = cut_lineage(pieces(states(stored)), "geojson-pieces")
    order = W.partitionBy("file").orderBy("block", "seq").rowsBetween(W.unboundedPreceding, -1)
    owner = F.when(F.col("begun") > 0, F.struct(F.col("block").alias("block"), F.col("seq").alias("seq"), (F.col("begun") - 1).alias("nth")))
    before = found.where("nth is null").select(
        "file", "block", "seq", F.coalesce(F.last("listed", ignorenulls=True).over(order), F.lit(0)).alias("was"),
        F.last(owner, ignorenulls=True).over(order).alias("owner"))
    objects = found.where("nth is not null").join(before, ["file", "block", "seq"])
    objects = objects.where(F.coalesce("listed", "was") == 1)
    row = lambda seq, nth: F.shiftleft(seq, 32) + nth
    whole = objects.where("whole").select("file", "block", row(F.col("seq"), F.col("nth")).alias("row"), "text")
    mine = F.when(F.col("nth") >= 0, F.struct("block", "seq", "nth")).otherwise(F.col("owner"))
    parts = (objects.where("not whole").withColumn("_o", mine)
             .groupBy("file", "_o").agg(F.sort_array(F.collect_list(F.struct("block", "seq", "text"))).alias("_p")))
    joined = parts.select("file", "_o.block", row(F.col("_o.seq"), F.col("_o.nth")).alias("row"),
                          F.array_join(F.transform("_p", lambda p: p["text"]), "").alias("text"))
    return whole.unionByName(joined)


def read_feature_collection(spark: SparkSession, path, feature: StructType, cut: str = CUT) -> DataFrame:
    """properties, geometry and ``_input_order`` of the features of one or
    many collections, however they are laid out in lines.

    Objects in arrays named ``features`` of a document's root are features;
    entries that aren't objects are none.  The files' own order is kept.
    """
    rows = feature_texts(spark, path, cut).select(F.from_json("text", feature).alias("f"), F.struct("file", "block", "row").alias("_input_order"))
    return rows.select("f.properties", "f.geometry", "_input_order")
