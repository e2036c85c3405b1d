"""Best-two-fit packing of tokenised documents into sequences.

Lengths are whole numbers up to the sequence length, so the packing is
planned on their histogram: a few thousand numbers on the driver, however
many documents there are.  Greedy best fit fills a bin; then the bin's
smallest document gives way to two unpacked ones that fit its expanded gap
more tightly.  A bin's pattern is repeated as often as the counts allow.
Spark numbers the pieces of each length, and a piece's number tells its bin.
"""

from __future__ import annotations

import base64
import functools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmart.llm.common import cut_lineage, prepare, rank_within

SEQUENCE = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k"
#: Fixed values of the vocabulary: its special string and that string's id.
SPECIAL = {"<|endoftext|>": 50256}

PIECES = "doc_id long, piece int, start long, length long, ids binary"


@functools.lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> tiktoken.Encoding:
    """The rank-file encoder."""
    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


@functools.lru_cache(maxsize=2)
def _library(vocabulary: str) -> tokenizers.Tokenizer:
    """The library's own encoder, loaded only for a text the other refuses."""
    return tokenizers.Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))


def token_ids(text: str, vocabulary: str = VOCABULARY) -> np.ndarray:
    """Ids of ``text`` as the tokenizer file gives them (tested to agree)."""
    try:
        return _encoder(vocabulary).encode_to_numpy(text, allowed_special="all")
    except Exception:  # its pattern engine gives up on very long runs of blanks
        return np.array(_library(vocabulary).encode(text, add_special_tokens=False).ids, np.uint32)


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: the first may be shorter."""
    if n <= size:
        return [(0, n)]
    first = n % size or size
    return [(0, first), *((s, size) for s in range(first, n, size))]


def tokenise(docs: DataFrame, size: int = SEQUENCE, vocabulary: str = VOCABULARY,
             end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``size`` ids: doc_id, piece, start, length, ids
    (little-endian unsigned 32-bit numbers).

    Reads doc_id and text only.  A null or empty text has just the end id;
    repeated rows each give their pieces; an empty table gives none.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                            ("length", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                raw = np.append(token_ids(text, vocabulary), end_id).astype("<u4").tobytes()
                rows.extend((doc_id, i, start, length, raw[4 * start:4 * (start + length)])
                            for i, (start, length) in enumerate(cut(len(raw) // 4, size)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)],
                                  schema=schema)

    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def plan_bins(counts: np.ndarray, size: int) -> list[tuple[int, dict[int, int]]]:
    """Patterns (times used, {length: how many}) that use up ``counts``
    (``counts[n]`` pieces of length n), each within ``size``."""
    left = np.asarray(counts, np.int64).copy()
    patterns = []
    while left.any():
        use: Counter[int] = Counter()
        gap = size

        def fitting(room: int) -> int:
            """Longest unpacked length within ``room``, 0 if none."""
            have = np.nonzero(left[1:room + 1])[0]
            return int(have[-1]) + 1 if len(have) else 0

        while n := fitting(gap):
            use[n] += 1
            left[n] -= 1
            gap -= n
        if gap and (small := min(use)) and use.total() > 1 and (pair := _two(left, small, gap + small)):
            use[small] -= 1
            left[small] += 1
            for n in pair:
                use[n] += 1
                left[n] -= 1
        use = +use
        times = 1 + min(int(left[n]) // k for n, k in use.items())
        for n, k in use.items():
            left[n] -= k * (times - 1)
        patterns.append((times, dict(use)))
    return patterns


def _two(left: np.ndarray, small: int, room: int) -> tuple[int, int] | None:
    """Two unpacked lengths with the largest sum in (small, room], the
    longer one as long as can be; None if there are none."""
    have = np.nonzero(left[1:room])[0] + 1
    if not len(have):
        return None
    at = np.searchsorted(have, room - have, side="right") - 1
    # the same length twice needs two pieces of it; else step down
    mate = np.where(at >= 0, have[np.maximum(at, 0)], 0)
    twice = (mate == have) & (left[have] < 2)
    mate = np.where(twice, np.where(at >= 1, have[np.maximum(at - 1, 0)], 0), mate)
    total = np.where(mate > 0, have + mate, 0)
    if total.max() <= small:
        return None
    best = np.nonzero(total == total.max())[0][-1]
    return int(have[best]), int(mate[best])


def place(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Append sequence_id and offset to a stored table of pieces.

    ``pieces`` has doc_id, piece and length, and carries any other columns.
    Every piece is placed once; offsets in a sequence are gapless from 0.
    """
    counts = np.zeros(size + 1, np.int64)
    for n, k in pieces.groupBy("length").count().collect():  # at most ``size`` rows
        counts[n] = k
    keys, base, per, at = [], [], [], []
    first, cursor = 0, np.zeros(size + 1, np.int64)
    for times, use in plan_bins(counts, size):
        offset = 0
        for n, k in sorted(use.items(), reverse=True):
            keys.append((n << 44) + int(cursor[n]))
            base.append(first)
            per.append(k)
            at.append(offset)
            cursor[n] += k * times
            offset += n * k
        first += times
    order = np.argsort(np.array(keys, np.int64))
    keys, base, per, at = (np.array(x, np.int64)[order] for x in (keys, base, per, at))

    def spot(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(np.int64), number.to_numpy(np.int64)
        i = np.searchsorted(keys, (n << 44) + r, side="right") - 1
        q, m = np.divmod(r - (keys[i] & ((1 << 44) - 1)), per[i])
        return pd.DataFrame({"sequence_id": base[i] + q, "offset": at[i] + m * n})

    spot.__annotations__ = {"length": pd.Series, "number": pd.Series, "return": pd.DataFrame}
    spot = F.pandas_udf(spot, "sequence_id long, offset long")
    rows = pieces.select(F.struct("*").alias("row"), "length", "doc_id", "piece")
    ranked = rank_within(rows, ["length"], ["doc_id", "piece"], "number")
    return ranked.withColumn("at", spot("length", "number")).select("row.*", "at.sequence_id", "at.offset")


def pack(docs: DataFrame, size: int = SEQUENCE, vocabulary: str = VOCABULARY,
         end_id: int = END_ID) -> DataFrame:
    """Pack all documents: the pieces of ``tokenise`` with sequence_id and
    offset.  Null and empty texts are packed as their end id."""
    return place(cut_lineage(tokenise(docs, size, vocabulary, end_id), "pieces"), size)
