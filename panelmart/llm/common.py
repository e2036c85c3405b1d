"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from panelmart.session import cut_lineage, shared_dir

__all__ = ["cut_lineage", "shared_dir", "prepare", "rank_within", "words", "word_hashes",
           "shingle_hashes", "table"]

#: Rows and bytes of an Arrow batch: bound what a Python worker holds of the
#: input.  A single longer row is a batch of its own.
ARROW_ROWS, ARROW_BYTES = 1000, 4_000_000

_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Give the executors this package and bound the Arrow batches.

    The package goes out as a zip file with ``addPyFile`` once per
    application, so that tasks can import it wherever the driver started.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "panelmart.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rank_within(df: DataFrame, keys: list[str], order: list[str], name: str,
                buckets: int = 256) -> DataFrame:
    """Append ``name``: gapless numbers from 0 among the rows of equal ``keys``.

    A key's rows are dealt to ``buckets`` by a hash of ``order`` and numbered
    inside each bucket; the buckets' counts give the offsets.  So a key with
    a third of all rows is spread over ``buckets`` window groups.  ``df`` is
    read twice (numbers and counts): pass a stored or a cheap table.  Rows
    that agree in all of ``order`` get distinct numbers in either order.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    by = [*keys, "_salt"]
    counts = salted.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*keys).orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*by, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    numbered = salted.withColumn("_r", F.row_number().over(W.partitionBy(*by).orderBy(*order)))
    return (numbered.join(offsets, by)
            .select(*[F.col(c) for c in df.columns],
                    (F.col("_r") - 1 + F.col("_off")).cast("long").alias(name)))


# --- words and shingles (inside tasks) -------------------------------------

_MIX = tuple(np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def words(text: str | None) -> list[bytes]:
    """Words of ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    """64-bit hashes of the words, in order."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, tokens), np.uint64, len(tokens))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingle_hashes(tokens: list[bytes], n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; fewer words: the
    whole sequence as one; no words: empty."""
    if not tokens:
        return np.empty(0, np.uint64)
    h = word_hashes(tokens)
    n = min(n, len(h))
    acc = np.full(len(h) - n + 1, np.uint64(n), np.uint64)
    for i in range(n):  # a polynomial over the words' hashes
        acc *= _MIX[0]
        acc += h[i:len(h) - n + 1 + i]
    return np.unique(mix64(acc))


def bit_distance(a: Column, b: Column, words64: int) -> Column:
    """Population count of the XOR of two arrays of 64-bit words."""
    total = F.bit_count(a[0].bitwiseXOR(b[0]))
    for i in range(1, words64):
        total = total + F.bit_count(a[i].bitwiseXOR(b[i]))
    return total
