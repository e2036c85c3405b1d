"""Quality classification by importance resampling.

Two generative models over hashed byte n-grams, one of target texts (labelled
good) and one of all raw texts, give each document the mean log ratio of its
n-grams.  The mean of a short text is noisy, so it is shrunk towards that of
the held-out good texts, by how much their means spread at its number of
n-grams.  The log importance weight is this ratio times a temper: a sum over
n-grams would make length decide, so weights are tempered until those of
held-out good texts spread by ``SPREAD``, of the order of the Gumbel noise.

Documents are sampled without replacement by these weights with the Gumbel
top-k trick: the k highest sums of log weight and noise are kept, so that a
likelier document is more likely to stay, not sure to.  k is the smallest
sample that holds all but ``LOSS`` of the held-out good texts, in all and in
each language (column lang, if there is one) and length class of at least
``CLASS`` of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelmart.llm.common import cut_lineage, prepare

GRAM = 4
BITS = 18
#: Standard deviation of long good texts' log weights (the noise's is 1.28).
SPREAD = 3.0
LOSS = 0.01
#: Held-out good texts of a language or length class that is calibrated by itself.
CLASS = 100
SEED = 11
#: Labelled rows that are used at most, half to fit, half to calibrate: the
#: bounded sample of the fit.  The raw model counts all documents.
LABELLED = 20_000
SMOOTHING = 0.5
#: Bytes of text whose n-grams are worked on at a time (about 30 times as much).
SLICE = 1_000_000
#: Keys that the driver sorts to find the k-th highest.
SORTED = 5_000


def good_labels(labels: DataFrame) -> DataFrame:
    """doc_id of the texts labelled good and not toxic."""
    return labels.where("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id")


def slices(texts: pa.Array, n: int = GRAM) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """The texts of a batch as UTF-8 in runs of about ``SLICE`` bytes, with
    their places in the batch.  A longer text is cut, whatever its batch, into
    slices that overlap by n - 1 bytes, so that no n-gram is lost or counted
    twice.  Null and empty texts are left out; a text shorter than n is padded."""
    at, run, size = [], [], 0
    for i, t in enumerate(texts):
        raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
        if not raw:
            continue
        if len(raw) > SLICE:
            for start in range(0, len(raw) - n + 1, SLICE):
                yield np.array([i]), [raw[start:start + SLICE + n - 1]]
            continue
        if size + len(raw) > SLICE:
            yield np.array(at), run
            at, run, size = [], [], 0
        at.append(i)
        run.append(raw.ljust(n, b"\0"))
        size += len(raw)
    if run:
        yield np.array(at), run


def grams(texts: pa.Array, n: int = GRAM, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte n-grams of a batch of texts, and how many each
    text has.  A shorter text, if not empty, has one: all of it."""
    found, sizes = [np.empty(0, np.int32)], np.zeros(len(texts), np.int64)
    for at, raw in slices(texts, n):
        bucket, many = run_grams(raw, n, bits)
        found.append(bucket)
        sizes[at] += many
    return np.concatenate(found), sizes


def run_grams(raw: list[bytes], n: int = GRAM, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """The same for one run of texts of n bytes or more."""
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"".join(raw), np.uint8)
    key = np.zeros(len(data) - n + 1, np.uint64)
    for i in range(n):
        key *= np.uint64(257)
        key += data[i:len(data) - n + 1 + i]
    key *= np.uint64(0x9E3779B97F4A7C15)
    bucket = (key >> np.uint64(64 - bits)).astype(np.int32)
    whole = np.ones(len(bucket), bool)  # n-grams that run over a text's end don't count
    ends = np.cumsum(sizes)
    for i in range(1, n):
        at = ends - i
        whole[at[(at >= 0) & (at < len(whole))]] = False
    return bucket[whole], sizes - n + 1


def gram_counts(docs: DataFrame, n: int = GRAM, bits: int = BITS) -> np.ndarray:
    """How often each bucket comes in all the texts; each task sends its own
    sums, the driver gets one number a bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for _, raw in slices(batch.column(0), n):
                total += np.bincount(run_grams(raw, n, bits)[0], minlength=1 << bits)
        found = np.nonzero(total)[0]
        yield pa.record_batch([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["bucket", "n"])

    counted = docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    got = counted.toArrow()
    out = np.zeros(1 << bits, np.int64)
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log of the target's over the raw text's probability of each bucket."""
    p, q = target + SMOOTHING, raw + SMOOTHING
    return (np.log(p / p.sum()) - np.log(q / q.sum())).astype(np.float32)


def score(docs: DataFrame, ratios: np.ndarray, name: str, n: int = GRAM, bits: int = BITS,
          number: str | None = None) -> DataFrame:
    """``docs`` with the mean log ratio of each text's n-grams as ``name``
    (null for a null or empty text), and how many they are as ``number``."""
    added = [T.StructField(name, T.DoubleType())]
    if number is not None:
        added.append(T.StructField(number, T.LongType()))
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            sums, sizes = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for at, raw in slices(batch.column("text"), n):
                bucket, many = run_grams(raw, n, bits)
                sums[at] += np.add.reduceat(table[bucket], np.cumsum(many) - many, dtype=np.float64)
                sizes[at] += many
            mean = sums / np.maximum(sizes, 1)
            # rounded, so that a text scores alike wherever in a batch it is
            col = pa.array(np.round(mean, 9), pa.float64(), mask=sizes == 0)
            cols = [col, pa.array(sizes, pa.int64())][:len(names)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=[*batch.schema.names, *names])

    names = [f.name for f in added]
    for x in names:
        if x in docs.columns:
            raise ValueError(f"the table already has a column {x}")
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def spread(mean: np.ndarray, n: np.ndarray) -> tuple[float, float, float]:
    """(centre, a, b): means of good texts with n n-grams vary about the centre
    by a + b / n, fitted as the variances of a normal law."""
    centre = float(np.median(mean))
    square, x = (mean - centre) ** 2, 1.0 / np.maximum(n, 1)
    a, b = max(float(np.median(square[n >= np.median(n)])) * 2.2, 1e-12), 0.0
    for _ in range(50):
        w = 1.0 / (a + b * x) ** 2
        sw, sx, sxx, sy, sxy = w.sum(), (w * x).sum(), (w * x * x).sum(), (w * square).sum(), (w * x * square).sum()
        det = sw * sxx - sx * sx
        if det <= 1e-12 * sw * sxx:  # all texts have one length
            return centre, a, 0.0
        b = max((sw * sxy - sx * sy) / det, 0.0)
        a = max((sy - b * sx) / sw, 1e-12)
    return centre, a, b


def shrunk(mean: Column, n: Column, centre: float, a: float, b: float) -> Column:
    """The mean of n n-grams, shrunk to the spread of a long text's."""
    return F.lit(centre) + (mean - F.lit(centre)) * F.sqrt(F.lit(a) / (F.lit(a) + F.lit(b) / n))


def gumbel(seed: int = SEED):
    """Standard Gumbel noise of a row, fixed by its doc_id."""
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def kth_highest(keys: DataFrame, column: str, k: int) -> float:
    """The k-th highest value of a stored column without nulls: the driver
    narrows down by counts and sorts a bounded rest."""
    lo, hi = keys.agg(F.min(column), F.max(column)).first()
    while True:
        inside = keys.where(F.col(column).between(lo, hi))
        n = inside.count()
        if n <= SORTED or lo == hi:
            break
        width = (hi - lo) / 1024
        bucket = F.least(F.floor((F.col(column) - lo) / width), F.lit(1023))
        counts = inside.groupBy(bucket.alias("b")).agg(
            F.count(F.lit(1)), F.min(column), F.max(column)).orderBy(F.desc("b")).collect()
        for _, m, low, high in counts:
            if k <= m:
                lo, hi = low, high
                break
            k -= m
    if lo == hi:
        return lo
    return sorted((r[0] for r in inside.select(column).collect()), reverse=True)[k - 1]


class Model:
    """Fitted models: ``ratios``, ``cut``, the key of the k-th document,
    ``law``, the spread of good texts' means, and the weights' ``temper``."""

    def __init__(self, ratios: np.ndarray, cut: float, law: tuple[float, float, float] = (0.0, 1.0, 0.0), temper: float = 1.0):
        self.ratios, self.cut, self.law, self.temper = ratios, cut, law, temper


def fit(docs: DataFrame, good: DataFrame, loss: float = LOSS, spread_to: float = SPREAD,
        labelled: int = LABELLED, seed: int = SEED) -> Model:
    """Fit both models, calibrate, and find the cut over all of ``docs``.

    ``good`` has the doc_id of labelled good texts; ``labelled`` of them at
    most are used.  Without any, nothing is rejected but texts without text.
    """
    prepare(docs.sparkSession)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    docs = docs.select("doc_id", "text", lang.alias("lang"))
    sample = (good.select("doc_id").where("doc_id is not null").distinct()
              .withColumn("h", F.xxhash64("doc_id", F.lit(seed + 1))).orderBy("h", "doc_id").limit(labelled))
    sample = cut_lineage(sample, "labelled")  # at most ``labelled`` rows
    to_fit = sample.where(F.pmod("h", F.lit(2)) == 0).select("doc_id")
    raw = gram_counts(docs)
    target = gram_counts(docs.join(F.broadcast(to_fit), "doc_id", "left_semi"))
    if not target.any():
        return Model(np.zeros(len(raw), np.float32), -np.inf)
    ratios = log_ratios(target, raw)
    scored = cut_lineage(score(docs, ratios, "log_ratio", number="n").select(
        "doc_id", "log_ratio", "n", "lang").where("log_ratio is not null"), "scores")
    held = scored.join(F.broadcast(sample.where(F.pmod("h", F.lit(2)) == 1).select("doc_id")), "doc_id", "left_semi")
    # at most ``labelled`` rows, one a document
    held = held.withColumn("noise", gumbel(seed)).groupBy("doc_id").agg(
        F.max(F.struct("log_ratio", "n", "lang", "noise")).alias("x")).select("x.*").collect()
    if not held:
        return Model(ratios, -np.inf)
    mean, n, noise = (np.array([r[c] for r in held], np.float64) for c in ("log_ratio", "n", "noise"))
    law = spread(mean, n)
    centre, a, b = law
    temper = spread_to / float(np.sqrt(a))
    keys = temper * (centre + (mean - centre) * np.sqrt(a / (a + b / n))) + noise
    classes: dict = {None: range(len(held))}
    for i, row in enumerate(held):
        for x in (("lang", row["lang"]), ("length", int(np.log2(row["n"])) // 2)):
            classes.setdefault(x, []).append(i)
    least = min(float(np.quantile(keys[list(x)], loss)) for name, x in classes.items()
                if name is None or len(x) >= CLASS)
    scored = cut_lineage(scored.select((shrunk(F.col("log_ratio"), F.col("n"), *law) * temper + gumbel(seed)).alias("key")), "keys")
    k = scored.where(F.col("key") >= least).count()
    return Model(ratios, kth_highest(scored, "key", max(k, 1)), law, temper)


def keyed(docs: DataFrame, model: Model, seed: int = SEED) -> DataFrame:
    """``docs`` with quality_log_ratio and quality_key (log weight plus noise)."""
    out = score(docs, model.ratios, "quality_log_ratio", number="quality_n")
    weight = shrunk(F.col("quality_log_ratio"), F.greatest("quality_n", F.lit(1)), *model.law) * model.temper
    return out.withColumn("quality_key", weight + gumbel(seed)).drop("quality_n")


def resample(docs: DataFrame, good: DataFrame, **options) -> DataFrame:
    """doc_id, log_ratio, key and kept of every row.

    Null and empty texts have a null log_ratio and key and are not kept.  Rows
    with the same doc_id and text, and ties at the cut, are kept alike; an
    empty table gives no rows.
    """
    model = fit(docs, good, **options)
    out = keyed(docs.select(F.col("doc_id").cast("long"), "text"), model)
    return out.select("doc_id", F.col("quality_log_ratio").alias("log_ratio"), F.col("quality_key").alias("key"),
                      F.coalesce(F.col("quality_key") >= model.cut, F.lit(False)).alias("kept"))


def keep_good(docs: DataFrame, good: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``resample`` keeps, with their columns,
    whatever these are named."""
    model = fit(docs, good, **options)
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    return keyed(rows, model).where(F.col("quality_key") >= model.cut).select("row.*")
