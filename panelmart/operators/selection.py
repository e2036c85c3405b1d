"""Exact quantile edges by counting (A11): no value is sorted or shuffled.

The needed ranks of each (column, group) are pinned by narrowing ranges of
values.  A pass over the rows counts, within each range that holds a needed
rank, the values of 256 buckets, with each bucket's lowest and highest value;
the buckets that hold needed ranks are the next ranges.  A range whose lowest
and highest value agree is pinned.  Counts are combined before the shuffle, so
that at most 256 rows a range leave a task, however many rows there are and
however many of them share one value.

Buckets are equal parts of the range in one pass and equal parts of its
logarithm in the next, so that neither clusters nor orders of magnitude take
many passes: a column of 64-bit floats needs about 20 at the very worst, and
three or four as a rule.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from panelmart.operators.quantiles import long_values

BUCKETS = 256
#: Groups (over all columns) up to which the ranges are kept on the driver.
MAX_GROUPS = 50_000

_RANGES = ("_s int, _k long, _lo double, _hi double, _below long, _mode int, _scale double, _glo double, "
           "_width double, _need array<long>")
#: How a pass splits a range: equal parts, equal parts of the logarithm of
#: positive or of negative values, or by sign.
LINEAR, POSITIVE, NEGATIVE, SIGN = range(4)


def _curve(mode: int, v: float, scale: float) -> float:
    """Where ``v`` lies on the scale of a mode (computed as Spark does)."""
    if mode == POSITIVE:
        return math.log(v)
    if mode == NEGATIVE:
        return -math.log(-v)
    return v * scale


def _split(lo: float, hi: float, logarithm: bool) -> tuple[int, float, float, float]:
    """(mode, scale, start, width) of a pass over the range lo < hi."""
    if logarithm and lo < 0 < hi:
        return SIGN, 1.0, 0.0, 1.0
    scale = 0.5 if max(abs(lo), abs(hi)) > 1e300 else 1.0  # hi - lo stays finite
    mode = (POSITIVE if lo > 0 else NEGATIVE if hi < 0 else LINEAR) if logarithm else LINEAR
    start, end = _curve(mode, lo, scale), _curve(mode, hi, scale)
    if end <= start:  # neighbours that a logarithm can't tell apart
        mode, start, end = LINEAR, lo * scale, hi * scale
    return mode, scale, start, end - start


def _bucket() -> F.Column:
    """Bucket of ``_v`` in its range; never falls as ``_v`` rises."""
    v = F.col("_v")
    at = (F.when(F.col("_mode") == POSITIVE, F.log(v)).when(F.col("_mode") == NEGATIVE, -F.log(-v))
          .otherwise(v * F.col("_scale")))
    part = F.floor((at - F.col("_glo")) / F.col("_width") * BUCKETS)
    part = F.greatest(F.lit(0), F.least(F.lit(BUCKETS - 1), part))
    return F.when(F.col("_mode") == SIGN, F.signum(v) + 1).otherwise(part).cast("int")


def _pass(spark: SparkSession, values: DataFrame, ranges: list[dict], logarithm: bool) -> list[dict]:
    """The buckets of the ranges that hold needed ranks, as ranges."""
    rows = [(r["s"], r["k"], r["lo"], r["hi"], r["below"], *_split(r["lo"], r["hi"], logarithm), r["need"])
            for r in ranges]
    small = F.broadcast(spark.createDataFrame(rows, _RANGES))  # at most 2 x (bins + 1) ranges a group
    inside = values.join(small, ["_s", "_k"]).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
    counts = inside.groupBy("_s", "_k", "_lo", "_below", "_need", _bucket().alias("_b")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    before = W.partitionBy("_s", "_k", "_lo").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    found = counts.withColumn("_first", F.col("_below") + F.coalesce(F.sum("_c").over(before), F.lit(0)))
    mine = F.filter("_need", lambda r: (r >= F.col("_first")) & (r < F.col("_first") + F.col("_c")))
    return [{"s": r["_s"], "k": r["_k"], "lo": r["_least"], "hi": r["_most"], "below": r["_first"], "need": r["_mine"]}
            for r in found.withColumn("_mine", mine).where(F.size("_mine") > 0).collect()]


def needed(n: int, probs) -> list[tuple[float, int, int]]:
    """(position, rank below, rank above) of each probability among n values."""
    at = [(n - 1) * float(p) for p in probs]
    return [(h, math.floor(h), math.ceil(h)) for h in at]


def count_groups(values: DataFrame) -> DataFrame:
    """Per (_s, _k): values, infinities and NaNs, and the finite range."""
    v = F.col("_v")
    finite = ~F.isnan(v) & (F.abs(v) < float("inf"))
    return values.groupBy("_s", "_k").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(v == float("-inf")).alias("low"),
        F.count_if(v == float("inf")).alias("high"), F.count_if(F.isnan(v)).alias("nan"),
        F.min(F.when(finite, v)).alias("lo"), F.max(F.when(finite, v)).alias("hi"))


def edge_arrays_by_counting(df: DataFrame, specs) -> DataFrame:
    """The edges of :func:`quantiles.edge_arrays`: (_s, _k, _n, _es).

    ``df`` is read once a pass: pass a stored table.  Infinite values are
    values; NaN counts as larger than all, as in Spark's order.  The driver
    keeps the ranges, at most 2 x (bins + 1) of a group; more than
    ``MAX_GROUPS`` groups are an error (the sorting method has no such bound).
    """
    specs = list(specs)
    spark = df.sparkSession
    values = long_values(df, specs)
    groups = count_groups(values).limit(MAX_GROUPS + 1).collect()
    if len(groups) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups: use the sorting method")
    found: dict[tuple[int, int], dict[int, float]] = {}
    sizes: dict[tuple[int, int], int] = {}
    ranges = []
    for g in groups:
        key, probs = (g["_s"], g["_k"]), specs[g["_s"]].probs
        sizes[key] = g["n"]
        ranks = sorted({r for _, a, b in needed(g["n"], probs) for r in (a, b)})
        finite = g["n"] - g["high"] - g["nan"]
        got = found[key] = {}
        for r in ranks:  # the infinities' ranks are known
            if r < g["low"]:
                got[r] = -math.inf
            elif r >= g["n"] - g["nan"]:
                got[r] = math.nan
            elif r >= finite:
                got[r] = math.inf
        rest = [r for r in ranks if r not in got]
        if rest:
            ranges.append({"s": key[0], "k": key[1], "lo": g["lo"], "hi": g["hi"], "below": g["low"], "need": rest})
    logarithm = False
    while True:
        for r in ranges:
            if r["lo"] == r["hi"]:
                found[r["s"], r["k"]].update(dict.fromkeys(r["need"], r["lo"]))
        ranges = [r for r in ranges if r["lo"] < r["hi"]]
        if not ranges:
            break
        ranges = _pass(spark, values, ranges, logarithm)
        logarithm = not logarithm
    out = []
    for key, n in sizes.items():
        edges = []
        for h, a, b in needed(n, specs[key[0]].probs):
            lo, hi = found[key][a], found[key][b]
            edges.append(lo if lo == hi else lo + (hi - lo) * (h - a))
        out.append((*key, n, edges))
    return spark.createDataFrame(out, "_s int, _k long, _n long, _es array<double>")
