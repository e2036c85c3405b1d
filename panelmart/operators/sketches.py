"""Approximate quantile edges from mergeable sketches (A11, ``approx``).

A KLL sketch of each (column, group) is the state of one aggregate: no sort,
no write, one row of about ``size`` values a group and task in the shuffle.
Sketches are values: they can be stored, merged with those of new data or of
other groups, and asked again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmart.operators.quantiles import long_values

#: Values a sketch keeps (up to 65,535).  While a group has no more than this,
#: the sketch is exact.
SIZE = 4096


def rank_error(size: int = SIZE) -> float:
    """Rank error of a sketch as a share of the values, kept with 99 %
    confidence (the sketch's published fit)."""
    return 2.296 / size ** 0.9021


def sketch(df: DataFrame, specs, size: int = SIZE) -> DataFrame:
    """(_s, _k, _sketch): one sketch per spec and group."""
    return (long_values(df, list(specs)).groupBy("_s", "_k")
            .agg(F.kll_sketch_agg_double("_v", F.lit(size)).alias("_sketch")))


def merge(*sketches: DataFrame, size: int = SIZE) -> DataFrame:
    """One sketch per spec and group from tables of sketches."""
    rows = sketches[0]
    for s in sketches[1:]:
        rows = rows.unionByName(s)
    return rows.groupBy("_s", "_k").agg(F.kll_merge_agg_double("_sketch", F.lit(size)).alias("_sketch"))


def edges_of(sketches: DataFrame, specs) -> DataFrame:
    """(_s, _k, _n, _es): the value at each probability, lowest and highest
    exact.  Edges are values that occur (no interpolation)."""
    edges = None
    for i, s in enumerate(specs):
        at = F.array(*[F.kll_sketch_get_quantile_double("_sketch", F.lit(float(p))) for p in s.probs])
        edges = F.when(F.col("_s") == i, at) if edges is None else edges.when(F.col("_s") == i, at)
    return sketches.select("_s", "_k", F.kll_sketch_get_n_double("_sketch").cast("long").alias("_n"), edges.alias("_es"))


def edge_arrays_by_sketch(df: DataFrame, specs, size: int = SIZE) -> DataFrame:
    """Approximate edges in the form of :func:`quantiles.edge_arrays`.
    Null and NaN values are left out."""
    specs = list(specs)
    return edges_of(sketch(df, specs, size), specs)


def rank_errors(df: DataFrame, specs, edges: DataFrame) -> DataFrame:
    """(_s, _k, _i, _error): how far each edge's rank is from its probability,
    as a share of the group's values: 0 where the probability lies between
    the shares of values below the edge and up to it.  ``edges`` are broadcast
    (a row per spec and group)."""
    specs = list(specs)
    flat = edges.select("_s", "_k", F.posexplode("_es").alias("_i", "_e"))
    probs = None
    for i, s in enumerate(specs):
        at = F.array(*[F.lit(float(p)) for p in s.probs])
        probs = F.when(F.col("_s") == i, at) if probs is None else probs.when(F.col("_s") == i, at)
    v, e = F.col("_v"), F.col("_e")
    shares = (long_values(df, specs).where(~F.isnan("_v")).join(F.broadcast(flat), ["_s", "_k"])
              .groupBy("_s", "_k", "_i").agg(F.avg((v < e).cast("double")).alias("_below"),
                                             F.avg((v <= e).cast("double")).alias("_upto")))
    p = probs[F.col("_i")]
    return shares.select("_s", "_k", "_i", F.greatest(F.lit(0.0), p - F.col("_upto"), F.col("_below") - p).alias("_error"))
