"""Exact quantile edges and equal-frequency bins.

Edges are linear-interpolation quantiles: for ``n`` non-null values in a
group and probability ``p`` the position is ``h = (n - 1) * p`` and the edge
is ``v[floor(h)] + (v[ceil(h)] - v[floor(h)]) * (h - floor(h))`` over the
sorted values.  Bins are right-closed with the lowest edge included, which
is ``pd.qcut`` / ``pd.cut(include_lowest=True)``; this is *not* ``ntile``.

Method: one range-partitioned sort of all binned columns together,
per-partition counts turned into global ranks, then only the rows at the
needed ranks are picked.  Exact, and no group - however large or skewed - is
ever gathered into one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelmart.session import cut_lineage


@dataclass(frozen=True)
class BinSpec:
    """One binned column: ``value`` split into ``len(labels)`` equal-frequency
    bins per ``by`` group (``by=None``: one global group)."""

    name: str
    value: str
    by: str | None
    labels: tuple

    @property
    def probs(self) -> tuple[float, ...]:
        k = len(self.labels)
        return tuple(i / k for i in range(k + 1))


def _edge_col(spec: BinSpec, i: int) -> str:
    return f"_{spec.name}_e{i}"


def long_values(df: DataFrame, specs) -> DataFrame:
    """All binned values stacked into (_s, _k, _v); one row per value."""
    return _long_values(df, specs, [specs[0].value]).drop("_t")


def _long_values(df: DataFrame, specs, tiebreak=None) -> DataFrame:
    """All binned values stacked into (_s, _k, _v, _t); one row per value.

    ``_t`` is a deterministic per-row hash (of the ``tiebreak`` columns, by
    default all columns) used only to order equal values, so that a value
    shared by a large share of the rows still spreads over many range
    partitions instead of landing in one task."""
    t = F.xxhash64(*[F.col(c) for c in (tiebreak or df.columns)])
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("_s"),
            (F.col(s.by).cast("long") if s.by else F.lit(0).cast("long")).alias("_k"),
            F.col(s.value).cast("double").alias("_v"),
        )
        for i, s in enumerate(specs)
    ])
    return (df.select(F.explode(rows).alias("r"), t.alias("_t")).select("r.*", "_t")
            .where(F.col("_v").isNotNull() & F.col("_k").isNotNull()))


def _probs_col(specs) -> F.Column:
    out = None
    for i, s in enumerate(specs):
        arr = F.array(*[F.lit(float(p)) for p in s.probs])
        out = F.when(F.col("_s") == i, arr) if out is None else out.when(F.col("_s") == i, arr)
    return out


def edge_arrays(df: DataFrame, specs, tiebreak=None) -> DataFrame:
    """One row per (spec, group): (_s, _k, _n, _es = array of edges)."""
    specs = list(specs)
    long = _long_values(df, specs, tiebreak)
    # Range partitioning splits every group - also one holding a third of
    # the rows, the row hash spreads even a single hot value - over many
    # tasks.  The row id (partition index << 33 | row within the sorted
    # partition) is written with the values, so ranks are exact however the
    # table is read back, and survive executor loss.
    ranked = cut_lineage(long.repartitionByRange("_s", "_k", "_v", "_t")
                         .sortWithinPartitions("_s", "_k", "_v", "_t")
                         .withColumn("_row", F.monotonically_increasing_id()),
                         "ranked")
    ranked = ranked.withColumn("_pid", F.shiftright("_row", 33))
    # per (partition, group): rows and first row id -> at most
    # (#partitions + #groups) rows; offsets are running sums over partitions
    part = ranked.groupBy("_pid", "_s", "_k").agg(
        F.count(F.lit(1)).alias("_c"), F.min("_row").alias("_first"))
    w = Window.partitionBy("_s", "_k").orderBy("_pid")
    part = part.withColumns({
        "_off": F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)),
        "_n": F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding,
                                             Window.unboundedFollowing)),
    })
    # one row per group (its first partition); positions h = (n - 1) * p
    groups = (part.where(F.col("_off") == 0)
              .select("_s", "_k", "_n", _probs_col(specs).alias("_p"))
              .withColumn("_h", F.transform("_p", lambda p: (F.col("_n") - 1).cast("double") * p))
              .withColumn("_need", F.array_distinct(F.flatten(F.transform(
                  "_h", lambda h: F.array(F.floor(h).cast("long"), F.ceil(h).cast("long")))))))
    # the values at the needed ranks: at most 2 x (bins + 1) per group
    picked = (ranked.join(F.broadcast(part.select("_pid", "_s", "_k", "_off", "_first")),
                          ["_pid", "_s", "_k"])
              .withColumn("_rank", F.col("_off") + F.col("_row") - F.col("_first"))
              .join(F.broadcast(groups.select("_s", "_k", "_need")), ["_s", "_k"])
              .where(F.array_contains("_need", F.col("_rank"))))
    vals = picked.groupBy("_s", "_k").agg(
        F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_m"))

    def edge(h):
        lo = F.element_at("_m", F.floor(h).cast("long"))
        hi = F.element_at("_m", F.ceil(h).cast("long"))
        # equal neighbours may both be infinite: their difference is no number
        return F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (h - F.floor(h)))

    return (groups.join(vals, ["_s", "_k"], "left")
            .select("_s", "_k", "_n", F.transform("_h", edge).alias("_es")))


def find_edges(df: DataFrame, specs, method: str, tiebreak=None) -> DataFrame:
    """Edges (_s, _k, _n, _es) by one of the three methods."""
    from panelmart.operators.selection import edge_arrays_by_counting
    from panelmart.operators.sketches import edge_arrays_by_sketch
    if method == "sort":
        return edge_arrays(df, specs, tiebreak)
    if method == "count":
        return edge_arrays_by_counting(df, specs)
    if method == "sketch":
        return edge_arrays_by_sketch(df, specs)
    raise ValueError(f"unknown method {method!r}")


def quantile_edges(df: DataFrame, specs, tiebreak=None) -> DataFrame:
    """Long table (_s spec index, _k group key, _i edge index, _n, _e edge).

    ``tiebreak``: columns that identify a row (e.g. entity, period) for the
    order of equal values; default all columns."""
    return (edge_arrays(df, specs, tiebreak)
            .select("_s", "_k", "_n", F.posexplode("_es").alias("_i", "_e")))


def edges_wide(edges: DataFrame, specs, by: str | None, key_name: str | None) -> DataFrame | None:
    """One row per group of the specs grouped ``by``, with columns
    ``_<name>_e<i>`` (bounded: one row per group)."""
    idx = [i for i, s in enumerate(specs) if s.by == by]
    if not idx:
        return None
    wide = edges.where(F.col("_s").isin(idx)).groupBy("_k").agg(
        *[F.max(F.when(F.col("_s") == i, F.col("_es"))).alias(f"_a{i}") for i in idx])
    wide = wide.select("_k", *[F.col(f"_a{i}")[j].alias(_edge_col(specs[i], j))
                               for i in idx for j in range(len(specs[i].probs))])
    if by is None:
        return wide.drop("_k")
    return wide.withColumn(key_name, F.col("_k").cast("int")).drop("_k")


def bin_label(spec: BinSpec, on_duplicate: str = "error") -> F.Column:
    """Label of ``spec.value`` given the edge columns already joined in.

    ``on_duplicate``: "error" raises when a group's edges are not strictly
    increasing (ties, one row, all null - what ``pd.qcut`` does), "null"
    gives the whole group NULL labels, "collapse" keeps the plain compare.
    """
    v = F.col(spec.value)
    k = len(spec.labels)
    e = [F.col(_edge_col(spec, i)) for i in range(k + 1)]
    lab = None
    for i in range(1, k):
        c = v <= e[i]
        lab = F.when(c, F.lit(spec.labels[i - 1])) if lab is None else lab.when(c, F.lit(spec.labels[i - 1]))
    lab = (lab.when(v.isNotNull(), F.lit(spec.labels[-1])) if lab is not None
           else F.when(v.isNotNull(), F.lit(spec.labels[-1])))
    if on_duplicate == "collapse":
        return F.when(v.isNotNull(), lab)
    bad = e[0].isNull()
    for i in range(k):
        bad = bad | (e[i] >= e[i + 1])
    if on_duplicate == "null":
        return F.when(v.isNotNull() & ~bad, lab)
    if on_duplicate == "error":
        msg = F.concat(F.lit(f"bin edges must be unique for {spec.name}: "),
                       F.concat_ws(", ", *[x.cast("string") for x in e]))
        return F.when(bad, F.raise_error(msg)).when(v.isNotNull(), lab)
    raise ValueError(f"unknown on_duplicate {on_duplicate!r}")


def add_bins(df: DataFrame, specs, on_duplicate: str = "error",
             extra_by_period: DataFrame | None = None, period: str | None = None,
             tiebreak=None, guards: dict | None = None, method: str = "sort") -> DataFrame:
    """Add one label column per spec.  ``method`` finds the edges: "sort" and
    "count" (:mod:`selection`) exactly, "sketch" (:mod:`sketches`) approximately.  Edge tables are joined by broadcast:
    they have one row per group, and groups are periods (bounded by the
    configured year range) or the single global group.

    ``guards`` maps a spec name to a condition (it may use the columns of
    ``extra_by_period``): where it is false the label is NULL and the bins
    are never evaluated, so a guarded-off group cannot raise."""
    specs = list(specs)
    edges = find_edges(df, specs, method, tiebreak)
    out = df
    bys = sorted({s.by for s in specs if s.by is not None})
    for by in bys:
        wide = edges_wide(edges, specs, by, by)
        if extra_by_period is not None and by == period:
            wide = extra_by_period.join(wide, by, "full")
        out = out.join(F.broadcast(wide), by, "left")
    if extra_by_period is not None and period not in bys:
        out = out.join(F.broadcast(extra_by_period), period, "left")
    glob = edges_wide(edges, specs, None, None)
    if glob is not None:
        # the global edges are one row: a scalar subquery, not a join
        names = glob.columns
        arr = glob.select(F.array(*[F.col(c) for c in names]).alias("_a")).scalar()
        out = out.withColumns({c: arr[i] for i, c in enumerate(names)})
    guards = guards or {}
    out = out.withColumns({
        s.name: (F.when(guards[s.name], bin_label(s, on_duplicate)) if s.name in guards
                 else bin_label(s, on_duplicate))
        for s in specs})
    helper = [_edge_col(s, i) for s in specs for i in range(len(s.probs))]
    return out.drop(*helper)
