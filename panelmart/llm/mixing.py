"""Mixing sources to target weights by a multivariate-hypergeometric tree.

Each source's documents are dealt by hash into blocks.  A source gives an
exact quota of blocks: each block once for every whole epoch of its target,
and for the rest the blocks that come first in a seeded permutation, the last
one in part.  A binary tree over the output shards splits the quotas of all
sources: each node draws its left half's block counts from the multivariate
hypergeometric distribution, so that the leaves' counts add up exactly.  Each
leaf then draws its count of every source's permuted blocks, disjoint from
other leaves', and its rows are shuffled locally.

Blocks, permutations, running sums and draws are tables.  The driver sees the
scalars of the targets and the quotas of ``BUCKETS`` buckets of sources; a
bucket's own quotas are split below the driver's tree in one task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from panelmart.llm.common import cut_lineage, prepare, rank_within
from panelmart.operators.keys import number

WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3
BLOCKS = 512
OUT_SHARDS = 16
SEED = 20240
#: Buckets of sources whose quotas the driver's tree splits.
BUCKETS = 256
#: Parts of a block by hash, of which only one is summed up row by row.
PARTS = 256

ASCII_BLANK = r"[^\x20\x09-\x0D]+"
DRAWS = "array<struct<epoch:int,shard:int,place:long>>"


def targets(sizes: list[int], weights: list[float], most: float = MOST) -> list[float]:
    """Shares of all sizes by weight, none above ``most`` times its source's
    size; the excess is reshared by weight until none is above."""
    free = [i for i, s in enumerate(sizes) if s > 0]
    out, left = [0.0] * len(sizes), float(sum(sizes))
    while free:
        unit = left / sum(weights[i] for i in free)
        above = [i for i in free if weights[i] * unit > most * sizes[i]]
        if not above:
            for i in free:
                out[i] = weights[i] * unit
            break
        for i in above:
            out[i] = float(most * sizes[i])
            left -= out[i]
        free = [i for i in free if i not in above]
    return out


def _rng(*path) -> np.random.Generator:
    raw = hashlib.sha256(repr(path).encode()).digest()
    return np.random.default_rng(np.frombuffer(raw, np.uint64))


def split_tree(quotas: np.ndarray, leaves: int, seed: int, path: str = "") -> np.ndarray:
    """Split block quotas (one per source) among ``leaves``: leaves x sources.

    Every leaf gets its even share of blocks; which sources they come from
    is drawn without replacement.  Columns add up to ``quotas``.
    """
    if leaves == 1:
        return quotas[None, :]
    half = leaves // 2
    n = int(quotas.sum())
    take = n * half // leaves
    left = (_rng(seed, "split", path).multivariate_hypergeometric(quotas, take, method="marginals")
            if take else np.zeros_like(quotas))
    return np.vstack([split_tree(left, half, seed, path + "0"),
                      split_tree(quotas - left, leaves - half, seed, path + "1")])


def split_under(quotas: np.ndarray, takes: np.ndarray, seed: int, path: str) -> np.ndarray:
    """Split the quotas of one bucket's sources among leaves that take
    ``takes`` blocks each: the rest of the tree below the driver's."""
    if len(takes) == 1:
        return quotas[None, :]
    half = len(takes) // 2
    take = int(takes[:half].sum())
    left = (_rng(seed, "under", path).multivariate_hypergeometric(quotas, take, method="marginals")
            if take else np.zeros_like(quotas))
    return np.vstack([split_under(left, takes[:half], seed, path + "0"),
                      split_under(quotas - left, takes[half:], seed, path + "1")])


def _targets(sources: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """source, n (its place), size and target of every source; see
    :func:`targets`, whose rounds are an aggregate each."""
    names = sources.where("source is not null").select("source")
    top = names.count()
    placed = number(names, ["source"], "n").unionByName(
        sources.where("source is null").select("source", F.lit(top).cast("long").alias("n")))
    weight = F.array(*[F.lit(float(w)) for w in weights])[F.pmod("n", F.lit(len(weights))).cast("int")]
    facts = cut_lineage(sources.join(placed, sources["source"].eqNullSafe(placed["source"])).select(
        sources["source"], "n", "size", weight.alias("weight")), "mix_sources")
    unit, size, w = 0.0, F.col("size"), F.col("weight")
    while True:
        above = w * unit > size * float(most)
        total, used, free = facts.agg(
            F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum(F.when(above, size * most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above & (size > 0), w)), F.lit(0.0))).first()
        now = (total - used) / free if free else unit
        if now == unit:
            break
        unit = now
    return facts.select("source", "n", "size", F.when(w * unit > size * float(most), size * float(most))
                        .when(size > 0, w * unit).otherwise(0.0).alias("target"))


def _keyed(docs: DataFrame, seed: int, blocks: int) -> DataFrame:
    """row (all of the caller's columns), source, size, unit (a hash that
    names the row), block and sort (the order within the block)."""
    text = F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull())
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col("source").cast("string").alias("source"),
                       F.coalesce(F.regexp_count("text", F.lit(ASCII_BLANK)), F.lit(0)).cast("long").alias("size"),
                       F.xxhash64(F.col("doc_id").cast("long"), text, F.col("source").cast("string"), F.lit(seed)).alias("unit"))
    return _placed(rows, seed, blocks)


def _placed(rows: DataFrame, seed: int, blocks: int) -> DataFrame:
    return rows.withColumns({"block": F.pmod(F.xxhash64("unit", F.lit(seed + 1)), F.lit(blocks)).cast("int"),
                             "sort": F.xxhash64("unit", F.lit(seed + 2))})


def _rows(docs: DataFrame, seed: int, blocks: int) -> tuple[DataFrame, DataFrame]:
    """(rows, narrow): ``_keyed`` with and without the caller's columns; the
    narrow table is stored.  Rows that repeat doc_id, text and source get
    units of their own, by a number among them; only then are all rows stored."""
    rows = _keyed(docs, seed, blocks)
    narrow = cut_lineage(rows.drop("row"), "mix_rows")
    again = narrow.groupBy("unit").count().where("count > 1").select("unit")
    if again.isEmpty():
        return rows, narrow
    stored = cut_lineage(rows.withColumn("number", F.monotonically_increasing_id()), "mix_docs")
    again = cut_lineage(again, "mix_again")
    copies = cut_lineage(stored.select("unit", "number").join(again, "unit"), "mix_copies")
    nth = rank_within(copies, ["unit"], ["number"], "nth").select("number", "nth")
    stored = stored.join(nth, "number", "left").withColumn(
        "unit", F.when(F.coalesce("nth", F.lit(0)) > 0, F.xxhash64("unit", "nth")).otherwise(F.col("unit")))
    stored = cut_lineage(_placed(stored.drop("nth", "number", "block", "sort"), seed, blocks), "mix_docs")
    return stored, stored.drop("row")


def _plan(narrow: DataFrame, facts: DataFrame, seed: int) -> DataFrame:
    """source, n, block, epoch, draw (its place among the source's draws) and
    room (null: the whole block; else the words wanted of it) of every draw."""
    sums = narrow.where("size > 0").groupBy("source", "block").agg(F.sum("size").alias("words"))
    want = F.round("target").cast("long")
    epochs = F.sequence(F.lit(0), F.ceil(want / F.col("size")).cast("int") - 1)
    some = sums.join(facts.where(want > 0), sums["source"].eqNullSafe(facts["source"])).select(
        sums["source"], "n", "block", "words", want.alias("want"), F.explode(epochs).alias("epoch"))
    # at most ``blocks`` rows an epoch, and most + 1 epochs, of a source
    order = W.partitionBy("n").orderBy("epoch", F.xxhash64("n", "block", "epoch", F.lit(seed + 3)), "block")
    before = F.coalesce(F.sum("words").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return (some.withColumns({"before": before, "draw": F.row_number().over(order) - 1}).where("before < want")
            .select("source", "n", "block", "epoch", "draw",
                    F.when(F.col("before") + F.col("words") > F.col("want"), F.col("want") - F.col("before")).alias("room")))


def _shards(plan: DataFrame, leaves: int, seed: int) -> DataFrame:
    """n and cuts: the first draw of each leaf among a source's draws.  The
    driver's tree splits the quotas of buckets of sources; a task goes on
    with the quotas of a bucket's sources."""
    quotas = plan.groupBy("n").agg(F.count(F.lit(1)).alias("q")).withColumn(
        "bucket", F.pmod("n", F.lit(BUCKETS)).cast("int"))
    quotas = cut_lineage(quotas, "mix_quotas")
    sums = dict(quotas.groupBy("bucket").agg(F.sum("q")).collect())  # at most BUCKETS rows
    total = np.array([sums.get(b, 0) for b in range(BUCKETS)], np.int64)
    takes = split_tree(total, leaves, seed)

    def under(bucket: pd.DataFrame) -> pd.DataFrame:
        bucket = bucket.sort_values("n", ignore_index=True)
        b = int(bucket["bucket"].iloc[0])
        split = split_under(bucket["q"].to_numpy(np.int64), takes[:, b], seed, f"{b}:")
        return pd.DataFrame({"n": bucket["n"], "cuts": (np.cumsum(split, axis=0) - split).T.tolist()})

    under.__annotations__ = {"bucket": pd.DataFrame, "return": pd.DataFrame}
    return quotas.groupBy("bucket").applyInPandas(under, "n long, cuts array<long>")


def _cut(narrow: DataFrame, partial: DataFrame) -> DataFrame:
    """source, block, upto (sort up to which the documents fit in the room)
    and rest (words still wanted) of the blocks that are taken in part.

    A block's rows are summed by ``PARTS`` ranges of their sort first; only
    the range in which the room ends is summed row by row."""
    part = F.shiftright(F.col("sort"), 64 - (PARTS - 1).bit_length())
    rows = narrow.where("size > 0").join(partial, (narrow["block"] == partial["block"]) & narrow["source"].eqNullSafe(
        partial["source"])).select("n", "sort", "unit", "size", "room", part.alias("part"))
    rows = cut_lineage(rows, "mix_partial")
    sums = rows.groupBy("n", "part", "room").agg(F.sum("size").alias("words"), F.max("sort").alias("last"))
    order = W.partitionBy("n").orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = sums.withColumn("sum", F.sum("words").over(order))
    whole = sums.where("sum <= room").groupBy("n").agg(F.max("last").alias("upto"), F.max("sum").alias("filled"))
    open_ = sums.where("sum > room").groupBy("n").agg(F.min(F.struct("part", (F.col("sum") - F.col("words")).alias("from"))).alias("x"))
    inner = rows.join(open_.select("n", "x.part", "x.from"), ["n", "part"])
    order = W.partitionBy("n").orderBy("sort", "unit").rowsBetween(W.unboundedPreceding, W.currentRow)
    inner = inner.withColumn("sum", F.col("from") + F.sum("size").over(order)).where("sum <= room").groupBy("n").agg(
        F.max("sort").alias("upto"), F.max("sum").alias("filled"))
    best = whole.unionByName(inner).groupBy("n").agg(F.max("upto").alias("upto"), F.max("filled").alias("filled"))
    return partial.join(best, "n", "left").select(
        "source", "n", "block", "upto", (F.col("room") - F.coalesce("filled", F.lit(0))).alias("rest"))


def _fillers(narrow: DataFrame, here: DataFrame, plan: DataFrame, cut: DataFrame, most: int) -> DataFrame:
    """unit, n, epoch and draw of the documents that fill what a source's
    partial block leaves: chosen among one document for each size class and
    sixteenth of the blocks, largest first, that are drawn less than ``most``
    times; the last may go beyond by less than it misses."""
    times = plan.where("room is null").groupBy("n", "block").agg(F.count(F.lit(1)).alias("times"))
    last = plan.where("room is not null").select("n", "epoch", "draw")
    open_ = cut.where("rest > 0").select("n", F.col("block").alias("cut_block"), "upto", "rest")
    info = here.join(open_, "n").join(times, ["n", "block"], "left").withColumnsRenamed({"source": "s", "block": "b"})
    rows = narrow.where("size > 0").join(info, (narrow["block"] == info["b"]) & narrow["source"].eqNullSafe(info["s"])).drop("s", "b")
    rows = rows.withColumn("drawn", F.coalesce("times", F.lit(0)) + ((F.col("block") == F.col("cut_block")) & (
        F.col("sort") <= F.coalesce("upto", F.lit(-1 << 63)))).cast("int")).where(F.col("drawn") < most)
    near = rows.where(F.col("size") < 2 * F.col("rest")).groupBy(
        "n", F.floor(F.log2("size")).alias("c"), (F.col("block") % 16).alias("b")).agg(
        F.min_by(F.struct("size", "unit", "drawn", "rest"), F.struct("sort", "unit")).alias("x"))

    def choose(one: pd.DataFrame) -> pd.DataFrame:
        have = one.sort_values(["size", "unit"], ascending=False)[["size", "unit", "drawn"]].to_numpy(np.int64).tolist()
        rest, taken = int(one["rest"].iloc[0]), []
        for x in have:
            while x[2] < most and x[0] <= rest:
                taken.append(x[1])
                x[2] += 1
                rest -= x[0]
        above = [x for x in have if x[2] < most and x[0] < 2 * rest]
        if above:
            taken.append(min(above)[1])
        return pd.DataFrame({"n": int(one["n"].iloc[0]), "unit": taken}, columns=["n", "unit"])

    choose.__annotations__ = {"one": pd.DataFrame, "return": pd.DataFrame}
    # at most 16 rows a size class, of which there are 63 at most
    return near.select("n", "x.*").groupBy("n").applyInPandas(choose, "n long, unit long").join(last, "n")


def _drawn(docs: DataFrame, weights: tuple[float, ...], most: int, blocks: int, shards: int, seed: int) -> DataFrame:
    """row, size, source_size, target and draws of every row."""
    prepare(docs.sparkSession)
    rows, narrow = _rows(docs, seed, blocks)
    sources = narrow.groupBy("source").agg(F.sum("size").alias("size"))
    facts = cut_lineage(_targets(sources, weights, most), "mix_targets")
    plan = cut_lineage(_plan(narrow, facts, seed), "mix_plan")
    cuts = _shards(plan, shards, seed)
    shard = lambda draw: F.size(F.filter("cuts", lambda c: c <= draw)) - 1  # noqa: E731  the last leaf that begins by then
    partial = cut_lineage(plan.where("room is not null").select("source", "n", "block", "room"), "mix_rooms")
    cut = cut_lineage(_cut(narrow, partial), "mix_cuts")
    cuts = cut_lineage(cuts, "mix_leaves")
    # all that is joined to rows is joined by source and block: a hot source is many keys
    here = narrow.select("source", "block").distinct()
    here = here.join(facts, here["source"].eqNullSafe(facts["source"])).select(
        here["source"], "block", "n", F.col("size").alias("source_size"), "target")
    here = cut_lineage(here, "mix_blocks")
    extra = cut_lineage(_fillers(narrow, here.select("source", "block", "n"), plan, cut, most), "mix_fillers")
    one = F.struct(F.col("epoch").cast("int").alias("epoch"), shard(F.col("draw")).cast("int").alias("shard"),
                   F.col("room").isNotNull().alias("part"))
    by_block = (here.join(plan.join(cuts, "n").groupBy("n", "block").agg(F.sort_array(F.collect_list(one)).alias("plan")), ["n", "block"], "left")
                .join(cut.select("n", "block", "upto"), ["n", "block"], "left")
                .withColumnsRenamed({"source": "block_source", "block": "block_number"}))
    # a filler's further draws count on from the epochs that it can have
    more = extra.join(cuts, "n").groupBy("unit").agg(F.sort_array(F.collect_list(F.struct(
        F.col("epoch").cast("int").alias("epoch"), shard(F.col("draw")).cast("int").alias("shard")))).alias("more"))
    out = rows.join(by_block, (rows["block"] == by_block["block_number"]) & rows["source"].eqNullSafe(by_block["block_source"]))
    out = out.join(more, "unit", "left")
    mine = F.filter("plan", lambda x: ~x["part"] | (F.col("sort") <= F.col("upto")))
    mine = F.coalesce(F.transform(mine, lambda x: F.struct(x["epoch"].alias("epoch"), x["shard"].alias("shard"))),
                      F.expr("cast(array() as array<struct<epoch:int,shard:int>>)"))
    top = F.coalesce(F.array_max(F.transform(mine, lambda x: x["epoch"])), F.lit(-1))
    added = F.transform(F.coalesce("more", F.expr("cast(array() as array<struct<epoch:int,shard:int>>)")),
                        lambda x, i: F.struct((F.lit(1) + top + i).cast("int").alias("epoch"), x["shard"].alias("shard")))
    draws = F.transform(F.concat(mine, added), lambda x: F.struct(x["epoch"].alias("epoch"), x["shard"].alias("shard"), F.xxhash64(
        "unit", x["epoch"], F.lit(seed + 4)).alias("place")))
    return out.select("row", "size", "source_size", "target", F.when(F.col("size") > 0, draws).otherwise(
        F.expr(f"cast(array() as {DRAWS})")).alias("draws"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, blocks: int = BLOCKS,
        shards: int = OUT_SHARDS, seed: int = SEED) -> DataFrame:
    """``docs`` with mix_size (words), mix_source_size, mix_target and
    mix_draws, an array of (epoch, shard, place) with one entry for each time
    the mix takes the document; ``place`` orders the rows of a shard.

    Reads doc_id, text and source; other columns pass through (columns of the
    names above are replaced).  Sources by code point, null last, take
    ``weights`` in turn.  A document is taken whole, at most ``most`` times.
    Of a source's one block that is taken in part, documents come in hashed
    order while they fit; some documents of the source then fill the rest as
    closely as they can.  Null and empty texts have size 0 and are never taken;
    repeated rows and rows with a null doc_id are dealt each for itself; an
    empty table gives an empty result.
    """
    new = {"mix_size": "size", "mix_source_size": "source_size", "mix_target": "target", "mix_draws": "draws"}
    out = _drawn(docs, weights, most, blocks, shards, seed)
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in new],
                      *[F.col(c).alias(name) for name, c in new.items()])


def mixed_rows(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, blocks: int = BLOCKS,
               shards: int = OUT_SHARDS, seed: int = SEED) -> DataFrame:
    """row (the caller's columns), shard and place for each time that a row is
    taken; a shard's rows are dealt by place and sorted within partitions."""
    out = _drawn(docs, weights, most, blocks, shards, seed).select("row", F.explode("draws").alias("d"))
    out = out.select("row", "d.shard", "d.place")
    return out.repartition("shard", F.pmod("place", F.lit(64))).sortWithinPartitions("shard", "place")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row of ``docs`` for each time it is taken, with
    mix_shard and mix_place, sorted by them within partitions."""
    names = [c for c in docs.columns if c not in ("mix_shard", "mix_place")]
    return mixed_rows(docs, **options).select(*[F.col("row")[c].alias(c) for c in names], F.col("shard").alias("mix_shard"),
                                              F.col("place").alias("mix_place"))
