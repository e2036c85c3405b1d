from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelmart.llm import mixing


def check(docs, weights=mixing.WEIGHTS):
    rows = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(3)).collect()
    key = lambda r: (str(r.doc_id), str(r.text), str(r.mix_draws))
    assert sorted(map(key, rows)) == sorted(map(key, again))
    size, goal, took, largest = defaultdict(int), {}, defaultdict(int), defaultdict(int)
    for r in rows:
        words = len((r.text or "").encode().split())
        assert r.mix_size == words and len(r.mix_draws) <= 3 and (words or not r.mix_draws)
        size[r.source] += words
        took[r.source] += words * len(r.mix_draws)
        goal[r.source] = r.mix_target
        assert len({d.epoch for d in r.mix_draws}) == len(r.mix_draws)
    names = sorted(x for x in size if x is not None) + [None] * (None in size)
    want = mixing.targets([size[x] for x in names], [weights[i % 3] for i in range(len(names))])
    for r in rows:
        assert r.mix_source_size == size[r.source]
    return names, size, want, goal, took


def test_given_table(docs):
    names, size, want, goal, took = check(docs)
    for x, t in zip(names, want, strict=True):
        assert goal[x] == pytest.approx(t) and abs(took[x] - t) <= 0.05 * t + 5


def test_odd_rows(odd_docs, no_docs, clashing):
    names, size, want, goal, took = check(odd_docs)
    for x, t in zip(names, want, strict=True):
        assert goal[x] == pytest.approx(t) and goal[x] <= 3 * size[x]
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mix(clashing).count() == 30 and "target" in mixing.mix(clashing).columns


def test_targets():
    assert mixing.targets([10, 10], [1, 3]) == [5.0, 15.0]
    assert mixing.targets([97, 1, 2], [1, 2, 3]) == [91.0, 3.0, 6.0]
    assert mixing.targets([0, 0], [1, 2]) == [0.0, 0.0] and mixing.targets([], []) == []


def test_tree_splits_exactly():
    quotas = np.array([100, 0, 7, 33])
    leaves = mixing.split_tree(quotas, 6, 1)
    assert (leaves.sum(axis=0) == quotas).all() and leaves.sum(axis=1).max() - leaves.sum(axis=1).min() <= 3
    assert (leaves == mixing.split_tree(quotas, 6, 1)).all()


def test_the_tree_deals_the_shards(docs, monkeypatch):
    """Each leaf has its even share of the block draws, and of each source
    what the tree drew for it."""
    plans, real = [], mixing._shards

    def shards(plan, leaves, seed):
        out = real(plan, leaves, seed)
        plans.append((plan, out))
        return out

    monkeypatch.setattr(mixing, "_shards", shards)
    rows = mixing.mix(docs, shards=6).collect()
    plan, cuts = plans[0]
    draws, begins = plan.collect(), {r.n: r.cuts for r in cuts.collect()}
    quota = {n: sum(d.n == n for d in draws) for n in begins}
    leaf = lambda d: max(i for i, c in enumerate(begins[d.n]) if c <= d.draw)
    per_leaf = np.bincount([leaf(d) for d in draws], minlength=6)
    assert per_leaf.sum() == sum(quota.values()) and np.ptp(per_leaf) <= 3
    total = np.zeros(mixing.BUCKETS, np.int64)
    for n, q in quota.items():
        total[n % mixing.BUCKETS] += q
    tree = mixing.split_tree(total, 6, mixing.SEED)
    for n in quota:  # fewer sources than buckets: the driver's tree decides
        assert [sum(leaf(d) == i for d in draws if d.n == n) for i in range(6)] == tree[:, n].tolist()
    where = {(d.source, d.block, d.epoch): leaf(d) for d in draws if d.room is None}
    seen = defaultdict(set)
    for r in rows:
        for d in r.mix_draws:
            seen[r.source, d.epoch, d.shard].add(r.doc_id)
    found = defaultdict(int)
    for (source, _, epoch), i in where.items():
        found[source, epoch, i] += 1
    assert all(seen[k] for k in found)  # every leaf's draws are rows of its shard


def test_the_tree_is_what_decides(docs, monkeypatch):
    rows = {r.doc_id: [(d.epoch, d.shard) for d in r.mix_draws] for r in mixing.mix(docs).collect()}
    monkeypatch.setattr(mixing, "split_tree", lambda q, n, seed: np.vstack([q, np.zeros((n - 1, len(q)), np.int64)]))
    other = {r.doc_id: [(d.epoch, d.shard) for d in r.mix_draws] for r in mixing.mix(docs).collect()}
    assert rows != other and {s for x in other.values() for _, s in x} == {0}


def test_null_ids_and_repeated_rows(spark):
    base = spark.range(1200).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"),
        F.concat_ws(" ", F.array_repeat(F.concat(F.lit("w"), F.col("id").cast("string")), F.col("id").cast("int") % 23 + 1)).alias("text"),
        F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("source"))
    hot = spark.range(900).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one row again").alias("text"), F.lit("s1").alias("source"))
    docs = base.unionByName(hot)
    names, size, want, goal, took = check(docs)
    for x, t in zip(names, want, strict=True):
        assert goal[x] == pytest.approx(t) and abs(took[x] - t) <= 0.002 * t + 2


def test_many_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKETS", 4)  # sources share buckets: the tree goes on in tasks
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.array_repeat(F.lit("w"), F.col("id").cast("int") % 7 + 1)).alias("text"),
                                    (F.col("id") % 40).cast("string").alias("source"))
    names, size, want, goal, took = check(docs)
    assert len(names) == 40
    for x, t in zip(names, want, strict=True):
        assert goal[x] == pytest.approx(t) and abs(took[x] - t) <= 0.02 * t + 3
    shards = defaultdict(int)
    for r in mixing.mix(docs).collect():
        for d in r.mix_draws:
            shards[d.shard] += 1
    assert len(shards) == mixing.OUT_SHARDS and max(shards.values()) <= 1.5 * min(shards.values())


def test_own_column_names(spark, docs):
    names = ["mix_size", "mix_hash", "mix_plan", "mix_name", "mix_id", "mix_more", "row", "size", "unit", "block", "sort", "n", "plan", "draws", "shard", "place", "d"]
    table = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    out = mixing.mix(table)
    assert dict(out.dtypes)["mix_size"] == "bigint"
    assert all(r["mix_plan"] == f"mix_plan{r.doc_id}" and r["row"] == f"row{r.doc_id}" for r in out.limit(50).collect())
    rows = mixing.mixed_rows(table).select("row.*")
    assert rows.columns == table.columns and all(r[n] == f"{n}{r.doc_id}" for r in rows.limit(50).collect() for n in names)


def test_split_under_a_bucket():
    quotas, takes = np.array([30, 1, 0, 9]), np.array([10, 10, 15, 5])
    split = mixing.split_under(quotas, takes, 3, "0:")
    assert (split.sum(axis=0) == quotas).all() and (split.sum(axis=1) == takes).all()


def test_mixed_rows_and_hot_source(spark):
    docs = spark.range(2000).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.array_repeat(F.lit("w"), F.col("id").cast("int") % 9 + 1)).alias("text"),
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.lit(None)).alias("source"))
    taken = {r.doc_id: len(r.mix_draws) for r in mixing.mix(docs).collect()}
    out = mixing.mixed(docs)
    count = {r[0]: r[1] for r in out.groupBy("doc_id").count().collect()}
    assert count == {k: v for k, v in taken.items() if v}
    assert out.select("mix_shard").distinct().count() == mixing.OUT_SHARDS
