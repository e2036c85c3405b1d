from collections import defaultdict
import zlib

import numpy as np
from pyspark.sql import functions as F

from panelmart.llm import sharding


def check(rows, docs, shards, spread):
    want = sorted(((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode()))
                   for r in docs), key=str)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=str) == want
    slots, size = defaultdict(list), defaultdict(int)
    for r in rows:
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert set(slots) <= set(range(shards))
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    if spread is not None:
        mean = sum(size.values()) / shards
        largest = max(r.size for r in rows)
        assert max(size.values()) - min(size.values() if len(size) == shards else [0]) <= max(spread * mean, largest)


def test_given_table(docs):
    check(sharding.shard(docs, 4).collect(), docs.collect(), 4, 0.05)


def test_hot_text_is_split(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the hot text " * 20)
        .otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    rows = sharding.shard(docs, 8).collect()
    check(rows, docs.collect(), 8, 0.03)


def test_blocks_merge(docs, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK", 20)  # ten blocks of groups, merged five at a time
    check(sharding.shard(docs, 4).collect(), docs.collect(), 4, 0.1)


def test_odd_rows(odd_docs, no_docs, clashing):
    check(sharding.shard(odd_docs, 3).collect(), odd_docs.collect(), 3, None)
    assert sharding.shard(no_docs).count() == 0
    assert sharding.shard(clashing).count() == 30


def test_vector_pack_balances_all_dimensions():
    rng = np.random.default_rng(1)
    w = np.column_stack([rng.integers(1, 100, 500), rng.integers(1, 50, 500), np.ones(500, int)])
    bins = sharding.vector_pack(w, 5)
    load = np.array([w[bins == b].sum(axis=0) for b in range(5)])
    assert (np.ptp(load, axis=0) <= 0.1 * load.mean(axis=0)).all()


def test_one_row_repeated_spreads_evenly(spark, docs):
    hot = spark.range(3000).select(F.lit(77).cast("long").alias("doc_id"), F.lit("one row " * 250).alias("text"))
    nulls = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    table = docs.select("doc_id", "text").unionByName(hot).unionByName(nulls)
    rows = sharding.shard(table, 8).collect()
    check(rows, table.collect(), 8, 0.03)
