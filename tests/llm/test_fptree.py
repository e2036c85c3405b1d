import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelmart.llm import fptree

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    """Every document scored for every item."""
    have = [(d, terms(t)) for d, t in docs]
    n_docs = sum(bool(t) for _, t in have)
    total = sum(len(t) for _, t in have)
    df = {}
    for _, t in have:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in dict.fromkeys(items):
        hits = []
        for d, t in have:
            if not t:
                continue
            m = 75 + 25 * len(t) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * t.count(x) // (1000 * t.count(x) + 12 * m))
                    for x in terms(text) if x in df)
            if s > 0:
                hits.append((-s, d is None, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(hits, key=lambda h: (h[0], h[1], h[2] or 0))[:k])]
    return out


def same(got, want):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["née", "漢字", "A1", "x-y"]
    docs = [(i, " ".join(r.choices(words, weights=[1 / (j + 1) for j in range(len(words))], k=r.randint(0, 60)))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(60)]  # copies, more than are asked for
    items = [(i, " ".join(r.choices(words, k=r.randint(1, 12)))) for i in range(15)]
    return docs, items


@pytest.mark.parametrize("block, leaf", [(8192, 32), (64, 4), (16, 1)])
def test_against_all_scores(spark, corpus, monkeypatch, block, leaf):
    monkeypatch.setattr(fptree, "BLOCK", block)
    monkeypatch.setattr(fptree, "LEAF", leaf)
    docs, items = corpus
    same(fptree.search(*frames(spark, docs, items)).collect(), brute(docs, items))


def test_items_in_blocks(spark, corpus, monkeypatch):
    monkeypatch.setattr(fptree, "ITEMS", 4)
    docs, items = corpus
    same(fptree.search(*frames(spark, docs, items), k=3).collect(), brute(docs, items, 3))


def test_odd_rows(spark, odd_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    items = [(1, "one two"), (1, "one two"), (1, "WORDS"), (2, None), (3, ""), (None, "long x Zürich"), (5, "absent"), (6, "漢字 🙂 endoftext")]
    got = fptree.search(*frames(spark, docs, items)).collect()
    same(got, [x for x in brute(docs, items)])


def test_empty_tables_and_clashing(spark, clashing, no_docs):
    items = spark.createDataFrame([(1, "the and of")], "item_id long, text string").withColumn("score", F.lit("x"))
    assert fptree.search(no_docs, items).count() == 0
    assert fptree.search(clashing, items.limit(0)).count() == 0
    got = fptree.search(clashing, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    same(got.collect(), brute([(r.doc_id, r.text) for r in clashing.collect()], [(1, "the and of")]))


def test_long_texts_in_slices(monkeypatch):
    text = "Ein langer Text, mit vielen-Wörtern; " * 50
    whole = fptree.terms(text)
    monkeypatch.setattr(fptree, "SLICE", 7)
    assert fptree.terms(text) == whole
    assert whole[b"text"] == 50 and whole["wörtern".encode()] == 50


def test_bounds_hold_and_prune():
    """No document below a node scores above the node's bound, and most
    documents are never scored."""
    r = np.random.default_rng(3)
    n, n_ranks = 3000, 40
    rows = [np.unique(np.minimum(r.zipf(1.4, 12) - 1, n_ranks - 1)) for _ in range(n)]
    owner = np.repeat(np.arange(n), [len(x) for x in rows])
    ranks = np.concatenate(rows)
    tfs = r.integers(1, 6, len(ranks))
    ms = r.integers(80, 300, n).tolist()
    entries = fptree.entries_of(np.arange(n), ms, owner, ranks, tfs, 5)
    items = fptree.Items([0, 1], np.arange(n_ranks) * 50 + 10, np.arange(n_ranks), np.array([3, 20, 35, 0, 38]), np.ones(5, np.int64), np.array([0, 3]))
    root = fptree.tree(entries, n_ranks)

    def under(node):
        return node.entries or [e for c in node.children for e in under(c)]

    def score(e, item):
        lo, hi = [(0, 3), (3, 5)][item]
        return sum(int(items.gain(e[0][e[0] == t], e[1][e[0] == t], e[2]).sum()) for t in items.flat[lo:hi])

    def visit(node):
        dense = np.zeros(n_ranks, np.int64)
        dense[node.ranks] = items.gain(node.ranks, node.tf, node.m)
        bound = np.add.reduceat(dense[items.flat] * items.times, items.starts)
        for e in under(node)[:40]:
            assert all(score(e, i) <= bound[i] for i in (0, 1))
        for c in node.children:
            visit(c)

    visit(root)
    s = fptree.Search(items, 5)
    s.add(root)
    for i in (0, 1):
        best = sorted((-score(e, i), d) for e in entries for d in e[3] if score(e, i) > 0)[:5]
        assert s.best[i] == best
    assert s.looked < 0.5 * 2 * len(entries)
