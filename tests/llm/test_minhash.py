import random

import numpy as np
from pyspark.sql import functions as F

from panelmart.llm import minhash
from panelmart.llm.components import components

SCHEMA = "doc_id long, text string"


def shingles(text, n):
    w = [x.lower() for x in (text or "").encode().split()]
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, n, percent):
    sets = [shingles(r.text, n) for r in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b) or (
                    rows[i].doc_id is not None and rows[i].doc_id == rows[j].doc_id):
                root[top(i)] = top(j)
    ids = {}
    for i, r in enumerate(rows):
        ids.setdefault(top(i), []).append(r.doc_id)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(((r.doc_id, len(sets[i]), least[top(i)]) for i, r in enumerate(rows)), key=str)


def compare(docs, n, percent, **options):
    got = minhash.near_duplicates(docs, n, percent, **options).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(docs.collect(), n, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)


def test_given_table(docs):
    compare(docs, 3, 85)


def test_odd_rows(odd_docs, no_docs, clashing):
    compare(odd_docs, 5, 80)
    assert minhash.near_duplicates(no_docs).count() == 0
    assert minhash.deduplicate(no_docs).count() == 0
    assert set(minhash.deduplicate(clashing).columns) == set(clashing.columns)


def near_copies(spark):
    """Groups of edited copies of varying distance: chains, rims, strangers."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(3):
        base = [rng.choice(vocabulary) for _ in range(150)]
        for i in range(120):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 14])):
                copy[rng.randrange(150)] = rng.choice(vocabulary)
            rows.append((1000 * g + i, " ".join(copy)))
    return spark.createDataFrame(rows, SCHEMA)


def test_near_copies_all_ways(spark):
    docs = near_copies(spark)
    compare(docs, 3, 85)
    compare(docs, 3, 85, rounds=0)  # the tiles alone find every link
    kept = minhash.deduplicate(docs, 3, 85)
    assert kept.count() == len({c for *_, c in brute(docs.collect(), 3, 85)})


def test_many_blocks_of_an_arena(spark, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 16)
    docs = near_copies(spark)
    compare(docs, 3, 85, rounds=0)  # one own block, many others
    compare(docs, 3, 85, rounds=1)  # many own blocks


def test_one_id_with_several_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    docs = spark.createDataFrame([(1, a), (1, b), (2, b), (3, a + " more"), (4, "else where"), (4, "else where"), (9, None), (9, b + " end"),
                                  (None, a), (None, a), (5, "lone text")], SCHEMA)
    compare(docs, 3, 85)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 3, 85).collect()}
    assert got[3] == got[2] == got[9] == 1 and got[4] == 4
    # by text alone: a row of each text stays, also where two have one doc_id
    kept = sorted((r.doc_id, r.text) for r in minhash.deduplicate(docs, 3, 85).collect())
    assert kept == [(1, a), (1, b), (4, "else where"), (5, "lone text"), (9, None)]


def test_own_column_names(spark):
    names = ["_uid", "uid", "row", "number", "component", "id", "key", "digest", "joined"]
    docs = spark.createDataFrame([(1, "one two three four"), (2, "one two three four"), (3, "x")], SCHEMA)
    docs = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    kept = minhash.deduplicate(docs, 3, 85)
    assert kept.columns == docs.columns
    assert sorted(r["_uid"] for r in kept.collect()) == ["_uid1", "_uid3"]


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    sketcher = minhash.Sketcher(26, 5, 256, 16)
    limit = minhash.sketch_limit(0.85, 256, 1024)
    far = []
    for similar in [0.9] * 30 + [0.5] * 30:
        n = 400
        common = int(round(2 * n * similar / (1 + similar)))
        pool = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
        a, b = (sketcher.sketch(np.unique(s))[1].view(np.uint64) for s in (pool[:n], np.r_[pool[:common], pool[n:2 * n - common]]))
        far.append(int(np.bitwise_count(a ^ b).sum()))
    assert max(far[:30]) <= limit < min(far[30:])


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}
    assert components(links.limit(0)).count() == 0
