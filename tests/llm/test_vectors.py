import numpy as np
import pytest
from pyspark.sql import functions as F

from panelmart.llm import embeddup, neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        base = rng.standard_normal(16)
        rows.append((i, [float(x) for x in base], i % 3))
        if i % 10 == 0:  # near copies, a chain, exact and scaled copies
            for j in range(5):
                rows.append((1000 + 10 * i + j, [float(x) for x in base + 0.12 * j * rng.standard_normal(16)], i % 3))
            rows.append((1000 + 10 * i + 6, [float(x) for x in base], i % 3))
            rows.append((1000 + 10 * i + 7, [float(2 * x) for x in base], i % 3))
    rows += [(5000, None, 0), (5050, [0.0] * 16, 0), (5100, [float("nan")] + [1.0] * 15, 0), (5150, [None] + [1.0] * 15, 0),
             (5200, [float("inf")] * 16, 1), (5250, [], 1), (5300, [1.0] * 3, 1), (5350, [1.0] * 16, None), (5400, [1.0] * 16, 2),
             (None, [1.0] * 16, 2), rows[0], (5450, [1.0] * 16, 2)]
    return spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit("clash")).withColumn("score", F.lit(0))


def good(rows):
    out = {}
    for r in rows:
        if r.vec_id is not None and r.embedding and None not in r.embedding:
            x = np.array(r.embedding, np.float32).astype(np.float64)
            if np.isfinite(x).all() and x.any():
                out[r.vec_id] = (x, r.label)
    return out


def cos(a, b):
    return np.cumsum(a * b)[-1] / (np.sqrt(np.cumsum(a * a)[-1]) * np.sqrt(np.cumsum(b * b)[-1]))


def test_nearest_is_exact(table, monkeypatch, spark):
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 4)
    have = good(table.collect())
    want = set()
    for q, (x, _) in have.items():
        if q % 50 == 0:
            near = sorted((-cos(x, y), v) for v, (y, _) in have.items() if v != q and len(y) == len(x))[:5]
            want |= {(q, i + 1, v, -s) for i, (s, v) in enumerate(near)}
    got = {tuple(r) for r in neighbours.nearest(table, table.where("vec_id % 50 = 0")).collect()}
    assert got == want
    none = spark.createDataFrame([], SCHEMA)
    assert neighbours.nearest(none, none).count() == 0


def test_links_are_exact(table, monkeypatch, spark):
    monkeypatch.setattr(embeddup, "BLOCK", 64)
    rows = table.collect()
    have = good(rows)
    links = {v: set() for v in have}
    for a, (x, la) in have.items():
        for b, (y, lb) in have.items():
            if a < b and la is not None and la == lb and len(x) == len(y) and cos(x, y) >= 0.93:
                links[a].add(b)
                links[b].add(a)

    def component(v):
        seen, todo = {v}, [v]
        while todo:
            for w in links.get(todo.pop(), ()):
                if w not in seen:
                    seen.add(w)
                    todo.append(w)
        return min(seen)

    got = embeddup.near_duplicates(table).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is None:
            assert not r.kept and r.component_id is None
        else:
            assert (r.n_links, r.component_id) == (len(links.get(r.vec_id, ())), component(r.vec_id))
            assert r.kept == (r.vec_id == r.component_id)
    assert sum(map(len, links.values())) > 300
    assert embeddup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_threshold_keeps_recall():
    t = embeddup.threshold()
    rng = np.random.default_rng(0)
    hits = (np.abs(rng.standard_normal((20_000, embeddup.PROJECTIONS))) <= embeddup.WINDOW).sum(axis=1)
    assert (hits >= t).mean() > 0.999


def test_repeated_ids_do_not_prune_others():
    from panelmart.llm.neighbours import Block, encode, tile
    from panelmart.llm.vectors import unit
    rng = np.random.default_rng(5)
    q = rng.standard_normal((1, 32))
    x = np.vstack([q + 0.01 * rng.standard_normal((6, 32)), rng.standard_normal((20, 32))])

    def block(ids, v):
        codes, scale, error = encode(unit(v))
        return Block(len(v), 32, np.array(ids, np.int64).tobytes(), codes.tobytes(), scale.tobytes(),
                     error.tobytes(), v.tobytes())

    [(_, ids, score)] = tile(block([99], q), block([7] * 6 + list(range(100, 120)), x), 5)
    true = np.argsort(-(unit(x[6:]) @ unit(q)[0]))[:4] + 100
    assert {7, *true.tolist()} <= set(ids.tolist())


def exact(rows, k=5):
    """(query id, rank, vec_id, score) by brute force, of rows with distinct ids."""
    have = good(rows)
    return {(q, i + 1, v, -s) for q, (x, _) in have.items() if q % 50 == 0 for i, (s, v) in enumerate(
        sorted((-cos(x, y), v) for v, (y, _) in have.items() if v != q and len(y) == len(x))[:k])}


def test_copied_blocks_are_not_broadcast(table):
    plan = neighbours.nearest(table, table.where("vec_id % 50 = 0"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_blocks_are_copied_once_a_group_of_the_other_side(table):
    """A side's copies are the other's groups; vectors are stored as wide as given."""
    assert neighbours.grid(0, 0, 0) == (1, 1)
    assert neighbours.grid(64 * 10, 64 * 500, 3) == (1, 3)
    assert neighbours.grid(64 * 12_312, 64 * 615_384, 310) == (1, neighbours.CELLS)
    assert neighbours.grid(64 * 1_000_000, 64 * 50_000_000, 25_000) == (16, 191)
    stored = neighbours.blocks(table.select("vec_id", F.col("embedding").alias("vector")).where("vec_id < 300"), 64).collect()
    assert sum(r.n for r in stored) >= 300 and all(len(r.vectors) == 4 * r.n * r.dim for r in stored)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_groups_of_both_sides_are_exact(table, monkeypatch, kind):
    for name, value in (("BLOCK", 32), ("QUERY_BLOCK", 2), ("QUERY_GROUP", 40), ("GROUP", 900), ("CHUNK", 50), ("CELLS", 7)):
        monkeypatch.setattr(neighbours, name, value)
    vectors = table.withColumn("embedding", F.col("embedding").cast(f"array<{kind}>"))
    got = [tuple(r) for r in neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0")).collect()]
    assert len(got) == len(set(got)) and set(got) == exact(table.collect())


def test_best_keeps_ties_and_the_nearest_of_a_repeated_id():
    from panelmart.llm.neighbours import Best, Block
    rng = np.random.default_rng(8)

    def block(ids, v):
        v = np.asarray(v, np.float64)
        return Block.of(len(v), v.shape[1], np.array(ids, np.int64).tobytes(), v.tobytes())

    q = rng.standard_normal((3, 24))
    x = np.vstack([q[0] + 0.05 * rng.standard_normal((40, 24)), np.tile(q[1], (30, 1)), rng.standard_normal((50, 24))])
    ids = np.concatenate([np.arange(40) // 4, np.arange(130, 100, -1), np.arange(200, 250)])
    best = Best(block([5, 120, 999], q), 4)
    for at in np.array_split(rng.permutation(len(x)), 5):
        best.meet(block(ids[at], x[at]))
    for row, (own, y) in enumerate(zip([5, 120, 999], q, strict=True)):
        scores = {}
        for v, z in zip(ids.tolist(), x, strict=True):
            if v != own:
                scores[v] = max(cos(y, z), scores.get(v, -2))
        want = sorted(scores.items(), key=lambda t: (-t[1], t[0]))[:4]
        assert list(zip(best.ids[row].tolist(), best.scores[row].tolist(), strict=True)) == want
    assert best.found().num_rows == 12


def test_valid_vectors():
    import pyarrow as pa
    from panelmart.llm.vectors import valid
    nan, inf = float("nan"), float("inf")
    rows = [None, [1.0, 2.0], [], [0.0, 0.0], [0.0, -1.0, 0.0], [1.0, None], [nan], [inf, 1.0], [-inf], [], [1e-30], None, [3.0]]
    want = [False, True, False, False, True, False, False, False, False, False, True, False, True]
    for kind in (pa.float32(), pa.float64()):
        x = pa.array(rows, pa.list_(kind))
        assert valid(x).tolist() == want and valid(x.slice(3, 5)).tolist() == want[3:8]
        assert valid(x.slice(0, 0)).tolist() == [] and valid(x.slice(2, 2)).tolist() == [False, False]
    assert not valid(pa.array([[1e200, 1e200], [1e-200]], pa.list_(pa.float64()))).any()
