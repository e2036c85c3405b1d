import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelmart.llm import hardneg

SCHEMA = "vec_id long, label long, embedding array<float>, anchor boolean"


def brute(rows, k=5, n=3, low=50, high=95):
    good, seen = [], set()
    for vec_id, label, e, anchor in rows:
        if vec_id is None or label is None or not e or any(x is None or not math.isfinite(x) for x in e):
            continue
        codes = tuple(math.floor(256 * float(np.float32(x))) for x in e)
        if (vec_id, label, codes) in seen:
            continue
        seen.add((vec_id, label, codes))
        good.append((vec_id, label, codes, any(r[3] and r[0] == vec_id and r[1] == label for r in rows)))
    out = []
    for a, label, x, anchor in good:
        if not anchor:
            continue
        scores = sorted((-sum(map(int.__mul__, x, y)), v, lab) for v, lab, y, _ in good if v != a and len(y) == len(x))
        for ps, p, _ in [s for s in scores if s[2] == label][:k]:
            near = [s for s in scores if s[2] != label and low * -ps <= 100 * -s[0] <= high * -ps][:n]
            out += [(a, p, i + 1, v, -ps, -s) for i, (s, v, _) in enumerate(near)]
    return sorted(out)


def run(spark, rows, **more):
    table = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, hardneg.mine(table, **more).collect()))


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(8)
    centres = r.normal(size=(6, 12)) / 3
    x = centres[r.integers(0, 6, 700)] + r.normal(size=(700, 12)) / 12
    x[500:620] = x[500]  # one common vector
    return [(i, int(r.integers(0, 4)), x[i].tolist(), i % 9 == 0) for i in range(700)]


@pytest.mark.parametrize("sizes", [(128, 256, 512, 256, 8), (8, 16, 5, 4, 2)])
def test_against_all_scores(spark, rows, monkeypatch, sizes):
    for name, n in zip(("BLOCK", "ZONES", "ANCHORS", "CELL", "AT_ONCE"), sizes, strict=True):
        monkeypatch.setattr(hardneg, name, n)
    want = brute(rows)
    assert len(want) > 200
    assert run(spark, rows) == want


def test_other_parameters(spark, rows):
    assert run(spark, rows, positives=2, negatives=7, low=10, high=60) == brute(rows, 2, 7, 10, 60)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5], True), (1, 1, [0.9, 0.5], False), (2, 2, [0.6, 0.2], None), (2, 2, [0.6, 0.2], False),
            (3, 2, [0.0, 0.0], True), (4, None, [1.0, 1.0], True), (5, 1, None, True), (6, 1, [1.0, None], True), (7, 1, [nan, 1.0], True),
            (8, 1, [inf, 1.0], True), (9, 2, [], True), (10, 2, [0.5], True), (11, 2, [0.25], False), (12, 3, [0.3], False),
            (None, 2, [0.6, 0.2], True), (13, 2, [-1.0, -0.5], True), (14, 2, [0.6, 0.2], False), (0, 3, [0.7, 0.1], True),
            (15, 3, [300.0, 200.0], False), (16, 5, [250.0, 100.0], True), (17, 5, [1.0, 1.0], False)]
    want = brute(rows)
    assert want and run(spark, rows) == want


def test_empty_and_clashing(spark, rows):
    assert run(spark, []) == []
    assert run(spark, [(1, None, [1.0], True)]) == []
    names = ["key", "codes", "block", "dim", "n", "ids", "first", "chunk", "salt", "rank", "score", "positives", "place"]
    table = spark.createDataFrame(rows[:200], SCHEMA).withColumns({c: F.lit("clash") for c in names})
    assert sorted(map(tuple, hardneg.mine(table).collect())) == brute(rows[:200])


def test_curve_visits_every_cell_by_steps_of_one():
    for dim, bits in ((2, 3), (3, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dim, indexing="ij"), -1).reshape(-1, dim)
        planes = hardneg.hilbert(cells, bits)
        place = planes @ (1 << np.arange(dim * bits)[::-1])
        assert sorted(place) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def test_bounds_hold_and_prune():
    r = np.random.default_rng(1)
    zones = [r.integers(-5, 5, 8) * 20 + r.integers(-4, 5, (30, 8)) for _ in range(50)]
    anchors = r.integers(-100, 100, (20, 8)).astype(float)
    least, most = hardneg.bounds(anchors, np.array([z.min(0) for z in zones], float), np.array([z.max(0) for z in zones], float))
    for j, z in enumerate(zones):
        s = anchors @ z.T
        assert (least[:, j] <= s.min(1)).all() and (s.max(1) <= most[:, j]).all()
    assert np.mean(most < np.median(least)) > 0.1  # some zones lie wholly below others


def test_blocks_far_from_all_windows_are_not_read(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "BLOCK", 16)
    rows = [(i, i % 2, [float(np.cos(a)), float(np.sin(a))], i == 0) for i in range(2000) for a in [i * 2 * np.pi / 2000]]
    picked = []
    real = hardneg.read

    def read(chunks, stored, picks, *more):
        picked.append((picks.count(), stored.count()))
        return real(chunks, stored, picks, *more)

    monkeypatch.setattr(hardneg, "read", read)
    assert run(spark, rows) == brute(rows)
    (positives, all_blocks), (negatives, _) = picked
    assert positives <= 0.1 * all_blocks and negatives <= 0.5 * all_blocks
