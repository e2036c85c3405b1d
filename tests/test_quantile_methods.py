"""Edges by counting and by sketches, against the sorted ones."""
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelmart import config as C
from panelmart.operators import quantiles, selection, sketches
from tests.test_quantiles_props import SPECS

INF = float("inf")


def table(spark, data):
    return spark.createDataFrame(data, "k string, g int, x double, y double").coalesce(2)


def edges(df):
    return {(r["_s"], r["_k"]): (r["_n"], r["_es"]) for r in df.collect()}


def same(a, b):
    assert a.keys() == b.keys()
    for key in a:
        assert a[key][0] == b[key][0]
        for x, y in zip(a[key][1], b[key][1], strict=True):
            assert x == y or (math.isnan(x) and math.isnan(y)), (key, a[key], b[key])


anything = st.one_of(st.none(), st.integers(-3, 3).map(float), st.floats(allow_nan=False),
                     st.sampled_from([INF, -INF, 0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, 1e-300, 1e300]))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.integers(0, 2), anything, anything), min_size=1, max_size=80), hot=st.integers(0, 40))
def test_counted_edges_are_the_sorted_ones(spark, rows, hot):
    df = table(spark, [(str(i), g, x, y) for i, (g, x, y) in enumerate([*rows, *[(0, 2.0, -1e-9)] * hot])])
    same(edges(selection.edge_arrays_by_counting(df, SPECS)), edges(quantiles.edge_arrays(df, SPECS, ["k"])))


@pytest.mark.parametrize("shape", ["even", "powers", "tight", "one"])
def test_passes_stay_few(spark, monkeypatch, shape):
    r = random.Random(5)
    make = {"even": lambda i: r.uniform(-1e6, 1e6), "powers": lambda i: 2.0 ** r.randint(-1000, 1000) * r.choice([-1, 1]),
            "tight": lambda i: 1.0 + r.random() * 1e-12 if i else 1e200, "one": lambda i: 7.0}[shape]
    df = table(spark, [(str(i), i % 2, make(i), make(i)) for i in range(3000)])
    passes, real = [], selection._pass

    def count(*a):
        passes.append(len(a[2]))
        return real(*a)

    monkeypatch.setattr(selection, "_pass", count)
    same(edges(selection.edge_arrays_by_counting(df, SPECS)), edges(quantiles.edge_arrays(df, SPECS, ["k"])))
    assert len(passes) <= {"even": 4, "powers": 12, "tight": 8, "one": 0}[shape]


def test_counting_shuffles_no_value(spark):
    """Every exchange of a pass is dealt by hash, behind a partial aggregate;
    nothing is dealt by ranges of values."""
    df = spark.range(100_000).selectExpr("cast(id as string) k", "cast(id % 3 as int) g", "rand(1) x", "rand(2) y")
    values = quantiles.long_values(df, SPECS)
    plan = selection.count_groups(values)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "partial_count" in plan


def test_too_many_groups_are_refused(spark, monkeypatch):
    monkeypatch.setattr(selection, "MAX_GROUPS", 2)
    df = table(spark, [(str(i), i, 1.0, 2.0) for i in range(3)])
    with pytest.raises(ValueError, match="sorting method"):
        selection.edge_arrays_by_counting(df, SPECS)


def test_no_rows(spark):
    assert edges(selection.edge_arrays_by_counting(table(spark, []), SPECS)) == {}
    assert edges(sketches.edge_arrays_by_sketch(table(spark, []), SPECS)) == {}


def test_small_sketches_are_exact(spark):
    r = random.Random(2)
    df = table(spark, [(str(i), i % 3, r.gauss(0, 1), float(r.randint(0, 4))) for i in range(900)])
    got = sketches.edge_arrays_by_sketch(df, SPECS)
    worst = sketches.rank_errors(df, SPECS, got).agg({"_error": "max"}).first()[0]
    assert worst == 0
    values = sorted(x["x"] for x in df.where("g = 1").collect())
    n, es = edges(got)[0, 1]
    assert n == 300 and es == [values[max(0, math.ceil(p * 300) - 1)] for p in SPECS[0].probs]


@pytest.mark.parametrize("size", [64, 512])
def test_rank_error_is_bounded(spark, size):
    df = spark.range(200_000, numPartitions=7).selectExpr(
        "cast(id as string) k", "cast(if(id % 3 = 0, 0, id % 2) as int) g",
        "if(id % 5 = 0, 1.0, pow(rand(3), 9) * 1e9) x", "rand(4) y")
    df = df.cache()
    try:
        got = sketches.edge_arrays_by_sketch(df, SPECS, size)
        worst = sketches.rank_errors(df, SPECS, got).agg({"_error": "max"}).first()[0]
        assert worst <= 3 * sketches.rank_error(size)
        exact = edges(quantiles.edge_arrays(df, SPECS, ["k"]))
        for key, (n, es) in edges(got).items():  # lowest and highest are exact
            assert (n, es[0], es[-1]) == (exact[key][0], exact[key][1][0], exact[key][1][-1])
    finally:
        df.unpersist()


def test_merged_sketches_know_all_rows(spark):
    r = random.Random(9)
    rows = [(str(i), i % 2, r.random(), r.random()) for i in range(1200)]
    parts = [table(spark, rows[a:b]) for a, b in ((0, 500), (500, 501), (501, 1200))]
    merged = sketches.edges_of(sketches.merge(*[sketches.sketch(p, SPECS) for p in parts]), SPECS)
    same(edges(merged), edges(sketches.edge_arrays_by_sketch(table(spark, rows), SPECS)))


def test_unknown_method(spark):
    with pytest.raises(ValueError, match="unknown method"):
        quantiles.find_edges(table(spark, []), SPECS, "guess")
    with pytest.raises(ValueError, match="sort, count or sketch"):
        C.PanelConfig(quantiles="guess")
