"""Property tests of the distributed exact quantile edges.

Random groups, hot values, NULLs and many range partitions: the edges must
equal numpy's linear-interpolation quantiles exactly (up to float noise)."""
import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelmart import config as C
from panelmart.operators import quantiles

SPECS = [quantiles.BinSpec("q", "x", "g", C.QUARTILE_LABELS),
         quantiles.BinSpec("t", "x", "g", C.TIER_LABELS),
         quantiles.BinSpec("gq", "y", None, C.QUARTILE_LABELS)]

values = st.one_of(st.none(), st.integers(-5, 5).map(float),
                   st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.integers(0, 3), values, values), min_size=1, max_size=120),
       hot=st.integers(0, 60), parts=st.sampled_from([1, 3, 17, 40]))
def test_edges_equal_numpy(spark, rows, hot, parts):
    rows = rows + [(0, 2.0, 2.0)] * hot  # a hot value in group 0
    data = [(str(i), g, x, y) for i, (g, x, y) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, g int, x double, y double")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {(r["_s"], r["_k"], r["_i"]): r["_e"]
               for r in quantiles.quantile_edges(df, SPECS, tiebreak=["k"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    exp = {}
    for si, spec in enumerate(SPECS):
        groups = {}
        for k, g, x, y in data:
            v = x if spec.value == "x" else y
            key = g if spec.by else 0
            if v is not None:
                groups.setdefault(key, []).append(v)
        for key, vs in groups.items():
            for i, e in enumerate(np.quantile(np.array(vs), spec.probs)):
                exp[(si, key, i)] = float(e)
    assert got.keys() == exp.keys()
    for k, e in exp.items():
        assert got[k] == pytest.approx(e, rel=1e-9, abs=1e-9), k


def test_hot_value_spreads_over_range_partitions(spark):
    """A value held by a third of all rows must not land in one task."""
    from pyspark.sql import functions as F
    rows = [(str(i), 2019, -7.0 if i % 3 == 0 else float(i)) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, g int, x double")
    spec = [quantiles.BinSpec("q", "x", "g", C.QUARTILE_LABELS)]
    long = quantiles._long_values(df, spec, tiebreak=["k"])
    parts = (long.repartitionByRange(16, "_s", "_k", "_v", "_t")
             .where(F.col("_v") == -7.0)
             .groupBy(F.spark_partition_id().alias("p")).count().collect())
    hot = sum(r["count"] for r in parts)
    assert hot == 2000
    assert len(parts) >= 4 and max(r["count"] for r in parts) <= hot / 3
