"""Panel feature semantics on hand-written panels (one per trap)."""
import math
import random

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelmart import config as C
from panelmart.operators import features, panel, quantiles
from tests.helpers import by_key, cfg, panel_df


def _series(spark, rows, **kw):
    return features.add_features(panel_df(spark, rows), cfg(**kw))


def test_growth_pads_nulls_t2(spark):
    # incidence = cases (density x area = 100000): 1, null, 3, 0, 2
    cases = [1, None, 3, 0, 2]
    rows = [dict(kode_bps="A", tahun=2019 + i, jumlah_kasus_dbd=c) for i, c in enumerate(cases)]
    got = by_key(_series(spark, rows), "yoy_growth_rate")
    vals = [got[("A", 2019 + i)][0] for i in range(5)]
    assert vals[0] is None
    assert vals[1] == pytest.approx(0.0) and vals[2] == pytest.approx(200.0)
    assert vals[3] == pytest.approx(-100.0) and vals[4] == math.inf


def test_growth_without_pad(spark):
    rows = [dict(kode_bps="A", tahun=2019 + i, jumlah_kasus_dbd=c) for i, c in enumerate([1, None, 3])]
    got = by_key(_series(spark, rows, growth_pad=False), "yoy_growth_rate")
    assert [got[("A", y)][0] for y in (2019, 2020, 2021)] == [None, None, None]


def test_incidence_zero_divisor_t3(spark):
    rows = [dict(kode_bps="A", tahun=2019, jumlah_kasus_dbd=5, kepadatan_penduduk=0.0),
            dict(kode_bps="B", tahun=2019, jumlah_kasus_dbd=0, kepadatan_penduduk=0.0)]
    got = by_key(_series(spark, rows), "incidence_rate")
    assert got[("A", 2019)][0] == math.inf and got[("B", 2019)][0] is None


def test_lag_cascade_w7(spark):
    rows = [dict(kode_bps="A", tahun=2019 + i, rainfall_annual=float(i + 1)) for i in range(4)]
    got = by_key(_series(spark, rows), "lag1_rainfall", "lag2_rainfall", "lag3_rainfall")
    assert [got[("A", 2019 + i)] for i in range(4)] == [
        (1.0, 1.0, 1.0), (1.0, 1.0, 1.0), (2.0, 1.0, 1.0), (3.0, 2.0, 1.0)]


def test_lag_is_by_row_t10_and_densify(spark):
    rows = [dict(kode_bps="A", tahun=2019, rainfall_annual=1.0),
            dict(kode_bps="A", tahun=2021, rainfall_annual=3.0)]
    got = by_key(_series(spark, rows), "lag1_rainfall")
    assert got[("A", 2021)][0] == 1.0  # previous row, not previous year
    dense = panel.densify(panel_df(spark, rows), cfg(year_start=2019, year_end=2021))
    d = {r["tahun"]: r["rainfall_annual"] for r in dense.collect()}
    assert d == {2019: 1.0, 2020: None, 2021: 3.0}


def test_zscore_constant_group_w3_and_one_row_w8(spark):
    rows = [dict(kode_bps=k, tahun=2019, rainfall_annual=3.0) for k in "ABC"]
    rows.append(dict(kode_bps="D", tahun=2020, rainfall_annual=3.0))
    got = by_key(_series(spark, rows), "rainfall_zscore", "composite_vulnerability_index")
    assert all(v[0] is None for v in got.values())
    assert got[("D", 2020)][1] is None  # sample std of one row is undefined


def test_zscore_matches_population_std(spark):
    vals = [1.0, 2.0, 4.0, None]
    rows = [dict(kode_bps=k, tahun=2019, rainfall_annual=v) for k, v in zip("ABCD", vals)]
    got = by_key(_series(spark, rows), "rainfall_zscore")
    s = pd.Series(vals, dtype=float)
    z = (s - s.mean()) / s.std(ddof=0)
    for k, exp in zip("ABCD", z):
        g = got[(k, 2019)][0]
        assert (g is None and math.isnan(exp)) or g == pytest.approx(exp)


def test_tier_guard_t1(spark):
    two = [dict(kode_bps=k, tahun=2019, ndmi=v) for k, v in zip("ABCD", [1.0, 1.0, 2.0, 2.0])]
    three = [dict(kode_bps=k, tahun=2020, ndmi=v) for k, v in zip("ABC", [1.0, 2.0, 3.0])]
    got = by_key(_series(spark, two + three), "water_body_density_tier")
    assert all(got[(k, 2019)][0] is None for k in "ABCD")
    assert [got[(k, 2020)][0] for k in "ABC"] == ["Low", "Med", "High"]
    ref = by_key(_series(spark, two + three, tier_guard="reference"), "water_body_density_tier")
    assert all(v[0] is None for v in ref.values())


def _bins(spark, values, on_duplicate):
    df = spark.createDataFrame([(str(i), 2019, float(v)) for i, v in enumerate(values)],
                               "kode_bps string, tahun int, x double")
    spec = quantiles.BinSpec("q", "x", "tahun", C.QUARTILE_LABELS)
    out = quantiles.add_bins(df, [spec], on_duplicate=on_duplicate)
    return [r["q"] for r in out.orderBy(F.col("kode_bps").cast("int")).collect()]


def test_quartile_ties_t4(spark):
    with pytest.raises(PySparkException):
        _bins(spark, [1, 1, 1, 1, 2], "error")
    assert _bins(spark, [1, 1, 1, 1, 2], "null") == [None] * 5
    assert _bins(spark, [1, 1, 1, 1, 2], "collapse") == ["Q1", "Q1", "Q1", "Q1", "Q4"]
    assert _bins(spark, [1, 2], "error") == ["Q1", "Q4"]
    with pytest.raises(PySparkException):
        _bins(spark, [5], "error")
    assert _bins(spark, [5], "null") == [None]


def test_bins_match_pandas_qcut(spark):
    import numpy as np
    rnd = random.Random(7)
    rows = []
    for year in range(2019, 2025):
        n = rnd.randint(5, 60)
        for i in range(n):
            v = None if rnd.random() < 0.1 else round(rnd.gauss(0, 10), 3)
            rows.append((f"{year}-{i}", year, v))
    # a hot value: a third of one year's rows share it (duplicate edges)
    rows += [(f"hot-{i}", 2019, 5.0) for i in range(40)]
    df = spark.createDataFrame(rows, "kode_bps string, tahun int, x double").repartition(5)
    spec = quantiles.BinSpec("q", "x", "tahun", C.QUARTILE_LABELS)
    pdf = pd.DataFrame(rows, columns=["k", "tahun", "x"])
    # edges equal numpy's linear quantiles in every group, hot one included
    edges = quantiles.quantile_edges(df, [spec])
    got_e = {(r["_k"], r["_i"]): r["_e"] for r in edges.collect()}
    for year, g in pdf.groupby("tahun"):
        exp = np.quantile(g["x"].dropna().to_numpy(), spec.probs)
        for i, e in enumerate(exp):
            assert got_e[(year, i)] == pytest.approx(e, rel=1e-12, abs=1e-12)
    # labels equal pd.qcut; groups where qcut raises get NULL under "null"
    got = {r["kode_bps"]: r["q"] for r in
           quantiles.add_bins(df, [spec], on_duplicate="null").collect()}

    def qcut_or_none(s):
        try:
            return pd.qcut(s, 4, labels=list(C.QUARTILE_LABELS)).astype(object)
        except ValueError:
            return pd.Series([None] * len(s), index=s.index, dtype=object)

    exp = pdf.groupby("tahun")["x"].transform(qcut_or_none)
    assert exp[pdf["tahun"] == 2019].isna().all()
    for k, e in zip(pdf["k"], exp):
        assert got[k] == (None if pd.isna(e) else e), k


def test_global_quartile_and_tier(spark):
    rows = [dict(kode_bps=str(i), tahun=2019 + i % 3, kepadatan_penduduk=float(i)) for i in range(12)]
    got = by_key(_series(spark, rows), "kepadatan_quartile", "density_tier")
    exp = pd.qcut(pd.Series([float(i) for i in range(12)]), 4, labels=list(C.QUARTILE_LABELS))
    tier = dict(zip(C.QUARTILE_LABELS, C.DENSITY_TIER_LABELS))
    for i in range(12):
        assert got[(str(i), 2019 + i % 3)] == (exp[i], tier[exp[i]])


def test_ndvi_class_w5(spark):
    rows = [dict(kode_bps=k, tahun=2019, ndvi=v) for k, v in zip("ABCDE", [0.39, 0.4, 0.6, 0.61, None])]
    got = by_key(_series(spark, rows), "ndvi_class")
    assert [got[(k, 2019)][0] for k in "ABCDE"] == ["Sparse", "Moderate", "Moderate", "Dense", None]


def test_endemic_persistence_w13(spark):
    rows = []
    for y in range(2019, 2023):
        for k, c in zip("ABCD", [1, 2, 3, 4]):
            rows.append(dict(kode_bps=k, tahun=y, jumlah_kasus_dbd=c if k != "D" or y < 2022 else 0))
    got = by_key(_series(spark, rows), "ir_q", "endemic_persistence_score")
    assert got[("D", 2019)] == (4, 3) and got[("D", 2022)] == (1, 3)
    assert got[("A", 2019)][1] == 0


def test_deterministic_under_repartition(spark):
    rnd = random.Random(3)
    rows = [dict(kode_bps=str(k), tahun=y, jumlah_kasus_dbd=rnd.randint(1, 50),
                 rainfall_annual=rnd.random() * 100, lst_celsius=rnd.random() * 10 + 20,
                 ndvi=rnd.random(), ndmi=rnd.random())
            for k in range(30) for y in range(2019, 2024)]
    base = panel_df(spark, rows)
    cols = ["yoy_growth_rate", "rainfall_zscore", "lst_quartile_rank", "ir_q",
            "composite_vulnerability_index", "endemic_persistence_score", "kepadatan_quartile"]
    outs = [by_key(features.add_features(base.repartition(n), cfg()), *cols) for n in (1, 3, 7)]
    for other in outs[1:]:
        assert other.keys() == outs[0].keys()
        for k, vals in outs[0].items():
            for a, b in zip(vals, other[k]):
                if isinstance(a, float):
                    assert b == pytest.approx(a, rel=1e-9, abs=1e-12)
                else:
                    assert a == b  # labels and counts are exact


def test_properties_bin_sizes_and_zero_mean_z(spark):
    rnd = random.Random(11)
    rows = [dict(kode_bps=str(k), tahun=y, jumlah_kasus_dbd=rnd.randint(1, 10_000),
                 rainfall_annual=rnd.random() * 1000, lst_celsius=rnd.random() * 10 + 20,
                 ndvi=rnd.random(), ndmi=rnd.random(), kepadatan_penduduk=rnd.random() * 1e5)
            for k in range(41) for y in range(2019, 2023)]
    out = features.add_features(panel_df(spark, rows), cfg(on_duplicate_edges="error"))
    # equal-frequency bins: without ties the sizes differ by at most one
    for col in ("lst_quartile_rank", "ir_q"):
        sizes = {}
        for r in out.groupBy("tahun", col).count().collect():
            sizes.setdefault(r["tahun"], []).append(r["count"])
        for s in sizes.values():
            assert len(s) == 4 and max(s) - min(s) <= 1
    # per-period mean of the z-score is 0
    for r in out.groupBy("tahun").agg(F.avg("rainfall_zscore").alias("m")).collect():
        assert r["m"] == pytest.approx(0.0, abs=1e-9)
    assert out.count() == len(rows)  # features keep the panel grain


def test_tier_guard_prevents_duplicate_edge_error(spark):
    # 2 distinct ndmi values: guard off -> NULL tier, no error even in "error" mode
    rows = [dict(kode_bps=k, tahun=2019, ndmi=v, lst_celsius=float(i), jumlah_kasus_dbd=i + 1,
                 kepadatan_penduduk=100000.0 + i)
            for i, (k, v) in enumerate(zip("ABCDEF", [1.0, 1.0, 1.0, 1.0, 2.0, 2.0]))]
    out = features.add_features(panel_df(spark, rows), cfg(on_duplicate_edges="error"))
    assert {r["water_body_density_tier"] for r in out.collect()} == {None}


def test_infinite_values_keep_their_edges(spark):
    df = spark.createDataFrame([(str(i), 2019, v) for i, v in enumerate([1.0, 2.0, math.inf, math.inf, math.inf])],
                               "k string, tahun int, x double")
    spec = quantiles.BinSpec("q", "x", "tahun", C.QUARTILE_LABELS)
    got = [r["_e"] for r in quantiles.quantile_edges(df, [spec], ["k"]).orderBy("_i").collect()]
    assert got == [1.0, 2.0, math.inf, math.inf, math.inf]


def test_asked_for_features_equal_those_of_all(spark):
    rnd = random.Random(9)
    rows = [dict(kode_bps=str(k), tahun=y, jumlah_kasus_dbd=rnd.randint(1, 50), rainfall_annual=rnd.random(),
                 lst_celsius=rnd.random(), ndvi=rnd.random(), ndmi=rnd.random()) for k in range(9) for y in (2019, 2020)]
    p = panel_df(spark, rows)
    names = ["ndvi_class", "rainfall_zscore", "yoy_growth_rate", "density_tier", "endemic_persistence_score",
             "water_body_density_tier"]
    whole = by_key(features.add_features(p, cfg()), *names)
    for i, c in enumerate(names):
        some = by_key(features.add_features(p, cfg(), [c]), c)
        for k, v in whole.items():
            assert some[k][0] == (pytest.approx(v[i], rel=1e-9) if isinstance(v[i], float) else v[i]), c
