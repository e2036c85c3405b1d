"""Plan-shape regression tests: the physical plans stay the ones we want."""
import re

import pytest

import __spark_entry__ as E
from panelmart.sources import driver_tables as dt

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["fact_panel", "surge_trend", "latest_pin_map", "run_record",
                                  "vulnerability_map", "check_min_rows", "centroids"])
def test_no_cartesian_or_nested_loop_joins(spark, name):
    s = _plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in s and "BroadcastNestedLoopJoin" not in s


def test_features_one_entity_shuffle(spark):
    s = _plan(E.queries()["customer_panel_features"](spark, SF))
    # growth, lags and persistence share one window spec -> one shuffle
    assert len(re.findall(r"Exchange hashpartitioning\(kode_bps#\d+, \d+\)", s)) == 1


def test_ingest_scans_are_pruned_and_preaggregated(spark):
    raw = dt.sources(spark, SF, "customer")
    s = raw.environment._jdf.queryExecution().executedPlan().toString()
    li = re.search(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem", s)
    assert li is not None
    cols = set(li.group(1).replace(" ", "").split(","))
    cols = {re.sub(r"#\d+L?$", "", c) for c in cols}
    assert cols == {"l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"}
    # line items are partially aggregated per (order, year) before any join
    first_agg = s.rfind("HashAggregate(keys=[l_orderkey")
    assert first_agg != -1 and "partial_sum" in s


def test_dedup_combines_before_the_shuffle(spark):
    from panelmart.operators import clean
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS o", "id * 2 AS v")
    s = _plan(clean.dedup_keep_first(df, ["k"], ["o"]))
    partial = s.find("partial_min_by")
    exchange = s.find("Exchange hashpartitioning(k")
    # printed top-down: the final aggregate, then the exchange, then the partial one
    assert partial != -1 and exchange != -1 and exchange < partial


def test_period_statistics_are_partial_aggregates(spark):
    from panelmart.operators import features
    df = spark.range(1000).selectExpr("cast(id % 4 as int) AS tahun", "rand(1) AS x")
    s = _plan(features.period_stats(df, "tahun", pop_cols=["x"], samp_cols=["x"]))
    assert "partial_avg" in s and "Window" not in s


def test_geometry_joins_whatever_the_period(spark):
    """Geometry is joined on the entity: a row outside the configured periods
    has its coordinates like any other."""
    from panelmart.operators import panel
    cfg = dt.config_for("nation")
    e, p = cfg.entity, cfg.period
    health = spark.createDataFrame([("1", cfg.year_start - 50, 3), ("1", cfg.year_start, 4), ("2", cfg.year_start, 5)],
                                   f"{e} string, {p} int, jumlah_kasus_dbd int")
    demography = spark.createDataFrame([], f"{e} string, {p} int, kepadatan_penduduk double, luas_km2 double")
    environment = spark.createDataFrame([], f"{e} string, {p} int, rainfall_annual double")
    geo = spark.createDataFrame([("1", 1.5, 2.5)], f"{e} string, latitude double, longitude double")
    rows = panel.assemble(health, demography, environment, geo, cfg).select("jumlah_kasus_dbd", "latitude").collect()
    assert sorted(map(tuple, rows), key=str) == [(3, 1.5), (4, 1.5), (5, None)]


@pytest.mark.parametrize("name", ["ndvi_class", "incidence_rate", "dim_period", "surge_trend"])
def test_building_an_unbinned_query_writes_nothing(spark, name, monkeypatch):
    from panelmart.operators import features, quantiles
    E.queries()["stage_geo"](spark, SF)  # lands the sources

    def refuse(df, name="table"):
        raise AssertionError(f"wrote {name}")
    monkeypatch.setattr(features, "cut_lineage", refuse)
    monkeypatch.setattr(quantiles, "cut_lineage", refuse)
    assert E.queries()[name](spark, SF).columns


def test_tier_guard_shuffles_by_period_only(spark):
    from panelmart.operators import features
    df = spark.range(1000).selectExpr("cast(id % 4 as int) AS tahun", "rand(1) AS x")
    s = _plan(features.three_values(df, "tahun", "x"))
    assert "Exchange hashpartitioning(tahun" in s and "hashpartitioning(tahun#0, x" not in s
    assert not re.search(r"hashpartitioning\([^)]*x#", s)

