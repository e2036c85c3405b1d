"""End-to-end batch run, publish switch, run log, checks and report order."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelmart.operators import checks, reports, star
from panelmart.plans import pipeline
from panelmart.sources import driver_tables
from tests.helpers import cfg

SF = "/root/testdata/sf0.001"


def test_pipeline_run_publish_and_runlog(spark, tmp_root):
    raw = driver_tables.sources(spark, SF, "nation")
    c = driver_tables.nation_config()
    r1 = pipeline.run(spark, raw, c, tmp_root, run_at=dt.datetime(2024, 1, 1))
    assert r1["status"].startswith("valid|")
    assert r1["checks"].where(~F.col("passed")).count() == 0
    fact = star.read_published(spark, tmp_root, "fact_panel")
    health_rows = star.read_published(spark, tmp_root, "staging/stg_health").count()
    assert fact.count() == health_rows  # the panel keeps the health grain
    assert fact.select("fact_id").distinct().count() == health_rows
    r2 = pipeline.run(spark, raw, c, tmp_root, run_at=dt.datetime(2024, 2, 1))
    assert star.latest_run_id(spark, tmp_root) == r2["run_id"] != r1["run_id"]
    runs = spark.read.parquet(f"{tmp_root}/pipeline_runs")
    assert runs.count() == 2
    rep = reports.run_quality_report(runs).collect()
    assert [r["run_date"] for r in rep] == [dt.date(2024, 2, 1), dt.date(2024, 1, 1)]
    assert rep[0]["year_range"] == "1996–2000" and rep[0]["status"] == "SUCCESS"
    assert rep[0]["expected_rows"] == 125 and rep[0]["row_gap"] == rep[0]["fact_rows"] - 125


def test_checks_collect_all_failures(spark):
    c = cfg(expected_entities=3)
    h = spark.createDataFrame([("1", 2019), ("1", 2019), (None, 2020), ("9", 2019)],
                              "kode_bps string, tahun int")
    g = spark.createDataFrame([("1",), ("2",)], "kode_bps string")
    stg = {"stg_health": h, "stg_demography": h, "stg_environment": h, "stg_geo": g}
    res = checks.run_checks(stg, c)
    failed = {(r["check"], r["table"]) for r in res.where(~F.col("passed")).collect()}
    assert ("duplicate_keys", "stg_health") in failed and ("null_keys", "stg_environment") in failed
    assert ("entity_count", "stg_geo") in failed and ("orphan_codes", "stg_health") in failed
    assert ("min_rows", "stg_health") in failed  # 4 < int(2 * 6 * 0.8) = 9
    with pytest.raises(ValueError, match="checks not met"):
        checks.enforce(res)
    orphan = {r["kode_bps"] for r in checks.orphan_codes(h, g, "kode_bps").collect()}
    assert orphan == {"9", None}


def test_report_null_ordering_o2_o3(spark):
    c = cfg()
    fact = spark.createDataFrame(
        [("1", 2019, 1, 10.0, None, 2.0, 5.0), ("2", 2019, 2, 20.0, 60.0, 2.0, None),
         ("3", 2019, 3, None, 10.0, 0.5, 1.0)],
        "kode_bps string, tahun int, jumlah_kasus_dbd int, incidence_rate double, "
        "yoy_growth_rate double, rainfall_zscore double, composite_vulnerability_index double")
    dim = spark.createDataFrame([("1", "A", 0.0, 0.0), ("2", "B", 1.0, 1.0), ("3", "C", None, None)],
                                "kode_bps string, nama_kabupaten_kota string, latitude double, "
                                "longitude double")
    s = reports.surge_trend(fact, dim, c).collect()
    assert [r["nama_kabupaten_kota"] for r in s] == ["B", "C", "A"]  # NULL growth last
    assert s[0]["surge_flag"] == "HIGH RISK" and s[2]["surge_flag"] == "Normal"
    v = reports.vulnerability_map(fact, dim, c).collect()
    assert [r["nama_kabupaten_kota"] for r in v] == ["B", "A", "C"]  # NULL avg first
    p = reports.latest_pin_map(fact, dim, c).collect()
    assert [r["nama_kabupaten_kota"] for r in p] == ["C", "B", "A"]  # NULL incidence first
    assert reports.orphan_facts(fact, dim.where("kode_bps <> '3'"), c).first()[0] == 1


def test_dim_region_takes_earliest_period_d1(spark):
    c = cfg()
    p = spark.createDataFrame(
        [("1", "New name", 2021, 9.0, 9.0), ("1", "Old name", 2019, 1.0, 2.0), ("2", "B", 2020, None, None)],
        "kode_bps string, nama_kabupaten_kota string, tahun int, latitude double, longitude double")
    got = {r["kode_bps"]: tuple(r) for r in star.dim_region(p, c).collect()}
    assert got["1"] == ("1", "Old name", "32", "JAWA BARAT", 1.0, 2.0)
    assert got["2"][4] is None
    per = {r["tahun"]: (r["covid_dummy"], r["keterangan_periode"])
           for r in star.dim_period(p, cfg(event_periods=(2020, 2021))).collect()}
    assert per == {2019: (0, "Normal"), 2020: (1, "Pandemi"), 2021: (1, "Pandemi")}


def test_create_tables_if_absent_k4(spark, tmp_root):
    star.ensure_tables(spark, "pm_test_wh", f"{tmp_root}/wh")
    star.ensure_tables(spark, "pm_test_wh", f"{tmp_root}/wh")  # idempotent
    cols = [f.name for f in spark.table("pm_test_wh.fact_panel").schema.fields]
    assert cols[0] == "fact_id" and "endemic_persistence_score" in cols
    assert spark.table("pm_test_wh.pipeline_runs").count() == 0
