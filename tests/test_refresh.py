"""Loads that write only what a change reaches, against full ones."""
import dataclasses
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from panelmart.operators import refresh, star
from panelmart.plans import pipeline
from panelmart.sources import driver_tables

SF = "/root/testdata/sf0.001"
AT = dt.datetime(2024, 1, 1)


def load(spark, root, raw, cfg=None, **kw):
    return pipeline.run(spark, raw, cfg or driver_tables.nation_config(), root, run_at=AT, **kw)


def facts(spark, root):
    fact = star.read_published(spark, root, "fact_panel")
    return sorted(map(tuple, fact.select(*sorted(fact.columns)).collect()), key=str)


def warmer(raw, year):
    """The sources with other rainfall and temperature in one year."""
    there = F.col("Year") == year
    env = raw.environment.withColumns({"Rainfall_Annual": F.when(there, F.col("Rainfall_Annual") * 3 + 1).otherwise(F.col("Rainfall_Annual")),
                                       "LST_Celsius": F.when(there, -F.col("LST_Celsius")).otherwise(F.col("LST_Celsius"))})
    return dataclasses.replace(raw, environment=env)


def files(root, run):
    base = f"{star.run_folder(root, run)}/fact_panel"
    return sorted(d for d in os.listdir(base) if d.startswith("tahun="))


def test_only_what_a_change_reaches_is_written(spark, tmp_root):
    raw = driver_tables.landed_sources(spark, SF, "nation")
    root, other = f"{tmp_root}/a", f"{tmp_root}/b"
    first = load(spark, root, raw)
    before = facts(spark, root)

    same = load(spark, root, raw, incremental=True)
    assert same["rewritten"] == [] and facts(spark, root) == before and files(root, same["run_id"]) == []

    late = warmer(raw, 1999)
    second = load(spark, root, late, incremental=True)
    assert second["rewritten"] == [1999, 2000]
    assert files(root, second["run_id"]) == ["tahun=1999", "tahun=2000"]
    load(spark, other, late)
    drop_ids = lambda rows: rows  # noqa: E731  both number the same keys in the same order
    assert drop_ids(facts(spark, root)) == facts(spark, other) != before
    assert star.holders(spark, root, second["run_id"]) == {
        **dict.fromkeys((1996, 1997, 1998), first["run_id"]), 1999: second["run_id"], 2000: second["run_id"]}
    log = {r["run_id"]: r["fact_rows"] for r in spark.read.parquet(f"{root}/pipeline_runs").collect()}
    assert log[second["run_id"]] == log[first["run_id"]] == len(before)
    # a run that holds a part of the newest fact stays
    assert star.expire(spark, root, keep=1, grace_hours=0) == [same["run_id"]]
    assert facts(spark, root) == facts(spark, other)


def test_rates_and_settings_reach_everything(spark, tmp_root):
    raw = driver_tables.landed_sources(spark, SF, "nation")
    assert load(spark, tmp_root, raw, incremental=True)["rewritten"] is None  # no version before
    more = dataclasses.replace(raw, health=raw.health.withColumn("jumlah_kasusDBD", F.when(
        F.col("tahun") == 1997, F.col("jumlah_kasusDBD") + 1).otherwise(F.col("jumlah_kasusDBD")).cast("int")))
    assert load(spark, tmp_root, more, incremental=True)["rewritten"] is None
    cfg = driver_tables.nation_config(growth_pad=False)
    assert load(spark, tmp_root, more, cfg, incremental=True)["rewritten"] is None
    assert load(spark, tmp_root, more, cfg, incremental=True)["rewritten"] == []


def test_digests_know_rows_not_their_order(spark):
    rows = [(1, "a", 2019), (2, None, 2019), (2, None, 2019), (3, "c", None)]
    make = lambda r: {"t": spark.createDataFrame(r, "v int, s string, tahun int").repartition(3)}
    one, two = refresh.digests(make(rows), "tahun"), refresh.digests(make(rows[::-1]), "tahun")
    assert refresh.changed(one, two) == []
    assert refresh.changed(one, refresh.digests(make(rows[:2] + rows[3:]), "tahun")) == [("t", 2019)]
    assert refresh.changed(one, refresh.digests(make([*rows, (9, "z", 2021)]), "tahun")) == [("t", 2021)]
    assert refresh.changed(one, refresh.digests(make(rows[:3]), "tahun")) == [("t", None)]
    assert refresh.changed(refresh.digests(make([]), "tahun"), one) == [("t", None), ("t", 2019)]


def test_lags_reach_by_rows(spark):
    """An entity with gaps is reached in later years than one without."""
    cfg = driver_tables.nation_config()
    grain = spark.createDataFrame([("1", y) for y in range(1990, 2000)] + [("2", y) for y in (1991, 1995, 1998)], "kode_bps string, tahun int")
    assert refresh.reached([("stg_environment", 1991)], grain, cfg) == [1991, 1992, 1993, 1994, 1995, 1998]
    assert refresh.reached([("stg_geo", None)], grain, cfg) == []
    assert refresh.reached([("stg_demography", 1991)], grain, cfg) is None
