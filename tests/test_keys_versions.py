"""Stable keys, one-pass checks, and publishes of more than one run."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelmart.operators import checks, keys, star
from panelmart.plans import pipeline
from panelmart.sources import driver_tables
from tests.helpers import cfg

SF = "/root/testdata/sf0.001"
ON = ["kode_bps", "tahun"]


def table(spark, rows):
    return spark.createDataFrame(rows, "kode_bps string, tahun int")


def ids(df):
    return {(r["kode_bps"], r["tahun"]): r["fact_id"] for r in df.collect()}


def test_keys_are_gapless_and_stay(spark):
    first = [("b", 1), ("a", 2), ("a", 1), ("a", 1), (None, 1), ("c", None)]
    one = keys.extend(table(spark, first), None, ON)
    got = ids(one)
    assert sorted(got.values()) == [1, 2, 3, 4, 5] and got["a", 1] < got["a", 2] < got["b", 1]
    two = ids(keys.extend(table(spark, [*first, ("0", 9), ("zz", 1), (None, 1), (None, None)]), one, ON))
    assert {k: two[k] for k in got} == got and sorted(two.values()) == list(range(1, 9))
    assert ids(keys.extend(table(spark, []), one, ON)) == got  # keys that are gone keep their numbers
    assert ids(keys.extend(table(spark, []), None, ON)) == {}


def test_many_keys_never_share_a_number(spark):
    grain = spark.range(30_000).selectExpr("concat('k', id % 5000) as kode_bps", "cast(id / 5000 as int) as tahun")
    numbered = keys.attach(grain, keys.extend(grain, None, ON), ON)
    low, high, n = numbered.agg(F.min("fact_id"), F.max("fact_id"), F.countDistinct("fact_id")).first()
    assert (low, high, n) == (1, 30_000, 30_000)
    assert numbered.columns == ["fact_id", *ON]


def test_number_in_order_over_partitions(spark):
    rows = spark.range(5000).selectExpr("(id * 7919) % 5000 as v")
    got = {r["v"]: r["n"] for r in keys.number(rows, ["v"], "n").collect()}
    assert got == {i: i for i in range(5000)}


def odd_staging(spark):
    h = table(spark, [("1", 2019), ("1", 2019), ("1", 2020), (None, 2020), (None, 2020), ("9", 2019), ("8", None), ("8", None)])
    d = table(spark, [])
    g = spark.createDataFrame([("1",), ("2",), (None,), ("2",)], "kode_bps string")
    return {"stg_health": h, "stg_demography": d, "stg_environment": h.where("tahun = 2019"), "stg_geo": g}


def test_one_pass_equals_the_single_checks(spark):
    for c in (cfg(expected_entities=3), cfg(expected_entities=None, min_row_fraction=0.0)):
        stg = odd_staging(spark)
        three = {t: stg[t] for t in ("stg_health", "stg_demography", "stg_environment")}
        parts = [checks.duplicate_keys(three, ON), checks.null_keys(three, "kode_bps"),
                 checks.min_rows(stg["stg_health"], stg["stg_geo"], c), checks.entity_count(stg["stg_geo"], c),
                 checks.orphans(stg["stg_health"], stg["stg_geo"], "kode_bps")]
        want = sorted(tuple(r) for p in parts for r in p.collect())
        assert sorted(tuple(r) for r in checks.run_checks(stg, c).collect()) == want
        one = checks.summarize(stg, c).first().asDict()
        assert checks.status_of(one, stg) == checks.status_line(stg)


def test_one_pass_reads_each_table_once(spark, tmp_root):
    for name, df in odd_staging(spark).items():
        df.write.parquet(f"{tmp_root}/{name}")
    stg = {n: spark.read.parquet(f"{tmp_root}/{n}") for n in odd_staging(spark)}
    plan = checks.run_checks(stg, cfg(expected_entities=3))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 4


def run(spark, root, **kw):
    raw = driver_tables.landed_sources(spark, SF, "nation")
    return pipeline.run(spark, raw, driver_tables.nation_config(), root, run_at=dt.datetime(2024, 1, 1), **kw)


def test_a_run_loses_to_one_that_came_first(spark, tmp_root, monkeypatch):
    """The second run begins and publishes while the first is at work."""
    second, real = {}, star.publish

    def interrupted(*args, **kw):
        if not second:
            second["id"] = None
            second["id"] = run(spark, tmp_root)["run_id"]
        return real(*args, **kw)

    monkeypatch.setattr(star, "publish", interrupted)
    with pytest.raises(star.PublishConflict):
        run(spark, tmp_root)
    assert star.versions(spark, tmp_root) == [(1, second["id"])]
    log = spark.read.parquet(f"{tmp_root}/pipeline_runs").collect()
    assert [r["run_id"] for r in log] == [second["id"]]
    assert star.read_published(spark, tmp_root, "fact_panel").count() == log[0]["fact_rows"]
    third = run(spark, tmp_root)
    assert star.versions(spark, tmp_root) == [(1, second["id"]), (2, third["run_id"])]
    first, now = (ids(spark.read.parquet(f"{star.run_folder(tmp_root, r)}/fact_panel")) for r in (second["id"], third["run_id"]))
    assert first == now and sorted(now.values()) == list(range(1, len(now) + 1))


def test_both_runs_reach_the_last_step(spark, tmp_root):
    assert star.commit(spark, tmp_root, 11, 0) == 1
    with pytest.raises(star.PublishConflict):
        star.commit(spark, tmp_root, 12, 0)
    assert star.commit(spark, tmp_root, 13, 1) == 2
    assert star.versions(spark, tmp_root) == [(1, 11), (2, 13)] and star.versions(spark, tmp_root, 1) == [(2, 13)]
    assert star.latest_run_id(spark, tmp_root) == 13


def test_same_version_cannot_be_taken_twice(spark, tmp_root, monkeypatch):
    star.commit(spark, tmp_root, 1, 0)
    monkeypatch.setattr(star, "current_version", lambda *a: 0)  # as if both had looked before
    with pytest.raises(star.PublishConflict):
        star.commit(spark, tmp_root, 2, 0)
    assert star.versions(spark, tmp_root) == [(1, 1)]


def test_old_runs_expire(spark, tmp_root):
    for v in range(4):
        star.publish(spark, tmp_root, {"t": spark.range(v + 1)}, run_id=100 + v, read=v)
    spark.range(1).write.parquet(f"{star.run_folder(tmp_root, 999)}/t")  # begun, never published
    assert star.expire(spark, tmp_root, keep=2) == []  # too young
    assert sorted(star.expire(spark, tmp_root, keep=2, grace_hours=0)) == [100, 101, 999]
    assert star.read_published(spark, tmp_root, "t").count() == 4
    assert spark.read.parquet(f"{star.run_folder(tmp_root, 102)}/t").count() == 3


def test_nothing_published(spark, tmp_root):
    assert star.versions(spark, tmp_root) == [] and star.current_version(spark, tmp_root) == 0
    with pytest.raises(FileNotFoundError):
        star.latest_run_id(spark, tmp_root)
