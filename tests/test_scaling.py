"""Work per row and per task where tables grow."""
import glob
import os
import uuid

import pytest

from panelmart.operators import clean, spatial
from panelmart.session import shared_dir
from panelmart.sources import driver_tables as dt
from tests.helpers import cfg


def tables(spark, customers, orders=(), items=()):
    """Small driver tables of the given rows in a fresh folder."""
    d = shared_dir(spark, f"scaling/{uuid.uuid4().hex}")
    for name, rows, schema in (
            ("customer", customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double"),
            ("orders", orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp"),
            ("lineitem", items, "l_orderkey long, l_quantity double, l_extendedprice double, l_discount double, "
                                "l_tax double, l_shipdate timestamp")):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return d


CUSTOMERS = [(i, f"c{i}", i % 25, i * 10.0) for i in range(2000)]


def test_only_the_sources_read_are_landed(spark):
    raw = dt.landed_sources(spark, tables(spark, CUSTOMERS), "customer")
    assert raw.features.count() == len(CUSTOMERS)
    folder = os.path.dirname(raw.features.inputFiles()[0].removeprefix("file://"))
    assert sorted(os.listdir(os.path.dirname(folder))) == ["features"]
    assert raw.mapping.count() == len(CUSTOMERS) and raw.features is raw.features
    with pytest.raises(AttributeError):
        raw.others


def test_features_of_a_single_row_group_are_dealt_over_tasks(spark):
    size = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(size, "1k")
    try:
        raw = dt.landed_sources(spark, tables(spark, CUSTOMERS), "customer")
        folder = os.path.dirname(raw.features.inputFiles()[0].removeprefix("file://"))
        assert len(glob.glob(f"{folder}/part-*.parquet")) > 1
    finally:
        spark.conf.unset(size)


def test_each_segment_is_measured_once(spark):
    """The sums over a path's points share one expression per segment."""
    d = spark.createDataFrame([(("1", "a"), ("Polygon", "[[[0,0],[1,0],[1,1],[0,0]]]"))],
                              "properties struct<ID_KAB:string,KABKOT:string>, geometry struct<type:string,coordinates:string>")
    plan = spatial.centroids(d)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("HYPOT(") == 1 and plan.count("from_json(") == 6  # one per type


def test_sums_of_odd_paths(spark):
    rows = [("Polygon", "[[[3,4]]]", (3.0, 4.0)), ("Polygon", "[[]]", None),
            ("LineString", "[[1,1],[3,1],[3,5]]", (2 + 4 / 6, 1 + 8 / 6)), ("LineString", "[[2,7]]", (2.0, 7.0)),
            ("Polygon", "[[[9,9],[9,10],[10,10],[10,9],[9,9]]]", (9.5, 9.5)),
            ("MultiPolygon", "[[[[0,0],[4,0],[4,4],[0,4],[0,0]],[[1,1],[2,1],[2,2],[1,2],[1,1]]]]", (30.5 / 15, 30.5 / 15))]
    d = spark.createDataFrame([((str(i), "a"), (t, c)) for i, (t, c, _) in enumerate(rows)],
                              "properties struct<ID_KAB:string,KABKOT:string>, geometry struct<type:string,coordinates:string>")
    for r in spatial.centroids(d).collect():
        want = rows[int(r["kode_bps"])][2]
        got = None if r["longitude"] is None else (r["longitude"], r["latitude"])
        assert got == (want and pytest.approx(want))


def test_rows_of_a_name_are_one_before_its_codes(spark, monkeypatch):
    """Where many codes share a name, rows and codes are not multiplied."""
    rows = [("A", 2019 + i % 2, 50.0 - i // 2 if i > 3 else float("nan"), 1.0, 0.5, 0.1) for i in range(60)]
    raw = spark.createDataFrame([*rows, (None, 2019, 1.0, 1.0, 1.0, 1.0)],
                                "ADM2_NAME string, Year int, Rainfall_Annual double, LST_Celsius double, NDVI double, NDMI double")
    mapping = spark.createDataFrame([(i, "A") for i in range(40)], "kode_bps int, nama_env string")
    joined, real = [], clean.map_names

    def spy(df, *a):
        out = real(df, *a)
        joined.append(out.count())
        return out

    monkeypatch.setattr(clean, "map_names", spy)
    got = clean.stage_environment(raw, mapping, cfg()).collect()
    assert joined == [2 * 40 + 1]
    assert sorted((int(r["kode_bps"]), r["tahun"], r["rainfall_annual"]) for r in got) == [
        (i, y, 21.0) for i in range(40) for y in (2019, 2020)]
    # the files' order decides where it is recorded
    from panelmart.sources.readers import INPUT_ORDER
    ordered = raw.coalesce(1).selectExpr("*", f"-Rainfall_Annual AS {INPUT_ORDER}").where("Rainfall_Annual > 0")
    got = clean.stage_environment(ordered, mapping, cfg()).collect()
    assert {(r["tahun"], r["rainfall_annual"]) for r in got} == {(2019, 48.0), (2020, 48.0)} and len(got) == 80


def test_groups_are_counted_in_one_pass(spark, monkeypatch):
    from panelmart.operators import selection
    from panelmart.operators.quantiles import BinSpec
    df = spark.range(30).selectExpr("cast(id % 2 as int) g", "cast(id as double) x")
    seen, real = [], selection.count_groups

    class Once:
        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            if name in ("count", "collect"):
                seen.append(name)
            got = getattr(self.inner, name)
            return (lambda *a: Once(got(*a))) if name == "limit" else got

    monkeypatch.setattr(selection, "count_groups", lambda values: Once(real(values)))
    edges = selection.edge_arrays_by_counting(df, [BinSpec("b", "x", "g", ("a", "b"))]).collect()
    assert seen == ["collect"] and sorted(r["_es"] for r in edges) == [[0.0, 14.0, 28.0], [1.0, 15.0, 29.0]]
