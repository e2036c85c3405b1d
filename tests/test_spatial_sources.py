"""Centroids (G1/G2) and the file sources / sinks."""
import json
import os

import pytest
from pyspark.sql import functions as F

from panelmart.operators import spatial
from panelmart.schemas import RAW_ENVIRONMENT
from panelmart.sources import readers

SQUARE_WITH_HOLE = [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]],
                    [[1, 1], [1, 2], [2, 2], [2, 1], [1, 1]]]
SECOND = [[[10, 0], [12, 0], [12, 2], [10, 2], [10, 0]]]


def _features(spark, feats):
    rows = [({"ID_KAB": str(k), "KABKOT": n}, {"type": t, "coordinates": json.dumps(c)})
            for k, n, t, c in feats]
    return spark.createDataFrame(rows, "properties struct<ID_KAB:string,KABKOT:string>, "
                                       "geometry struct<type:string,coordinates:string>")


def test_centroid_multipolygon_with_hole_g1(spark):
    df = _features(spark, [(3204.0, "A", "MultiPolygon", [SQUARE_WITH_HOLE, SECOND])])
    r = spatial.centroids(df).first()
    assert r["kode_bps"] == "3204" and r["nama_geo"] == "A"
    assert r["longitude"] == pytest.approx(74.5 / 19) and r["latitude"] == pytest.approx(34.5 / 19)


def test_centroid_winding_does_not_matter(spark):
    cw_shell = [list(reversed(SQUARE_WITH_HOLE[0])), list(reversed(SQUARE_WITH_HOLE[1]))]
    a = spatial.centroids(_features(spark, [(1.0, "a", "Polygon", SQUARE_WITH_HOLE)])).first()
    b = spatial.centroids(_features(spark, [(1.0, "b", "Polygon", cw_shell)])).first()
    assert a["latitude"] == pytest.approx(b["latitude"]) and a["longitude"] == pytest.approx(b["longitude"])
    exp = (16 * 2 - 1 * 1.5) / 15
    assert a["longitude"] == pytest.approx(exp)


def test_read_geojson_collection_and_per_line(spark, tmp_root):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"ID_KAB": 3204, "KABKOT": "A"},
         "geometry": {"type": "Polygon", "coordinates": SQUARE_WITH_HOLE}},
        {"type": "Feature", "properties": {"ID_KAB": 3205.0, "KABKOT": "B"},
         "geometry": {"type": "MultiPolygon", "coordinates": [SQUARE_WITH_HOLE, SECOND]}}]}
    p = os.path.join(tmp_root, "regions.geojson")
    with open(p, "w") as f:
        f.write(json.dumps(fc, indent=2))
    got = {r["kode_bps"]: (r["latitude"], r["longitude"]) for r in
           spatial.centroids(readers.read_geojson(spark, p)).collect()}
    assert set(got) == {"3204", "3205"}
    assert got["3205"][1] == pytest.approx(74.5 / 19)
    lines = os.path.join(tmp_root, "lines.json")
    with open(lines, "w") as f:
        for feat in fc["features"]:
            f.write(json.dumps(feat) + "\n")
    got2 = {r["kode_bps"]: (r["latitude"], r["longitude"]) for r in
            spatial.centroids(readers.read_geojson(spark, lines, per_line=True)).collect()}
    assert got2.keys() == got.keys()
    for k in got:
        assert got2[k] == pytest.approx(got[k])


def test_read_csv_mixed_case_headers(spark, tmp_root):
    p = os.path.join(tmp_root, "env.csv")
    with open(p, "w") as f:
        f.write("ADM2_NAME,Year,Rainfall_Annual,LST_Celsius,NDVI,NDMI,extra\n")
        f.write("Bandung,2019,100.5,25.1,0.4,0.1,x\n")
        f.write("Bogor,2020,nan,,0.7,bad,y\n")
    df = readers.read_csv(spark, p, RAW_ENVIRONMENT, lowercase=True)
    assert df.columns == [f.name for f in RAW_ENVIRONMENT.fields] + [readers.INPUT_ORDER]
    rows = {r["adm2_name"]: r for r in df.collect()}
    assert rows["Bandung"]["rainfall_annual"] == 100.5 and rows["Bandung"]["year"] == 2019
    assert rows["Bogor"]["rainfall_annual"] is None  # 'nan' -> NULL, never NaN
    assert rows["Bogor"]["lst_celsius"] is None and rows["Bogor"]["ndmi"] is None


def test_lowercase_collision_rejected(spark):
    df = spark.createDataFrame([(1, 2)], "A int, a2 int").toDF("A", "a")
    with pytest.raises(ValueError):
        readers.lowercase_columns(df)


def test_csv_and_parquet_sinks_roundtrip(spark, tmp_root):
    df = spark.range(5).withColumn("v", F.col("id") * 2.0)
    readers.write_table(df, os.path.join(tmp_root, "t"), partition_by=["id"])
    back = spark.read.parquet(os.path.join(tmp_root, "t"))
    assert sorted(r["v"] for r in back.collect()) == [0.0, 2.0, 4.0, 6.0, 8.0]
    readers.write_csv(df, os.path.join(tmp_root, "c"))
    assert spark.read.option("header", True).csv(os.path.join(tmp_root, "c")).count() == 5


def test_centroid_random_polygons_vs_numpy(spark):
    """Random multi-part polygons with holes and random winding, against an
    independent numpy computation (triangle fan per ring)."""
    import random

    import numpy as np
    rnd = random.Random(9)

    def ring(cx, cy, r, k, cw):
        ang = sorted(rnd.uniform(0, 2 * np.pi) for _ in range(k))
        pts = [[cx + r * np.cos(a), cy + r * np.sin(a)] for a in ang]
        if cw:
            pts = pts[::-1]
        return pts + [pts[0]]

    def fan(pts):
        p = np.array(pts[:-1])
        a = 0.0
        mx = np.zeros(2)
        for i in range(1, len(p) - 1):
            t = (p[i][0] - p[0][0]) * (p[i + 1][1] - p[0][1]) - (p[i + 1][0] - p[0][0]) * (p[i][1] - p[0][1])
            a += t / 2
            mx += t / 2 * (p[0] + p[i] + p[i + 1]) / 3
        return abs(a), mx * np.sign(a)

    feats, exp = [], {}
    for f in range(30):
        parts, tot_a, tot_m = [], 0.0, np.zeros(2)
        for _ in range(rnd.randint(1, 3)):
            cx, cy = rnd.uniform(-50, 50), rnd.uniform(-50, 50)
            shell = ring(cx, cy, rnd.uniform(5, 10), rnd.randint(3, 9), rnd.random() < 0.5)
            hole = ring(cx, cy, rnd.uniform(0.5, 2), rnd.randint(3, 6), rnd.random() < 0.5)
            rings = [shell] + ([hole] if rnd.random() < 0.6 else [])
            for ri, rg in enumerate(rings):
                a, m = fan(rg)
                s = 1.0 if ri == 0 else -1.0
                tot_a += s * a
                tot_m += s * m
            parts.append(rings)
        exp[str(f)] = (tot_m[1] / tot_a, tot_m[0] / tot_a)
        feats.append((float(f), str(f), "MultiPolygon", parts))
    got = {r["kode_bps"]: (r["latitude"], r["longitude"])
           for r in spatial.centroids(_features(spark, feats)).collect()}
    for k, (lat, lon) in exp.items():
        assert got[k][0] == pytest.approx(lat, rel=1e-9, abs=1e-9)
        assert got[k][1] == pytest.approx(lon, rel=1e-9, abs=1e-9)


def test_keep_first_in_file_order_t5(spark, tmp_root):
    from panelmart.config import PanelConfig
    from panelmart.operators import clean
    from panelmart.schemas import RAW_HEALTH
    p = os.path.join(tmp_root, "health.csv")
    with open(p, "w") as f:
        f.write("kode_bps,nama_kabupaten_kota,tahun,jumlah_kasusDBD\n")
        f.write("3204,A,2019,30\n3207,B,2019,7\n3204,A,2019,10\n3204,A,2019,20\n")
    raw = readers.read_csv(spark, p, RAW_HEALTH)
    got = {(r["kode_bps"], r["tahun"]): r["jumlah_kasus_dbd"] for r in
           clean.stage_health(raw, PanelConfig(year_start=2019, year_end=2019)).collect()}
    assert got == {("3204", 2019): 30, ("3207", 2019): 7}  # first as the file lists it
    # without the recorded order the remaining columns decide (deterministic)
    raw2 = readers.read_csv(spark, p, RAW_HEALTH, keep_input_order=False)
    got2 = {(r["kode_bps"], r["tahun"]): r["jumlah_kasus_dbd"] for r in
            clean.stage_health(raw2, PanelConfig(year_start=2019, year_end=2019)).collect()}
    assert got2[("3204", 2019)] == 10


def test_read_parquet_conforms_types(spark, tmp_root):
    from panelmart.schemas import RAW_DENSITY
    p = os.path.join(tmp_root, "density.parquet")
    spark.createDataFrame([(3204, "2019", float("nan")), (3207, "x", 5.0)],
                          "kode_bps int, tahun string, kepadatan_penduduk double").write.parquet(p)
    rows = {r["kode_bps"]: r for r in readers.read_parquet(spark, p, RAW_DENSITY).collect()}
    assert rows["3204"]["tahun"] == 2019 and rows["3204"]["kepadatan_penduduk"] is None
    assert rows["3207"]["tahun"] is None and rows["3207"]["kepadatan_penduduk"] == 5.0


def test_read_jdbc_argument_checks(spark):
    with pytest.raises(ValueError):
        readers.read_jdbc(spark, "jdbc:none", table="t", query="select 1")
    with pytest.raises(ValueError):
        readers.read_jdbc(spark, "jdbc:none")


def test_keep_first_across_files(spark, tmp_root):
    from panelmart.config import PanelConfig
    from panelmart.operators import clean
    from panelmart.schemas import RAW_HEALTH
    d = os.path.join(tmp_root, "health_parts")
    os.makedirs(d)
    head = "kode_bps,nama_kabupaten_kota,tahun,jumlah_kasusDBD\n"
    with open(os.path.join(d, "part-b.csv"), "w") as f:
        f.write(head + "3204,A,2019,1\n")
    with open(os.path.join(d, "part-a.csv"), "w") as f:
        f.write(head + "3204,A,2019,50\n3207,B,2019,2\n")
    raw = readers.read_csv(spark, d, RAW_HEALTH)
    got = {r["kode_bps"]: r["jumlah_kasus_dbd"] for r in
           clean.stage_health(raw, PanelConfig(year_start=2019, year_end=2019)).collect()}
    assert got == {"3204": 50, "3207": 2}  # files in name order, rows in file order
