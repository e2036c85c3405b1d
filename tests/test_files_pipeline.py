"""The batch job on hand-written files in the source systems' layout."""
import json
import os

import pytest
from pyspark.sql import functions as F

from panelmart.config import PanelConfig
from panelmart.operators import reports, star
from panelmart.plans import pipeline
from panelmart.sources.files import raw_from_files


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def _square(x, y):
    return [[[x, y], [x + 1, y], [x + 1, y + 1], [x, y + 1], [x, y]]]


@pytest.fixture
def files(tmp_root):
    d = tmp_root
    health = _write(os.path.join(d, "health.csv"),
                    "kode_bps,nama_kabupaten_kota,tahun,jumlah_kasusDBD\n"
                    "3204,KAB A,2019,10\n3204,KAB A,2020,30\n3207,KAB B,2019,5\n3207,KAB B,2020,5\n"
                    "3217,KAB C,2019,8\n3217,KAB C,2020,2\n3204,KAB A,2018,99\n3204,KAB A,2019,11\n")
    density = _write(os.path.join(d, "density.csv"),
                     "kode_bps,tahun,kepadatan_penduduk\n3204,2019,100\n3204,2020,100\n"
                     "3207,2019,200\n3207,2020,200\n3217,2019,300\n3217,2020,300\n")
    area = _write(os.path.join(d, "area.csv"),
                  "kode_bps,tahun,luas_km2\n3204,2019,10\n3204,2020,10\n3207,2019,10\n3207,2020,10\n"
                  "3217,2019,10\n3217,2020,10\n")
    env = _write(os.path.join(d, "env.csv"),
                 "ADM2_NAME,Year,Rainfall_Annual,LST_Celsius,NDVI,NDMI\n"
                 "Kab A,2019,100,25,0.3,0.1\nKab A,2020,120,26,0.5,0.2\n"
                 "Kab B,2019,90,24,0.7,0.3\nKab B,2020,80,23,0.65,0.35\n"
                 "Nowhere,2019,1,1,0.1,0.1\n")
    mapping = _write(os.path.join(d, "region_mapping.csv"),
                     "kode_bps,nama_env\n3204,Kab A\n3207,Kab B\n")
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"ID_KAB": float(c), "KABKOT": n},
         "geometry": {"type": "Polygon", "coordinates": _square(i, 0)}}
        for i, (c, n) in enumerate([(3204, "KAB A"), (3207, "KAB B"), (3217, "KAB C")])]}
    geo = _write(os.path.join(d, "regions.geojson"), json.dumps(fc, indent=1))
    return dict(health=health, density=density, area=area, environment=env, mapping=mapping,
                geojson=geo)


def test_pipeline_on_source_files(spark, files, tmp_root):
    raw = raw_from_files(spark, **files)
    cfg = PanelConfig(year_start=2019, year_end=2020, event_periods=(2020,),
                      donors=(("3217", "3204"),), expected_entities=3,
                      on_duplicate_edges="null")
    root = os.path.join(tmp_root, "wh")
    out = pipeline.run(spark, raw, cfg, root)
    assert out["checks"].where(~F.col("passed")).count() == 0
    fact = {(r["kode_bps"], r["tahun"]): r for r in
            star.read_published(spark, root, "fact_panel").collect()}
    assert len(fact) == 6  # 2018 filtered, duplicate 2019 row kept first
    a19 = fact[("3204", 2019)]
    assert a19["jumlah_kasus_dbd"] == 10
    assert a19["incidence_rate"] == pytest.approx(10 / (100 * 10) * 100000)
    # 3217 has no environment rows: filled from donor 3204, flagged imputed
    c20 = fact[("3217", 2020)]
    assert c20["rainfall_mm"] == 120.0 and c20["ndvi"] == 0.5 and c20["is_imputed"] is True
    assert fact[("3204", 2020)]["yoy_growth_rate"] == pytest.approx(200.0)
    dims = {r["kode_bps"]: r for r in star.read_published(spark, root, "dim_region").collect()}
    assert dims["3207"]["longitude"] == pytest.approx(1.5)
    per = {r["tahun"]: r["keterangan_periode"] for r in
           star.read_published(spark, root, "dim_period").collect()}
    assert per == {2019: "Normal", 2020: "Pandemi"}
    runs = spark.read.parquet(os.path.join(root, "pipeline_runs"))
    rec = runs.first()
    assert (rec["fact_rows"], rec["n_regions"], rec["n_years"], rec["imputed_rows"]) == (6, 3, 2, 2)
    q = reports.run_quality_report(runs).first()
    assert q["expected_rows"] == 6 and q["row_gap"] == 0 and q["pct_imputed"] == pytest.approx(33.3)


def test_command_line_and_published_reports(spark, files, tmp_root, capsys):
    from panelmart.__main__ import main
    root = os.path.join(tmp_root, "wh-cli")
    args = ["--root", root, "--year-start", "2019", "--year-end", "2020", "--events", "2020",
            "--donors", "3217:3204", "--expected-entities", "3", "--on-duplicate-edges", "null",
            "--report", "latest_pin_map"]
    for k, v in files.items():
        args += [f"--{k}", v]
    main(args)
    out = capsys.readouterr().out
    assert "valid|" in out and "== latest_pin_map" in out
    assert "loaded|regions=3|periods=2|fact=6|imputed=2|null_ir=0" in out
    from panelmart.plans.reporting import published_reports
    reps = published_reports(spark, root, PanelConfig(year_start=2019, year_end=2020))
    counts = {r["tabel"]: r["rows"] for r in reps["table_row_counts"].collect()}
    assert counts["fact_panel"] == 6 and counts["dim_region"] == 3
    assert reps["orphan_facts"].first()[0] == 0
