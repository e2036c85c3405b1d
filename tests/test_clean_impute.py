"""Staging rules (dedup, names, codes) and donor imputation."""
from panelmart.operators import clean, panel
from tests.helpers import by_key, cfg, panel_df


def test_dedup_keep_first_t5(spark):
    rows = [("A", 2019, 3, 30.0), ("A", 2019, 1, 10.0), ("B", 2019, 2, None), ("A", 2019, 2, 20.0),
            ("B", 2019, 1, 5.0)]
    df = spark.createDataFrame(rows, "k string, y int, ord int, v double").repartition(3)
    got = {(r["k"], r["y"]): (r["ord"], r["v"]) for r in
           clean.dedup_keep_first(df, ["k", "y"], ["ord"]).collect()}
    assert got == {("A", 2019): (1, 10.0), ("B", 2019): (1, 5.0)}
    # without an order the remaining columns decide (NULLs last): deterministic
    got2 = {(r["k"]): (r["ord"], r["v"]) for r in
            clean.dedup_keep_first(df.drop("y"), ["k"]).collect()}
    assert got2 == {"A": (1, 10.0), "B": (1, 5.0)}


def test_dedup_hot_key_keeps_all_other_keys(spark):
    hot = [("H", i, float(i)) for i in range(3000)]
    rest = [(f"k{i}", 0, float(i)) for i in range(1000)]
    df = spark.createDataFrame(hot + rest, "k string, ord int, v double").repartition(8)
    out = clean.dedup_keep_first(df, ["k"], ["ord"])
    got = {r["k"]: r["v"] for r in out.collect()}
    assert len(got) == 1001 and got["H"] == 0.0


def test_map_names_nulls_and_fanout_t7_t8(spark):
    env = spark.createDataFrame([("Bandung", 2019), (None, 2019), ("Nowhere", 2019)],
                                "nama_env string, tahun int")
    mapping = spark.createDataFrame([("3204", "Bandung"), ("3217", "Bandung"), ("9999", None)],
                                    "kode_bps string, nama_env string")
    got = sorted(((r["nama_env"] or ""), (r["kode_bps"] or "")) for r in
                 clean.map_names(env, mapping, "nama_env", "kode_bps").collect())
    assert got == [("", ""), ("Bandung", "3204"), ("Bandung", "3217"), ("Nowhere", "")]
    un = sorted((r["nama_env"] or "") for r in
                clean.unmatched_names(env, mapping, "nama_env").collect())
    assert un == ["", "Nowhere"]


def test_stage_environment_lowercases_and_maps(spark):
    raw = spark.createDataFrame([("Bandung", 2019, 1.0, 2.0, 0.3, 0.1)],
                                "ADM2_NAME string, Year int, Rainfall_Annual double, LST_Celsius double, "
                                "NDVI double, NDMI double")
    mapping = spark.createDataFrame([(3204, "Bandung")], "kode_bps int, nama_env string")
    out = clean.stage_environment(raw, mapping, cfg()).collect()
    assert [tuple(r) for r in out] == [("3204", 2019, 1.0, 2.0, 0.3, 0.1)]


def test_stage_health_filters_years_and_normalizes(spark):
    raw = spark.createDataFrame([(3204.0, "A", 2018, 1), (3204.0, "A", 2019, 2), (None, "B", 2019, 3)],
                                "kode_bps double, nama_kabupaten_kota string, tahun int, jumlah_kasusDBD int")
    got = sorted((r["kode_bps"] or "", r["tahun"], r["jumlah_kasus_dbd"]) for r in
                 clean.stage_health(raw, cfg()).collect())
    assert got == [("", 2019, 3), ("3204", 2019, 2)]


def _imputation_panel(spark):
    return panel_df(spark, [
        # donor 3204 has everything
        dict(kode_bps="3204", tahun=2019, rainfall_annual=10.0, lst_celsius=20.0, ndvi=0.5, ndmi=0.1),
        # target 3217: rain present, ndvi missing -> filled, flag stays false
        dict(kode_bps="3217", tahun=2019, rainfall_annual=5.0, lst_celsius=21.0, ndvi=None, ndmi=0.2),
        # target 3217 in a year without donor row: rain missing -> flagged
        dict(kode_bps="3217", tahun=2020, rainfall_annual=None, lst_celsius=None, ndvi=None, ndmi=None),
        # non-target with rain but no ndvi: stays null, flag corrected to true
        dict(kode_bps="3299", tahun=2019, rainfall_annual=7.0, lst_celsius=22.0, ndvi=None, ndmi=0.3),
    ])


def test_donor_imputation_and_flag(spark):
    c = cfg(donors=(("3217", "3204"),))
    out = panel.impute_from_donor(_imputation_panel(spark), c)
    got = by_key(out, "ndvi", "rainfall_annual", "is_imputed")
    assert got[("3217", 2019)] == (0.5, 5.0, False)
    assert got[("3217", 2020)] == (None, None, True)
    assert got[("3299", 2019)] == (None, 7.0, True)
    assert got[("3204", 2019)] == (0.5, 10.0, False)


def test_imputation_leaks_report(spark):
    c = cfg(donors=(("3217", "3204"),))
    leaks = panel.imputation_leaks(_imputation_panel(spark), c).collect()
    assert [(r["kode_bps"], r["tahun"]) for r in leaks] == [("3299", 2019)]


def test_dedup_matches_pandas_keep_first(spark):
    import random

    import pandas as pd
    rnd = random.Random(5)
    rows = []
    for i in range(600):
        k = "hot" if rnd.random() < 0.35 else f"k{rnd.randint(0, 60)}"
        o1 = None if rnd.random() < 0.1 else rnd.randint(0, 20)
        rows.append((k, rnd.randint(2019, 2021), o1, rnd.random(), i))
    df = spark.createDataFrame(rows, "k string, y int, o1 int, v double, i int").repartition(7)
    got = {(r["k"], r["y"]): r["i"] for r in
           clean.dedup_keep_first(df, ["k", "y"], ["o1", "i"]).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "y", "o1", "v", "i"])
    exp = (pdf.sort_values(["o1", "i"], na_position="last", kind="stable")
           .drop_duplicates(["k", "y"], keep="first"))
    assert got == {(r.k, r.y): r.i for r in exp.itertuples()}


def test_names_mapped_to_no_code_are_reported(spark):
    env = spark.createDataFrame([("Bandung",), ("Cimahi",)], "nama_env string")
    mapping = spark.createDataFrame([("3204", "Bandung"), ("nan", "Cimahi")], "kode_bps string, nama_env string")
    assert [r[0] for r in clean.unmatched_names(env, mapping, "nama_env").collect()] == ["Cimahi"]


def test_first_area_row_of_the_files_is_kept(spark):
    order = "struct<file:string,block:bigint,row:bigint>"
    d = spark.createDataFrame([("1", 2019, 5.0, ("d", 0, 0))],
                              f"kode_bps string, tahun int, kepadatan_penduduk double, _input_order {order}")
    for rows in ([300.0, 100.0], [100.0, 300.0]):
        a = spark.createDataFrame([("1", 2019, x, ("a", 0, i)) for i, x in enumerate(rows)],
                                  f"kode_bps string, tahun int, luas_km2 double, _input_order {order}")
        for n in (1, 4):
            out = clean.stage_demography(d, a.repartition(n), cfg())
            assert out.columns == ["kode_bps", "tahun", "kepadatan_penduduk", "luas_km2"]
            assert out.first()["luas_km2"] == rows[0]
