from panelmart.config import PanelConfig

PANEL_COLS = ("kode_bps string, nama_kabupaten_kota string, tahun int, jumlah_kasus_dbd int, "
              "kepadatan_penduduk double, luas_km2 double, rainfall_annual double, "
              "lst_celsius double, ndvi double, ndmi double, latitude double, longitude double, "
              "is_imputed boolean")
DEFAULTS = dict(nama_kabupaten_kota="X", jumlah_kasus_dbd=1, kepadatan_penduduk=100000.0,
                luas_km2=1.0, rainfall_annual=1.0, lst_celsius=1.0, ndvi=0.5, ndmi=0.1,
                latitude=0.0, longitude=0.0, is_imputed=False)
ORDER = [c.split()[0] for c in PANEL_COLS.split(", ")]


def panel_df(spark, rows):
    """rows: dicts with kode_bps, tahun and any overrides."""
    data = []
    for r in rows:
        d = dict(DEFAULTS)
        d.update(r)
        data.append(tuple(d[c] for c in ORDER))
    return spark.createDataFrame(data, PANEL_COLS)


def cfg(**kw):
    base = dict(year_start=2019, year_end=2024, on_duplicate_edges="collapse", donors=())
    base.update(kw)
    return PanelConfig(**base)


def by_key(df, *cols):
    return {(r["kode_bps"], r["tahun"]): tuple(r[c] for c in cols) for r in df.collect()}
