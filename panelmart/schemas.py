"""Explicit StructTypes for every raw, staging and warehouse table."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField,
    StructType, TimestampType,
)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, I, L, D, B, TS = StringType(), IntegerType(), LongType(), DoubleType(), BooleanType(), TimestampType()

# raw sources (column names as the source systems deliver them)
RAW_HEALTH = _s(("kode_bps", S), ("nama_kabupaten_kota", S), ("tahun", I), ("jumlah_kasusDBD", I))
RAW_DENSITY = _s(("kode_bps", S), ("tahun", I), ("kepadatan_penduduk", D))
RAW_AREA = _s(("kode_bps", S), ("tahun", I), ("luas_km2", D))
# environment headers are lower-cased on read, whatever their case in the file
RAW_ENVIRONMENT = _s(("adm2_name", S), ("year", I), ("rainfall_annual", D),
                     ("lst_celsius", D), ("ndvi", D), ("ndmi", D))
REGION_MAPPING = _s(("kode_bps", S), ("nama_env", S))

# staging
STG_HEALTH = _s(("kode_bps", S), ("nama_kabupaten_kota", S), ("tahun", I), ("jumlah_kasus_dbd", I))
STG_DEMOGRAPHY = _s(("kode_bps", S), ("tahun", I), ("kepadatan_penduduk", D), ("luas_km2", D))
STG_ENVIRONMENT = _s(("kode_bps", S), ("tahun", I), ("rainfall_annual", D), ("lst_celsius", D),
                     ("ndvi", D), ("ndmi", D))
STG_GEO = _s(("kode_bps", S), ("nama_geo", S), ("latitude", D), ("longitude", D))

# warehouse
DIM_REGION = _s(("kode_bps", S), ("nama_kabupaten_kota", S), ("kode_provinsi", S),
                ("nama_provinsi", S), ("latitude", D), ("longitude", D))
DIM_PERIOD = _s(("tahun", I), ("covid_dummy", I), ("keterangan_periode", S))
FACT_PANEL = _s(
    ("fact_id", L), ("kode_bps", S), ("tahun", I), ("jumlah_kasus_dbd", I),
    ("incidence_rate", D), ("kepadatan_penduduk", D), ("luas_km2", D), ("rainfall_mm", D),
    ("rainfall_zscore", D), ("lst_celsius", D), ("lst_quartile_rank", S), ("ndvi", D),
    ("ndvi_class", S), ("ndmi", D), ("water_body_density_tier", S), ("lag1_rainfall", D),
    ("lag2_rainfall", D), ("lag3_rainfall", D), ("composite_vulnerability_index", D),
    ("yoy_growth_rate", D), ("kepadatan_quartile", S), ("density_tier", S),
    ("is_imputed", B), ("ir_q", I), ("endemic_persistence_score", I),
)
#: The fact without its surrogate key.
FACT_COLUMNS = tuple(f.name for f in FACT_PANEL.fields if f.name != "fact_id")
PIPELINE_RUNS = _s(
    ("run_id", L), ("run_at", TS), ("year_start", I), ("year_end", I), ("n_regions", L),
    ("n_years", L), ("fact_rows", L), ("imputed_rows", L), ("null_ir_rows", L), ("status", S),
)

# GeoJSON: coordinates (and a collection's members) kept as JSON text, parsed
# per geometry type later
GEOJSON_FEATURE_COLLECTION = StructType([
    StructField("type", S),
    StructField("features", ArrayType(
        StructType([
            StructField("type", S),
            StructField("properties", StructType([
                StructField("ID_KAB", S), StructField("KABKOT", S)])),
            StructField("geometry", StructType([
                StructField("type", S), StructField("coordinates", S),
                StructField("geometries", S)])),
        ]))),
])

WAREHOUSE_TABLES = {
    "dim_region": DIM_REGION,
    "dim_period": DIM_PERIOD,
    "fact_panel": FACT_PANEL,
    "pipeline_runs": PIPELINE_RUNS,
}
STAGING_TABLES = {
    "stg_health": STG_HEALTH,
    "stg_demography": STG_DEMOGRAPHY,
    "stg_environment": STG_ENVIRONMENT,
    "stg_geo": STG_GEO,
}
