"""Named queries over the test tables: one callable per operator / report.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame whose
double columns are rounded to 6 places (float-noise hygiene for the
comparison with the SQL oracle in ``oracle.py``; column names match).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmart.functions.columns import normalize_code, round_doubles
from panelmart.operators import checks, clean, features, keys, panel, reports, sketches, spatial, star
from panelmart.plans import pipeline as pl
from panelmart.schemas import FACT_COLUMNS
from panelmart.sources import driver_tables as dt

# fixed run timestamp of the registered run-record queries (a run parameter)
RUN_AT = _dt.datetime(2001, 1, 1, 0, 0, 0)


class Ctx:
    """Lazily built layers of one panel over the test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, grain: str = "nation", **cfg_kw):
        self.spark, self.sf_dir, self.grain = spark, sf_dir, grain
        self.cfg = dt.config_for(grain, **cfg_kw)
        self._c = {}

    def _get(self, k, f):
        if k not in self._c:
            self._c[k] = f()
        return self._c[k]

    @property
    def raw(self):
        return self._get("raw", lambda: dt.landed_sources(self.spark, self.sf_dir, self.grain))

    @property
    def stg(self) -> pl.Staging:
        return self._get("stg", lambda: pl.build_staging(self.raw, self.cfg))

    @property
    def panel0(self) -> DataFrame:
        return self._get("panel0", lambda: pl.build_panel0(self.stg, self.cfg))

    @property
    def panel(self) -> DataFrame:
        return self._get("panel", lambda: panel.impute_from_donor(self.panel0, self.cfg))

    def feat(self, *only) -> DataFrame:
        """The panel with the named features, or with all."""
        return self._get(("feat", only), lambda: features.add_features(self.panel, self.cfg, only or None))

    def fact(self, *only) -> DataFrame:
        """The fact table, or the columns of it that a report reads."""
        return self._get(("fact", only), lambda: star.fact_table(
            self.feat(*only), self.cfg, [*KEYS, *only] if only else FACT_COLUMNS))

    # both dimensions come from the panel: they need no features
    @property
    def dim_region(self) -> DataFrame:
        return self._get("dim_region", lambda: star.dim_region(self.panel0, self.cfg))

    @property
    def dim_period(self) -> DataFrame:
        return self._get("dim_period", lambda: star.dim_period(self.panel0, self.cfg))

    def run_record(self) -> DataFrame:
        return star.run_record(self.fact("is_imputed", "incidence_rate"), self.dim_region,
                               self.dim_period, self.cfg, run_at=RUN_AT, run_id=0)


KEYS = ["kode_bps", "tahun"]


def _feat_cols(*cols):
    return lambda spark, d: Ctx(spark, d).feat(*cols).select(*KEYS, *cols)


def q_water_tier_reference(spark, d):
    """T1 compatibility: the source pipeline's guard never passes."""
    return Ctx(spark, d, tier_guard="reference").feat("water_body_density_tier").select(*KEYS, "ndmi", "water_body_density_tier")


def q_yoy_growth_unpadded(spark, d):
    """T2 option: growth to the previous row without carrying NULLs."""
    return Ctx(spark, d, growth_pad=False).feat("yoy_growth_rate").select(*KEYS, "incidence_rate", "yoy_growth_rate")


def q_panel_assemble(spark, d):
    return Ctx(spark, d).panel0


def q_surge_trend(spark, d, grain="nation"):
    c = Ctx(spark, d, grain)
    fact = c.fact("incidence_rate", "yoy_growth_rate", "rainfall_zscore")
    return reports.surge_trend(fact, c.dim_region, c.cfg)


def q_dedup_keep_first(spark, d):
    o = dt.table(spark, d, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("tahun"), "o_orderkey", "o_totalprice", "o_orderdate")
    return clean.dedup_keep_first(o, ["o_custkey", "tahun"], ["o_orderdate", "o_orderkey"])


def q_normalize_codes(spark, d):
    c = dt.table(spark, d, "customer")
    base = F.lit(dt.NATION_CODE_BASE) + F.col("c_nationkey")
    return c.select(
        "c_custkey",
        normalize_code(base).alias("code_from_int"),
        normalize_code(base.cast("double")).alias("code_from_double"),
        normalize_code(F.concat(base.cast("string"), F.lit(".0"))).alias("code_from_text"),
        normalize_code(F.col("c_name")).alias("code_from_name"),
        normalize_code(F.col("c_acctbal")).alias("code_from_balance"))


def q_map_names(spark, d):
    c = Ctx(spark, d)
    env = clean.rename_environment(c.raw.environment)
    return clean.map_names(env, c.raw.mapping, "nama_env", "kode_bps").select("nama_env", "tahun",
                                                                              "kode_bps")


def q_unmatched_names(spark, d):
    c = Ctx(spark, d)
    env = clean.rename_environment(c.raw.environment)
    return clean.unmatched_names(env, c.raw.mapping, "nama_env")


def q_stage(name):
    return lambda spark, d: getattr(Ctx(spark, d).stg, name)


def q_donor_impute(spark, d):
    c = Ctx(spark, d)
    return c.panel.select(*KEYS, *c.cfg.env_vars)


def q_imputed_flag(spark, d):
    return Ctx(spark, d).panel.select(*KEYS, "is_imputed")


def q_imputation_leaks(spark, d):
    c = Ctx(spark, d)
    return panel.imputation_leaks(c.panel0, c.cfg)


def q_standardize_sample(spark, d):
    c = Ctx(spark, d)
    p = c.cfg.period
    cols = ["lst_celsius", "kepadatan_penduduk", "ndvi"]
    st = features.period_stats(c.panel, p, samp_cols=cols)
    out = c.panel.join(F.broadcast(st), p, "left")
    return out.select(*KEYS, *[features.zscore_samp(x).alias(f"z_{x}") for x in cols])


BINNED = ("lst_quartile_rank", "water_body_density_tier", "ir_q", "kepadatan_quartile")


def q_binned_by_counting(spark, d):
    """A11, W4, W6, W10, W12 with edges found by counting, customer panel."""
    return Ctx(spark, d, "customer", quantiles="count").feat(*BINNED).select(*KEYS, *BINNED)


def _sketched(*cols):
    return lambda spark, d: Ctx(spark, d, quantiles="sketch").feat(*cols[1:]).select(*KEYS, *cols)


def q_quantile_sketch_error(spark, d):
    """Per binned column and group of the customer panel: values, and whether
    every sketched edge keeps the sketch's rank error (three times the error
    that it keeps with 99 % confidence)."""
    c = Ctx(spark, d, "customer")
    specs = features.bin_specs(c.cfg)
    base = c.panel.withColumn("incidence_rate", features.incidence_rate(
        "jumlah_kasus_dbd", "kepadatan_penduduk", "luas_km2"))
    edges = sketches.edge_arrays_by_sketch(base, specs)
    names = F.array(*[F.lit(s.name.lstrip("_")) for s in specs])
    worst = (sketches.rank_errors(base, specs, edges).groupBy("_s", "_k")
             .agg(F.max("_error").alias("_error")))
    return edges.join(worst, ["_s", "_k"]).select(
        names[F.col("_s")].alias("bin"), F.col("_k").alias("tahun"), F.col("_n").alias("n"),
        (F.col("_error") <= 3 * sketches.rank_error()).alias("within"))


def q_dim(name):
    return lambda spark, d: getattr(Ctx(spark, d), name)


def q_fact_panel(spark, d, grain="nation"):
    return Ctx(spark, d, grain).fact().drop("fact_id")


def q_run_record(spark, d):
    return Ctx(spark, d).run_record().drop("run_id", "run_at")


def q_vulnerability_map(spark, d):
    c = Ctx(spark, d)
    fact = c.fact("jumlah_kasus_dbd", "composite_vulnerability_index")
    return reports.vulnerability_map(fact, c.dim_region, c.cfg)


def q_event_period_compare(spark, d):
    c = Ctx(spark, d)
    return reports.event_period_compare(c.fact("jumlah_kasus_dbd", "incidence_rate"), c.dim_period, c.cfg)


def q_latest_pin_map(spark, d):
    c = Ctx(spark, d)
    fact = c.fact("jumlah_kasus_dbd", "incidence_rate", "composite_vulnerability_index")
    return reports.latest_pin_map(fact, c.dim_region, c.cfg)


def q_run_quality_report(spark, d):
    return reports.run_quality_report(Ctx(spark, d).run_record())


def _staging_dict(c: Ctx) -> dict:
    return c.stg.as_dict()


def q_check_duplicates(spark, d):
    c = Ctx(spark, d)
    s = _staging_dict(c)
    return checks.duplicate_keys({k: s[k] for k in ("stg_health", "stg_demography", "stg_environment")},
                                 KEYS)


def q_check_raw_duplicates(spark, d):
    """V1 on a raw table (before any dedup): orders per (customer, year)."""
    o = dt.table(spark, d, "orders").select(F.col("o_custkey").alias("kode_bps"),
                                            F.year("o_orderdate").alias("tahun"))
    return checks.duplicate_keys({"orders": o}, KEYS)


def q_check_null_keys(spark, d):
    c = Ctx(spark, d)
    s = _staging_dict(c)
    return checks.null_keys({k: s[k] for k in ("stg_health", "stg_demography", "stg_environment")},
                            "kode_bps")


def q_check_min_rows(spark, d):
    c = Ctx(spark, d)
    return checks.min_rows(c.stg.health, c.stg.geo, c.cfg)


def q_check_entity_count(spark, d):
    c = Ctx(spark, d)
    return checks.entity_count(c.stg.geo, c.cfg)


def q_check_orphans(spark, d):
    c = Ctx(spark, d)
    return checks.orphans(c.stg.health, c.stg.geo, "kode_bps")


def q_checks_one_pass(spark, d):
    """V1-V5 together, each staging table read once."""
    c = Ctx(spark, d)
    return checks.run_checks(_staging_dict(c), c.cfg)


def q_stable_fact_keys(spark, d):
    """The facts of the first years get numbers, then all facts do; the
    first ones keep theirs."""
    c = Ctx(spark, d, "customer")
    grain = c.stg.health.select(*KEYS)
    first = keys.extend(grain.where("tahun <= 1998"), None, KEYS)
    return keys.attach(grain, keys.extend(grain, first, KEYS), KEYS).select(*KEYS, "fact_id")


def q_published_fact_keys(spark, d):
    """D4 in the batch job: the ids in the published fact after two runs."""
    c, root = _published_run(spark, d)
    pl.run(spark, c.raw, c.cfg, root, run_at=RUN_AT)
    return star.read_published(spark, root, "fact_panel").select(*KEYS, "fact_id")


def q_table_row_counts(spark, d):
    c = Ctx(spark, d)
    t = dict(_staging_dict(c))
    t.update({"dim_region": c.dim_region, "dim_period": c.dim_period,
              "fact_panel": c.fact("incidence_rate")})
    return reports.table_row_counts(t)


def q_spatial_check(spark, d):
    c = Ctx(spark, d)
    return reports.spatial_check(c.dim_region, c.cfg)


def q_orphan_facts(spark, d):
    c = Ctx(spark, d)
    return reports.orphan_facts(c.fact("incidence_rate"), c.dim_region, c.cfg)


def q_centroids(spark, d):
    return spatial.centroids(Ctx(spark, d, "customer").raw.features)


def q_centroids_all_types(spark, d):
    """G1 for points, lines, flat rings and nested collections: one geometry
    of each kind in turn, drawn from the customers' columns."""
    c = dt.table(spark, d, "customer")
    x, y = F.col("c_nationkey").cast("double"), F.col("c_acctbal") / 1000.0
    s, i = F.lit(1.0) + F.col("c_nationkey") / 5.0, F.col("c_custkey") % 6
    at = lambda *pts: F.array(*[F.array(x + s * a, y + s * b) for a, b in pts])
    json_of = lambda kind, coords: F.concat(F.lit(f'{{"type":"{kind}","coordinates":'), F.to_json(coords), F.lit("}"))
    kinds = ["Point", "MultiPoint", "LineString", "MultiLineString", "Polygon"]
    coords = [F.array(x, y), at((0, 0), (1, 0), (0, 1)), at((0, 0), (1, 0), (1, 2)),
              F.array(at((0, 0), (1, 0)), at((0, 1), (0, 3))), F.array(at((0, 0), (1, 0), (2, 0), (0, 0)))]
    square = json_of("Polygon", F.array(at((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))))
    members = F.concat(F.lit("["), json_of("Point", F.array(x - 9.0, y)), F.lit(',{"type":"GeometryCollection","geometries":['),
                       json_of("LineString", at((0, 0), (7, 7))), F.lit(","), square, F.lit("]}]"))
    kind, text = F.lit("GeometryCollection"), F.lit(None).cast("string")
    for n, (k, v) in enumerate(zip(kinds, coords, strict=True)):
        kind, text = F.when(i == n, k).otherwise(kind), F.when(i == n, F.to_json(v)).otherwise(text)
    return spatial.centroids(c.select(
        F.struct(F.col("c_custkey").cast("string").alias("ID_KAB"), F.col("c_name").alias("KABKOT")).alias("properties"),
        F.struct(kind.alias("type"), text.alias("coordinates"), F.when(i == 5, members).alias("geometries")).alias("geometry")))


def q_csv_source_roundtrip(spark, d):
    """S1 + K5: the raw environment table (mixed-case headers) exported as
    CSV to the shared folder, read back with an explicit schema and
    case-insensitive headers."""
    import uuid

    from panelmart.schemas import RAW_ENVIRONMENT
    from panelmart.session import shared_dir
    from panelmart.sources import readers
    path = shared_dir(spark, f"exports/env-{uuid.uuid4().hex}")
    readers.write_csv(Ctx(spark, d).raw.environment, path)
    return readers.read_csv(spark, path, RAW_ENVIRONMENT, lowercase=True).drop(readers.INPUT_ORDER)


def q_geojson_source_roundtrip(spark, d):
    """S5 + G1/G2: customer polygons written as GeoJSON features (one per
    line) to the shared folder, read back and reduced to centroids."""
    import uuid

    from panelmart.session import shared_dir
    from panelmart.sources import readers
    path = shared_dir(spark, f"exports/geo-{uuid.uuid4().hex}")
    feats = Ctx(spark, d, "customer").raw.features
    (feats.select(F.to_json(F.struct(
        F.lit("Feature").alias("type"), "properties",
        F.struct("geometry.type", F.parse_json("geometry.coordinates").alias("coordinates"))
        .alias("geometry"))).alias("value"))
     .write.mode("overwrite").text(path))
    return (spatial.centroids(readers.read_geojson(spark, path, per_line=True))
            .drop(readers.INPUT_ORDER))


def _collection(spark, d, indent):
    """The customer polygons as one FeatureCollection document, on one line or
    indented, in a fresh folder of the shared store."""
    import uuid

    from panelmart.session import shared_dir
    path = shared_dir(spark, f"exports/collection-{uuid.uuid4().hex}")
    feats = Ctx(spark, d, "customer").raw.features
    text = F.to_json(F.struct(F.lit("Feature").alias("type"), "properties", F.struct(
        "geometry.type", F.parse_json("geometry.coordinates").alias("coordinates")).alias("geometry")),
        {"pretty": str(bool(indent)).lower()})
    ends = spark.createDataFrame([(0, '{"type": "FeatureCollection", "features": ['), (2, "null]}")], "o int, value string")
    # a stand-in document is one file: its parts are written one after another
    (feats.select(F.lit(1).alias("o"), F.concat(text, F.lit(",")).alias("value")).unionByName(ends)
     .coalesce(1).sortWithinPartitions("o").select("value")
     .write.mode("overwrite").option("lineSep", "\n" if indent else " ").text(path))
    return path


def q_geojson_collection(indent):
    """S5 + G1/G2: a feature collection read in byte ranges, its features
    reduced to centroids."""
    def run(spark, d):
        from panelmart.sources import readers
        return spatial.centroids(readers.read_geojson(spark, _collection(spark, d, indent))).drop(readers.INPUT_ORDER)
    return run


def q_centroids_streamed(spark, d):
    """G1 for geometries of any size: the same collection, its vertices in
    chunks that are combined by ring and feature."""
    from panelmart.operators import large_geometry
    from panelmart.schemas import GEOJSON_FEATURE_COLLECTION
    feature = GEOJSON_FEATURE_COLLECTION["features"].dataType.elementType
    found = large_geometry.read_centroids(spark, _collection(spark, d, False), feature)
    return found.select(normalize_code(F.col("properties.ID_KAB")).alias("kode_bps"), F.col("properties.KABKOT").alias("nama_geo"),
                        "latitude", "longitude")


def _exported(spark, df, name):
    """``df`` written as CSV to a fresh folder of the shared store."""
    import uuid

    from panelmart.session import shared_dir
    from panelmart.sources import readers
    path = shared_dir(spark, f"exports/{name}-{uuid.uuid4().hex}")
    readers.write_csv(df, path)
    return path


def q_csv_inferred_schema(spark, d):
    """Types and cell kinds found in a CSV export of the orders."""
    from panelmart.sources import inference
    o = dt.table(spark, d, "orders")
    path = _exported(spark, o.select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("maybe_custkey"), "o_totalprice",
        (F.col("o_orderstatus") == "F").alias("is_final"), "o_orderpriority",
        F.when(F.col("o_orderstatus") == "O", F.lit("NA")).otherwise(F.col("o_totalprice").cast("string")).alias("price_text"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("n/a")).alias("all_missing")), "orders")
    return inference.infer(inference.read_text(spark, path))


def q_csv_rejected_cells(spark, d):
    """Cells of a CSV export of the customers that don't parse where
    whole balances, numeric segments and keys are declared."""
    from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

    from panelmart.sources import inference
    schema = StructType([StructField("c_custkey", LongType()), StructField("c_acctbal", IntegerType()),
                         StructField("c_mktsegment", DoubleType())])
    raw = inference.read_text(spark, _exported(spark, dt.table(spark, d, "customer"), "customer"))
    return inference.rejected_cells(raw, schema).select("column", "text", "expected")


def _published_run(spark, d):
    """The whole batch job into a fresh warehouse folder on the shared store."""
    import uuid

    from panelmart.session import shared_dir
    c = Ctx(spark, d)
    root = shared_dir(spark, f"warehouse/{uuid.uuid4().hex}")
    pl.run(spark, c.raw, c.cfg, root, run_at=RUN_AT)
    return c, root


def q_published_fact(spark, d):
    """K1-K3: the fact as published by the batch job (partitioned by period)."""
    c, root = _published_run(spark, d)
    return star.read_published(spark, root, "fact_panel").drop("fact_id")


def q_published_quality_report(spark, d):
    """Q5 over the run log appended by the batch job."""
    from panelmart.plans.reporting import published_reports
    c, root = _published_run(spark, d)
    return published_reports(spark, root, c.cfg)["run_quality_report"]


def q_densify(spark, d):
    c = Ctx(spark, d)
    return panel.densify(c.stg.health, c.cfg)


def q_customer_panel_features(spark, d):
    return q_fact_panel(spark, d, grain="customer")


def q_customer_surge_trend(spark, d):
    return q_surge_trend(spark, d, grain="customer")


QUERIES = {
    # step 1: panel, incidence, growth, z-score, surge report
    "panel_assemble": q_panel_assemble,
    "incidence_rate": _feat_cols("incidence_rate"),
    "yoy_growth": _feat_cols("incidence_rate", "yoy_growth_rate"),
    "rainfall_zscore": _feat_cols("rainfall_mm", "rainfall_zscore"),
    "surge_trend": q_surge_trend,
    # step 2: cleaning / staging
    "dedup_keep_first": q_dedup_keep_first,
    "normalize_codes": q_normalize_codes,
    "map_names": q_map_names,
    "unmatched_names": q_unmatched_names,
    "stage_health": q_stage("health"),
    "stage_demography": q_stage("demography"),
    "stage_environment": q_stage("environment"),
    "stage_geo": q_stage("geo"),
    # step 3: imputation
    "donor_impute": q_donor_impute,
    "imputed_flag": q_imputed_flag,
    "imputation_leaks": q_imputation_leaks,
    # step 4: bins and classes
    "lst_quartile": _feat_cols("lst_celsius", "lst_quartile_rank"),
    "water_tier": _feat_cols("ndmi", "water_body_density_tier"),
    "density_quartile_global": _feat_cols("kepadatan_penduduk", "kepadatan_quartile"),
    "density_tier": _feat_cols("kepadatan_quartile", "density_tier"),
    "ir_quartile": _feat_cols("incidence_rate", "ir_q"),
    "ndvi_class": _feat_cols("ndvi", "ndvi_class"),
    # step 5: series and index
    "rainfall_lags": _feat_cols("rainfall_mm", "lag1_rainfall", "lag2_rainfall", "lag3_rainfall"),
    "standardize_sample": q_standardize_sample,
    "vulnerability_index": _feat_cols("composite_vulnerability_index"),
    "endemic_score": _feat_cols("ir_q", "endemic_persistence_score"),
    # step 6: star schema
    "dim_region": q_dim("dim_region"),
    "dim_period": q_dim("dim_period"),
    "fact_panel": q_fact_panel,
    "run_record": q_run_record,
    "published_fact": q_published_fact,
    "published_fact_keys": q_published_fact_keys,
    "stable_fact_keys": q_stable_fact_keys,
    "published_quality_report": q_published_quality_report,
    # step 7: reports
    "vulnerability_map": q_vulnerability_map,
    "event_period_compare": q_event_period_compare,
    "latest_pin_map": q_latest_pin_map,
    "run_quality_report": q_run_quality_report,
    # step 8: checks
    "check_duplicates": q_check_duplicates,
    "check_raw_duplicates": q_check_raw_duplicates,
    "check_null_keys": q_check_null_keys,
    "check_min_rows": q_check_min_rows,
    "check_entity_count": q_check_entity_count,
    "check_orphans": q_check_orphans,
    "checks_one_pass": q_checks_one_pass,
    "table_row_counts": q_table_row_counts,
    "spatial_check": q_spatial_check,
    "orphan_facts": q_orphan_facts,
    # step 9: geometry; densify option
    "centroids": q_centroids,
    "centroids_all_types": q_centroids_all_types,
    "csv_source_roundtrip": q_csv_source_roundtrip,
    "centroids_streamed": q_centroids_streamed,
    "geojson_collection_line": q_geojson_collection(False),
    "geojson_collection_indented": q_geojson_collection(True),
    "csv_inferred_schema": q_csv_inferred_schema,
    "csv_rejected_cells": q_csv_rejected_cells,
    "geojson_source_roundtrip": q_geojson_source_roundtrip,
    "densify": q_densify,
    # step 10: edges by counting and by sketches
    "binned_by_counting": q_binned_by_counting,
    "lst_quartile_sketched": _sketched("lst_celsius", "lst_quartile_rank"),
    "density_quartile_sketched": _sketched("kepadatan_penduduk", "kepadatan_quartile"),
    "quantile_sketch_error": q_quantile_sketch_error,
    # trap options
    "water_tier_reference": q_water_tier_reference,
    "yoy_growth_unpadded": q_yoy_growth_unpadded,
    # scale check: customer x year panel (entity windows really shuffle)
    "customer_panel_features": q_customer_panel_features,
    "customer_surge_trend": q_customer_surge_trend,
}


def rounded(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(fn(spark, sf_dir), 6)
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def queries() -> dict:
    return {k: rounded(v) for k, v in QUERIES.items()}
