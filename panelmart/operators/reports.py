"""Reporting queries Q1-Q6 over the star schema.

Sort order follows the source SQL: PostgreSQL sorts NULLs first for DESC,
so ``desc_nulls_first`` where the source has a bare DESC, and an explicit
NULLS LAST where it says so.  The keys follow the measure in each sort: the
order is total, and many rows with one measure (or none) can be split over
sort partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmart import config as C
from panelmart.config import PanelConfig


def _named(fact: DataFrame, dim_r: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Fact joined to the region dimension (inner)."""
    e = cfg.entity
    return fact.join(dim_r.select(e, "nama_kabupaten_kota", "latitude", "longitude"), e)


def surge_trend(fact: DataFrame, dim_r: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Q1: growth > 50 and rain z > 1.5 -> 'HIGH RISK', else 'Normal'
    (NULL comparisons fall to 'Normal'); by growth desc, NULLs last."""
    f = _named(fact, dim_r, cfg).orderBy(F.col("yoy_growth_rate").desc_nulls_last(), cfg.entity, cfg.period)
    flag = F.when((F.col("yoy_growth_rate") > C.SURGE_GROWTH_ABOVE)
                  & (F.col("rainfall_zscore") > C.SURGE_ZSCORE_ABOVE), F.lit(C.SURGE_LABEL)) \
        .otherwise(F.lit(C.SURGE_NORMAL_LABEL))
    return (f.select("nama_kabupaten_kota", F.col(cfg.period).alias("tahun"), "incidence_rate",
                     "yoy_growth_rate", "rainfall_zscore", flag.alias("surge_flag")))


def vulnerability_map(fact: DataFrame, dim_r: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Q2: average index and total cases per (name, lat, lon); NULL lat/lon
    form their own group; by avg_cvi desc, NULLs first."""
    f = _named(fact, dim_r, cfg)
    return (f.groupBy("nama_kabupaten_kota", "latitude", "longitude")
            .agg(F.avg("composite_vulnerability_index").alias("avg_cvi"),
                 F.sum("jumlah_kasus_dbd").cast("long").alias("total_kasus"))
            .orderBy(F.col("avg_cvi").desc_nulls_first(), "nama_kabupaten_kota", "latitude", "longitude"))


def event_period_compare(fact: DataFrame, dim_p: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Q3: average incidence (of regional rates) and total cases per period
    label.  The period dimension has one row per configured period, so it
    is broadcast."""
    p = cfg.period
    f = fact.join(F.broadcast(dim_p), p)
    return (f.groupBy("keterangan_periode")
            .agg(F.avg("incidence_rate").alias("avg_ir"),
                 F.sum("jumlah_kasus_dbd").cast("long").alias("total_kasus")))


def latest_pin_map(fact: DataFrame, dim_r: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Q4: rows of the latest period (``= (SELECT max(period))``, a scalar
    subquery), by incidence desc, NULLs first."""
    p = cfg.period
    latest = fact.agg(F.max(p)).scalar()
    f = _named(fact.where(F.col(p) == latest), dim_r, cfg).orderBy(
        F.col("incidence_rate").desc_nulls_first(), cfg.entity)
    return (f.select("nama_kabupaten_kota", "latitude", "longitude", F.col(p).alias("tahun"),
                     "jumlah_kasus_dbd", "incidence_rate", "composite_vulnerability_index"))


def run_quality_report(runs: DataFrame, limit: int = 10) -> DataFrame:
    """Q5: per run - date, year range, rows vs expected, gap, % imputed,
    % null incidence (1 decimal, NULL when no rows), status; newest 10."""
    def pct(c):
        return F.round(F.col(c) * F.lit(100.0) / F.nullif(F.col("fact_rows"), F.lit(0)), 1) \
            .cast("double")
    expected = F.col("n_regions") * F.col("n_years")
    return (runs.orderBy(F.col("run_at").desc()).limit(limit)
            .select(F.to_date("run_at").alias("run_date"),
                    F.concat(F.col("year_start").cast("string"), F.lit("–"),
                             F.col("year_end").cast("string")).alias("year_range"),
                    "fact_rows", expected.alias("expected_rows"),
                    (F.col("fact_rows") - expected).alias("row_gap"),
                    pct("imputed_rows").alias("pct_imputed"),
                    pct("null_ir_rows").alias("pct_null_ir"), "status"))


def table_row_counts(tables: dict) -> DataFrame:
    """One row per table with its row count (UNION ALL)."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("tabel"), "rows")
        for name, df in tables.items()])


def spatial_check(dim_r: DataFrame, cfg: PanelConfig, limit: int = 10) -> DataFrame:
    """V8: first regions by code with their coordinates (top-k)."""
    e = cfg.entity
    return (dim_r.select(e, "nama_kabupaten_kota", "latitude", "longitude")
            .orderBy(e).limit(limit))


def orphan_facts(fact: DataFrame, dim_r: DataFrame, cfg: PanelConfig) -> DataFrame:
    """V9: fact rows whose entity is not in the region dimension (a NULL
    entity counts as an orphan)."""
    e = cfg.entity
    return (fact.select(e).join(dim_r.select(e), e, "left_anti")
            .agg(F.count(F.lit(1)).alias("orphan_facts")))
