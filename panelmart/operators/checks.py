"""Data-quality gates (V1-V9) as DataFrames.

Every check returns rows ``(check, table, metric, threshold, passed)``;
``enforce`` raises one error listing every failure.  Each check is one
aggregate per table (partial aggregation; the result is one row).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmart.config import PanelConfig

def _result(df_one_row_metric: DataFrame, check: str, table: str, threshold: F.Column,
            passed: F.Column) -> DataFrame:
    return df_one_row_metric.select(
        F.lit(check).alias("check"), F.lit(table).alias("table"),
        F.col("metric").cast("long").alias("metric"),
        threshold.cast("long").alias("threshold"), passed.alias("passed"))


def duplicate_keys(tables: dict, keys) -> DataFrame:
    """V1: number of key groups with more than one row, per table."""
    out = []
    for name, df in tables.items():
        m = (df.groupBy(*keys).count().where(F.col("count") > 1)
             .agg(F.count(F.lit(1)).alias("metric")))
        out.append(_result(m, "duplicate_keys", name, F.lit(0), F.col("metric") == 0))
    return reduce(DataFrame.unionByName, out)


def null_keys(tables: dict, key: str) -> DataFrame:
    """V2: rows with a NULL entity code, per table."""
    out = []
    for name, df in tables.items():
        m = df.agg(F.count_if(F.col(key).isNull()).alias("metric"))
        out.append(_result(m, "null_keys", name, F.lit(0), F.col("metric") == 0))
    return reduce(DataFrame.unionByName, out)


def min_rows(health: DataFrame, geo: DataFrame, cfg: PanelConfig) -> DataFrame:
    """V3: health rows >= int(n_entities x n_years x fraction), entities
    counted in the geometry table (truncating, as int() does)."""
    n_geo = geo.agg(F.count(F.lit(1))).scalar()
    m = health.agg(F.count(F.lit(1)).alias("metric")).withColumn(
        "_thr", F.floor(n_geo * F.lit(cfg.n_years) * F.lit(cfg.min_row_fraction)))
    return _result(m, "min_rows", "stg_health", F.col("_thr"), F.col("metric") >= F.col("_thr"))


def entity_count(geo: DataFrame, cfg: PanelConfig) -> DataFrame:
    """V4: the geometry table has exactly the expected number of entities."""
    m = geo.agg(F.count(F.lit(1)).alias("metric"))
    exp = cfg.expected_entities
    thr = F.lit(exp) if exp is not None else F.col("metric")
    return _result(m, "entity_count", "stg_geo", thr, F.col("metric") == thr)


def orphan_codes(health: DataFrame, geo: DataFrame, key: str) -> DataFrame:
    """Distinct health codes absent from the geometry table."""
    return (health.select(key).join(geo.select(key).distinct(), key, "left_anti").distinct())


def orphans(health: DataFrame, geo: DataFrame, key: str) -> DataFrame:
    """V5: number of distinct orphan codes (health -> geometry)."""
    m = orphan_codes(health, geo, key).agg(F.count(F.lit(1)).alias("metric"))
    return _result(m, "orphan_codes", "stg_health", F.lit(0), F.col("metric") == 0)


def summarize(staging: dict, cfg: PanelConfig) -> DataFrame:
    """One row with all numbers of V1-V6: rows, rows without an entity and
    repeated keys of each table, and entities of the health table that the
    geometry table lacks.

    Each staging table is read once, its key columns only.  Rows are counted
    by (table, entity, period), these counts by entity, and those added up:
    both shuffles move counts that are combined before."""
    e, p = cfg.entity, cfg.period
    tables = list(staging)
    rows = reduce(DataFrame.unionByName, [
        df.select(F.lit(i).alias("t"), F.col(e).cast("string").alias("e"),
                  (F.col(p).cast("long") if p in df.columns else F.lit(None).cast("long")).alias("p"))
        for i, df in enumerate(staging.values())])
    keys = rows.groupBy("t", "e", "p").agg(F.count(F.lit(1)).alias("n"))
    mine = lambda i: F.col("t") == i
    by_entity = keys.groupBy("e").agg(
        *[F.sum(F.when(mine(i), F.col("n"))).alias(f"n{i}") for i in range(len(tables))],
        *[F.count_if(mine(i) & (F.col("n") > 1)).alias(f"d{i}") for i in range(len(tables))])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    out = []
    for i, t in enumerate(tables):
        out += [total(f"n{i}").alias(f"{t}_rows"), total(f"d{i}").alias(f"{t}_repeated"),
                total(F.when(F.col("e").isNull(), F.col(f"n{i}"))).alias(f"{t}_null")]
    health, geo = (F.col(f"n{tables.index(t)}") for t in ("stg_health", "stg_geo"))
    lost = health.isNotNull() & (geo.isNull() | F.col("e").isNull())
    return by_entity.agg(*out, F.count_if(lost).alias("orphans"))


def results(summary: DataFrame, cfg: PanelConfig) -> DataFrame:
    """The rows of V1-V5 (check, table, metric, threshold, passed)."""
    three = ("stg_health", "stg_demography", "stg_environment")
    least = F.floor(F.col("stg_geo_rows") * F.lit(cfg.n_years) * F.lit(cfg.min_row_fraction))
    expected = F.lit(cfg.expected_entities) if cfg.expected_entities is not None else F.col("stg_geo_rows")
    none = F.lit(0)
    found = [*[("duplicate_keys", t, F.col(f"{t}_repeated"), none, F.col(f"{t}_repeated") == 0) for t in three],
             *[("null_keys", t, F.col(f"{t}_null"), none, F.col(f"{t}_null") == 0) for t in three],
             ("min_rows", "stg_health", F.col("stg_health_rows"), least, F.col("stg_health_rows") >= least),
             ("entity_count", "stg_geo", F.col("stg_geo_rows"), expected, F.col("stg_geo_rows") == expected),
             ("orphan_codes", "stg_health", F.col("orphans"), none, F.col("orphans") == 0)]
    return summary.select(F.inline(F.array(*[
        F.struct(F.lit(check).alias("check"), F.lit(table).alias("table"), metric.cast("long").alias("metric"),
                 limit.cast("long").alias("threshold"), ok.alias("passed")) for check, table, metric, limit, ok in found])))


def run_checks(staging: dict, cfg: PanelConfig) -> DataFrame:
    """V1-V5 over the staging tables (stg_health, stg_demography,
    stg_environment, stg_geo), in one pass over each."""
    return results(summarize(staging, cfg), cfg)


def status_of(summary: dict, staging: dict) -> str:
    """V6: one summary line with the staging row counts."""
    return "valid|" + "|".join(f"{t}={summary[f'{t}_rows']}" for t in staging)


def enforce(results: DataFrame) -> DataFrame:
    """Raise one error listing all failed checks (results are a few rows)."""
    failed = results.where(~F.col("passed")).collect()
    if failed:
        lines = [f"{r['check']} on {r['table']}: metric {r['metric']}, threshold {r['threshold']}"
                 for r in failed]
        raise ValueError("staging checks not met:\n" + "\n".join(lines))
    return results


def status_line(staging: dict) -> str:
    """V6: one summary line with the staging row counts (one small job)."""
    counts = reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("t"), "n")
        for k, df in staging.items()]).collect()
    return "valid|" + "|".join(f"{r['t']}={r['n']}" for r in counts)
