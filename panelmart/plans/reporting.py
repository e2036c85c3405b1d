"""The reporting queries over a published warehouse (what dashboards read)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelmart.config import PanelConfig
from panelmart.operators import reports, star


def published_reports(spark: SparkSession, root: str, cfg: PanelConfig) -> dict[str, DataFrame]:
    """Q1-Q6 over the newest published run under ``root`` and its run log."""
    fact = star.read_published(spark, root, "fact_panel")
    dim_r = star.read_published(spark, root, "dim_region")
    dim_p = star.read_published(spark, root, "dim_period")
    runs = spark.read.parquet(f"{root.rstrip('/')}/pipeline_runs")
    staging = {n: star.read_published(spark, root, f"staging/{n}")
               for n in ("stg_health", "stg_demography", "stg_environment", "stg_geo")}
    return {
        "surge_trend": reports.surge_trend(fact, dim_r, cfg),
        "vulnerability_map": reports.vulnerability_map(fact, dim_r, cfg),
        "event_period_compare": reports.event_period_compare(fact, dim_p, cfg),
        "latest_pin_map": reports.latest_pin_map(fact, dim_r, cfg),
        "run_quality_report": reports.run_quality_report(runs),
        "table_row_counts": reports.table_row_counts(
            {**staging, "dim_region": dim_r, "dim_period": dim_p, "fact_panel": fact}),
        "spatial_check": reports.spatial_check(dim_r, cfg),
        "orphan_facts": reports.orphan_facts(fact, dim_r, cfg),
    }
