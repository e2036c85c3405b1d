"""What a change of the sources reaches (K2/D3): digests, closure, manifest.

Every staging table has an order-free digest of each period.  Periods whose
digests differ from those of the version before have changed, and rules tell
which periods of the fact they reach.  Only those are computed and written; a
manifest names the run that holds each period's partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from panelmart.config import PanelConfig

#: Rows that a measurement reaches ahead, through the lag cascade.
LAGS = 3

#: One table of digests: sources are staging tables and "config".
DIGESTS = "source string, period int, rows long, total decimal(38,0), mixed long"


def digests(tables: dict[str, DataFrame], period: str) -> DataFrame:
    """source, period, rows, total and mixed (sum and exclusive or of the
    rows' hashes): equal for equal rows in any order.  One partial aggregate
    a table; a table without the period has one digest (period null)."""
    out = []
    for name, df in tables.items():
        row = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
        at = F.col(period).cast("int") if period in df.columns else F.lit(None).cast("int")
        out.append(df.select(F.lit(name).alias("source"), at.alias("period"), row.alias("h"))
                   .groupBy("source", "period").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("h").cast("decimal(38,0)")).alias("total"),
                                                    F.bit_xor("h").alias("mixed")))
    return reduce(DataFrame.unionByName, out)


def staging_digests(staging: dict[str, DataFrame], cfg: PanelConfig) -> DataFrame:
    """Digests of the staging tables and of the configuration."""
    spark = next(iter(staging.values())).sparkSession
    settings = spark.createDataFrame([(repr(cfg),)], "c string")
    return digests(staging, cfg.period).unionByName(digests({"config": settings}, cfg.period))


def changed(now: DataFrame, before: DataFrame) -> list[tuple[str, int | None]]:
    """(source, period) whose digests differ, that came or that went: a row
    for each source and period, of which there are few."""
    old = before.select(*[F.col(c).alias(f"_{c}") for c in before.columns])
    same = (now["source"] == old["_source"]) & now["period"].eqNullSafe(old["_period"])
    both = now.join(old, same, "full")
    differ = reduce(lambda a, b: a | b, [~both[c].eqNullSafe(both[f"_{c}"]) for c in ("rows", "total", "mixed")])
    rows = both.where(differ).select(F.coalesce("source", "_source").alias("s"), F.coalesce("period", "_period").alias("p")).collect()
    return sorted(((r["s"], r["p"]) for r in rows), key=lambda x: (x[0], x[1] is not None, x[1] or 0))


def reached(diff: list[tuple[str, int | None]], grain: DataFrame, cfg: PanelConfig) -> list[int] | None:
    """Periods of the fact that a change reaches; None: all of them.

    * configuration, health or demography: all, for a rate reaches its
      entity's persistence in every period, a density the global bins, and
      a new row the lags of all that follow;
    * environment: its periods (imputation, period statistics and bins) and
      those of the up to ``LAGS`` rows of an entity that follow a changed one;
    * geometry: none (coordinates are in the dimension).

    ``grain`` has the panel's entities and periods."""
    sources = {s for s, _ in diff}
    if sources & {"config", "stg_health", "stg_demography"}:
        return None
    periods = sorted(p for s, p in diff if s == "stg_environment")
    if not periods:
        return []
    order = W.partitionBy(cfg.entity).orderBy(cfg.period)
    hit = F.col(cfg.period).isin(periods)
    ahead = F.max(hit.cast("int")).over(order.rowsBetween(-LAGS, 0))
    rows = grain.select(cfg.entity, cfg.period, ahead.alias("r")).where("r = 1").select(cfg.period).distinct().collect()
    return sorted({r[0] for r in rows})


def manifest(spark: SparkSession, periods: dict[int, int]) -> DataFrame:
    """tahun, run: which run holds each period's partition of the fact."""
    return spark.createDataFrame(sorted(periods.items()), "tahun int, run long")


def read_by_manifest(spark: SparkSession, folder, holds: dict[int, int]) -> DataFrame:
    """The fact from the runs that hold its periods (``folder`` gives a run's
    path); period filters still prune the partitions."""
    by_run: dict[int, list[int]] = {}
    for period, run in holds.items():
        by_run.setdefault(run, []).append(period)
    parts = [spark.read.parquet(f"{folder(run)}/fact_panel").where(F.col("tahun").isin(sorted(ps))) for run, ps in sorted(by_run.items())]
    return reduce(DataFrame.unionByName, parts)
