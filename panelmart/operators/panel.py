"""Panel assembly (D5), donor imputation (I1-I4) and densify."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmart.config import PanelConfig
from panelmart.functions.columns import any_null

def assemble(health: DataFrame, demography: DataFrame, environment: DataFrame,
             geo: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Health drives the grain; demography and environment join on
    (entity, period), geometry on the entity.  All inputs are keep-first
    deduplicated, so no join fans out and row count = health rows."""
    e, p = cfg.entity, cfg.period
    joined = health.join(demography, [e, p], "left").join(environment, [e, p], "left")
    return joined.join(geo.select(e, "latitude", "longitude"), e, "left")


def donor_table(spark, cfg: PanelConfig) -> DataFrame:
    """The configured (target, donor) pairs as a two-column table."""
    return spark.createDataFrame(list(cfg.donors) or [("", "")], "_target string, _donor string") \
        .where(F.col("_target") != "")


def impute_from_donor(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Fill each env variable of a target entity, where NULL, from its
    donor entity's value of the same period; flag imputed rows.

    ``is_imputed`` = rain was NULL before filling, OR any env variable is
    still NULL after filling (the source pipeline's flag correction).  The
    donor side is the panel filtered to donor entities - at most
    (#donors x #periods) rows, so it is broadcast.  Donors use their own
    unfilled values.
    """
    e, p = cfg.entity, cfg.period
    vs = list(cfg.env_vars)
    spark = panel.sparkSession
    pairs = donor_table(spark, cfg)
    pre = F.col(vs[0]).isNull()
    donor_rows = (panel.join(F.broadcast(pairs), F.col(e) == F.col("_donor"))
                  .select(F.col("_target").alias(e), p, *[F.col(v).alias(f"_d_{v}") for v in vs]))
    out = (panel.withColumn("_pre_missing", pre)
           .join(F.broadcast(donor_rows), [e, p], "left")
           .withColumns({v: F.coalesce(F.col(v), F.col(f"_d_{v}")) for v in vs}))
    out = out.withColumn("_leak", ~F.col("_pre_missing") & any_null(vs))
    out = out.withColumn("is_imputed", F.col("_pre_missing") | any_null(vs))
    return out.drop(*[f"_d_{v}" for v in vs], "_pre_missing", "_leak")


def imputation_leaks(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """I4: rows not flagged by the rain rule but still missing a variable
    after filling (the rows whose flag the correction flips)."""
    e, p = cfg.entity, cfg.period
    vs = list(cfg.env_vars)
    filled = impute_from_donor(panel.withColumn("_pre_rain", F.col(vs[0])), cfg)
    return (filled.where(F.col("_pre_rain").isNotNull() & any_null(vs))
            .select(e, p, *vs))


def densify(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """T10 option: one row per entity for every period of the configured
    range (missing periods NULL-filled), so lags and growth are by calendar.
    Generated per entity with ``sequence`` (no cross join)."""
    e, p = cfg.entity, cfg.period
    grid = (panel.select(e).distinct()
            .select(e, F.explode(F.sequence(F.lit(cfg.year_start), F.lit(cfg.year_end))).alias(p)))
    return grid.join(panel, [e, p], "left")
