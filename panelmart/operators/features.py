"""Panel features W1-W14 as Column builders plus one period aggregate.

Plan shape (see README "Scale"): row-local columns first, then ONE
``groupBy(period)`` aggregate (partial aggregation; one row per period) and
the quantile edges, both broadcast-joined back, then ONE entity window
(shuffle on the entity, sort on the period) for growth, lags and the
persistence score.  No window is ever partitioned by the period alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelmart import config as C
from panelmart.config import PanelConfig
from panelmart.functions.columns import ieee_div, label_map
from panelmart.operators.quantiles import BinSpec, add_bins
from panelmart.session import cut_lineage


def incidence_rate(cases, density, area) -> F.Column:
    """Cases / (density x area) x 100000 (population is derived)."""
    pop = F.col(density) * F.col(area)
    return ieee_div(F.col(cases), pop) * F.lit(C.INCIDENCE_PER)


def ndvi_class(v) -> F.Column:
    """< 0.4 Sparse, <= 0.6 Moderate, else Dense; NULL stays NULL."""
    v = F.col(v)
    sparse, moderate, dense = C.NDVI_CLASSES
    return (F.when(v < C.NDVI_SPARSE_BELOW, sparse)
            .when(v <= C.NDVI_MODERATE_UPTO, moderate)
            .when(v.isNotNull(), dense))


def period_stats(df: DataFrame, period: str, pop_cols=(), samp_cols=(), range_cols=()) -> DataFrame:
    """One aggregate per period: mean + population std, mean + sample std,
    lowest and highest value.  Partial aggregation keeps it shuffle-light and
    the result has one row per period."""
    aggs = []
    for c in pop_cols:
        aggs += [F.avg(c).alias(f"_{c}_mean_p"), F.stddev_pop(c).alias(f"_{c}_sdp")]
    for c in samp_cols:
        aggs += [F.avg(c).alias(f"_{c}_mean_s"), F.stddev_samp(c).alias(f"_{c}_sds")]
    for c in range_cols:
        aggs += [F.min(c).alias(f"_{c}_lo"), F.max(c).alias(f"_{c}_hi")]
    return df.groupBy(period).agg(*aggs)


def three_values(df: DataFrame, period: str, c: str) -> DataFrame:
    """``_<c>_three`` per period: whether ``c`` has at least three distinct
    values, that is one between the lowest and the highest.  Two partial
    aggregates by period instead of a distinct count, which would shuffle
    the rows by the value."""
    ends = F.broadcast(period_stats(df, period, range_cols=[c]))  # one row per period
    between = (F.col(c) > F.col(f"_{c}_lo")) & (F.col(c) < F.col(f"_{c}_hi"))
    return (df.select(period, c).join(ends, period)
            .groupBy(period).agg(F.coalesce(F.max(between), F.lit(False)).alias(f"_{c}_three")))


def zscore_pop(c) -> F.Column:
    """(x - mean) / population std within the period; constant -> NULL."""
    return (F.col(c) - F.col(f"_{c}_mean_p")) / F.nullif(F.col(f"_{c}_sdp"), F.lit(0.0))


def zscore_samp(c) -> F.Column:
    """(x - mean) / (sample std + 1e-9) within the period."""
    return (F.col(c) - F.col(f"_{c}_mean_s")) / (F.col(f"_{c}_sds") + F.lit(C.SAMPLE_Z_EPSILON))


def vulnerability_index(rain_z, lst_z, dens_z, ndvi_z) -> F.Column:
    """0.3 rain_z + 0.25 lst_z + 0.25 density_z + 0.2 (1 - ndvi_z)."""
    w1, w2, w3, w4 = C.CVI_WEIGHTS
    return (F.lit(w1) * rain_z + F.lit(w2) * lst_z + F.lit(w3) * dens_z
            + F.lit(w4) * (F.lit(1.0) - ndvi_z))


def lag_cascade(c: str, w, depth: int = 3) -> dict:
    """lag_k = lag(x, k), falling back to lag_{k-1} (lag_0 = x)."""
    out, prev = {}, F.col(c)
    for k in range(1, depth + 1):
        cur = F.coalesce(F.lag(c, k).over(w), prev)
        out[f"lag{k}_rainfall"] = cur
        prev = cur
    return out


def bin_specs(cfg: PanelConfig) -> list[BinSpec]:
    p = cfg.period
    return [
        BinSpec("lst_quartile_rank", "lst_celsius", p, C.QUARTILE_LABELS),
        BinSpec("_ndmi_tier", "ndmi", p, C.TIER_LABELS),
        BinSpec("ir_q", "incidence_rate", p, C.IR_QUARTILE_LABELS),
        BinSpec("kepadatan_quartile", "kepadatan_penduduk", None, C.QUARTILE_LABELS),
    ]


#: Features that need a bin label, and which.
BINS_OF = {
    "lst_quartile_rank": "lst_quartile_rank", "water_body_density_tier": "_ndmi_tier",
    "ir_q": "ir_q", "endemic_persistence_score": "ir_q",
    "kepadatan_quartile": "kepadatan_quartile", "density_tier": "kepadatan_quartile",
}
#: Features that need the statistics of the period, and those by entity.
BY_PERIOD = ("rainfall_zscore", "composite_vulnerability_index")
BY_ENTITY = ("yoy_growth_rate", "lag1_rainfall", "lag2_rainfall", "lag3_rainfall",
             "endemic_persistence_score")
ROW_LOCAL = ("rainfall_mm", "incidence_rate", "ndvi_class")
FEATURES = tuple(dict.fromkeys([*ROW_LOCAL, *BY_PERIOD, *BINS_OF, *BY_ENTITY]))


def add_features(panel: DataFrame, cfg: PanelConfig, only=None) -> DataFrame:
    """W1-W14 on an imputed panel (one row per entity x period): all of them,
    or those named in ``only`` and what they are made of.

    Only bins sort and write: without a binned feature the result is lazy.
    """
    e, p = cfg.entity, cfg.period
    wanted = set(FEATURES if only is None else only) & set(FEATURES)
    df = panel.withColumns({
        "rainfall_mm": F.col("rainfall_annual"),                                      # W14
        "incidence_rate": incidence_rate("jumlah_kasus_dbd", "kepadatan_penduduk", "luas_km2"),  # W1
        "ndvi_class": ndvi_class("ndvi"),                                              # W5
    })
    names = {BINS_OF[c] for c in wanted if c in BINS_OF}
    if cfg.tier_guard == "reference":
        names.discard("_ndmi_tier")
    specs = [s for s in bin_specs(cfg) if s.name in names]
    if specs and cfg.quantiles != "sketch":
        # the quantile passes, the period statistics and the final projection
        # all read the panel: write it once (shared checkpoint folder) so its
        # joins run once and a lost executor restarts from the files
        df = cut_lineage(df, "panel")
    stats = None
    if wanted & set(BY_PERIOD):
        stats = period_stats(df, p, pop_cols=["rainfall_mm"],
                             samp_cols=["lst_celsius", "kepadatan_penduduk", "ndvi"])
    guards = {}
    if "_ndmi_tier" in names:
        # Tier only where the period has enough distinct ndmi values (T1);
        # the guard sits inside the label expression, so a guarded-off period
        # never evaluates (or raises on) its bins
        three = three_values(df, p, "ndmi")
        stats = three if stats is None else stats.join(three, p)
        guards = {"_ndmi_tier": F.col("_ndmi_three")}
    if specs:
        df = add_bins(df, specs, on_duplicate=cfg.on_duplicate_edges, extra_by_period=stats,
                      period=p, tiebreak=[e, p], guards=guards, method=cfg.quantiles)
    elif stats is not None:
        df = df.join(F.broadcast(stats), p, "left")  # one row per period
    if "water_body_density_tier" in wanted:                                           # W6
        df = df.withColumn("water_body_density_tier", F.col("_ndmi_tier") if "_ndmi_tier" in names
                           else F.lit(None).cast("string"))
    if "density_tier" in wanted:                                                       # W11
        df = df.withColumn("density_tier", label_map(
            "kepadatan_quartile", dict(zip(C.QUARTILE_LABELS, C.DENSITY_TIER_LABELS))))
    if wanted & set(BY_PERIOD):
        df = df.withColumn("rainfall_zscore", zscore_pop("rainfall_mm"))               # W3
        df = df.withColumn("composite_vulnerability_index", vulnerability_index(      # W8, W9
            F.col("rainfall_zscore"), zscore_samp("lst_celsius"),
            zscore_samp("kepadatan_penduduk"), zscore_samp("ndvi")))
    if wanted & set(BY_ENTITY):
        df = df.withColumns(_by_entity(cfg, wanted))
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def _by_entity(cfg: PanelConfig, wanted: set) -> dict:
    """Growth, lags and persistence over one entity window (the same
    partition and order: one shuffle, one sort)."""
    w = Window.partitionBy(cfg.entity).orderBy(cfg.period)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ir = F.col("incidence_rate")
    before = F.lag("incidence_rate", 1).over(w)
    if cfg.growth_pad:  # the last known rate stands in for a missing one
        ir = F.last(ir, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
        before = F.last("incidence_rate", ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, -1))
    out = {"yoy_growth_rate": (ieee_div(ir, before) - F.lit(1.0)) * F.lit(100.0),      # W2
           **lag_cascade("rainfall_mm", w)}                                            # W7
    if "endemic_persistence_score" in wanted:                                          # W13
        out["endemic_persistence_score"] = F.sum(
            F.when(F.col("ir_q") == 4, 1).otherwise(0)).over(whole).cast("int")
    return {c: x for c, x in out.items() if c in wanted}
