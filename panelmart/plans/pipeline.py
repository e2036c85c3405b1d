"""The batch job: stage -> check -> panel -> features -> star -> run log.

``build_*`` functions return lazy DataFrames (one Catalyst plan each, so
repeated sub-plans share their exchanges); only binned features write the
panel and its sorted values while they are built.  ``run`` materialises at the two
points that every later step reads - staging and the feature panel - by
writing them to the warehouse folder, which also cuts the lineage (a lost
executor recomputes from those files, not from the raw sources).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from panelmart.config import PanelConfig
from panelmart.operators import checks, clean, features, keys, panel, refresh, spatial, star
from panelmart.sources.driver_tables import RawSources
from panelmart.sources.readers import write_tables


@dataclass
class Staging:
    health: DataFrame
    demography: DataFrame
    environment: DataFrame
    geo: DataFrame

    def as_dict(self) -> dict:
        return {"stg_health": self.health, "stg_demography": self.demography,
                "stg_environment": self.environment, "stg_geo": self.geo}


def build_staging(raw: RawSources, cfg: PanelConfig) -> Staging:
    geo = clean.stage_geo(spatial.centroids(raw.features, code_col=cfg.entity), cfg)
    return Staging(
        health=clean.stage_health(raw.health, cfg),
        demography=clean.stage_demography(raw.density, raw.area, cfg),
        environment=clean.stage_environment(raw.environment, raw.mapping, cfg),
        geo=geo,
    )


def build_panel0(stg: Staging, cfg: PanelConfig) -> DataFrame:
    """The assembled panel (lazy; bins write it, see add_features)."""
    return panel.assemble(stg.health, stg.demography, stg.environment, stg.geo, cfg)


def build_panel(stg: Staging, cfg: PanelConfig) -> DataFrame:
    """D5 + I1-I3: the assembled, imputed panel (no features yet)."""
    return panel.impute_from_donor(build_panel0(stg, cfg), cfg)


def build_features(stg: Staging, cfg: PanelConfig) -> DataFrame:
    return features.add_features(build_panel(stg, cfg), cfg)


@dataclass
class Star:
    dim_region: DataFrame
    dim_period: DataFrame
    fact: DataFrame


def build_star(feat: DataFrame, cfg: PanelConfig) -> Star:
    return Star(star.dim_region(feat, cfg), star.dim_period(feat, cfg), star.fact_table(feat, cfg))


def run(spark: SparkSession, raw: RawSources, cfg: PanelConfig, root: str,
        enforce_checks: bool = True, run_at=None, keep_runs: int = 2, incremental: bool = False) -> dict:
    """One load: returns {'run_id', 'checks', 'status', 'load_status',
    'unmatched_names', 'imputation_leaks', 'rewritten'}; the two before the
    last are DataFrames of the rows that mapping and imputation left without
    a value, the last the fact's periods that were written (None: all).

    All that a run writes lies under ``root/runs/<id>``, so that runs never
    touch each other's files.  Staging is written there and checked in one
    pass (all failures in one error), then the feature panel, then the star
    tables.  The fact's ids come from the key map of the version the run
    began from, with new keys added; they stay the same from run to run.  The
    run becomes the newest version only if no other was published meanwhile
    (else ``star.PublishConflict``); then the run record is appended to
    ``root/pipeline_runs`` and runs older than the ``keep_runs`` newest expire.

    ``incremental``: only the fact's periods that a change of staging since
    that version reaches are computed and written (see :mod:`refresh`); the
    others stay where they are.  Without a version before, all are.
    """
    root = root.rstrip("/")
    began = star.versions(spark, root, 1)
    read = began[-1][0] if began else 0
    run_id = star.new_run_id()
    base = star.run_folder(root, run_id)
    stg = build_staging(raw, cfg)
    write_tables({f"{base}/staging/{name}": df for name, df in stg.as_dict().items()})
    stg = Staging(*[spark.read.parquet(f"{base}/staging/{n}")
                    for n in ("stg_health", "stg_demography", "stg_environment", "stg_geo")])
    one = checks.summarize(stg.as_dict(), cfg).first().asDict()  # a single row of counts
    res = checks.results(spark.createDataFrame([one], ", ".join(f"{c} long" for c in one)), cfg)
    if enforce_checks:
        checks.enforce(res)
    status = checks.status_of(one, stg.as_dict())
    refresh.staging_digests(stg.as_dict(), cfg).coalesce(1).write.parquet(f"{base}/digests")
    rewritten, holds = None, {}
    if incremental and began:
        last = began[-1][1]
        now, before = (spark.read.parquet(f"{star.run_folder(root, r)}/digests") for r in (run_id, last))
        rewritten = refresh.reached(refresh.changed(now, before), stg.health, cfg)
        holds = star.holders(spark, root, last)
    feat = build_features(stg, cfg)
    if rewritten is not None:
        feat = feat.where(feat[cfg.period].isin(rewritten))
    feat.write.parquet(f"{base}/work/panel_features")
    feat = spark.read.parquet(f"{base}/work/panel_features")
    whole = feat if rewritten is None else build_panel0(stg, cfg)  # the dimensions need no features
    s = Star(star.dim_region(whole, cfg), star.dim_period(whole, cfg), star.fact_table(feat, cfg))
    on = ["kode_bps", "tahun"]  # the fact's names of entity and period
    known = spark.read.parquet(f"{star.run_folder(root, began[-1][1])}/fact_keys") if began else None
    keys.extend(s.fact, known, on).write.parquet(f"{base}/fact_keys")
    fact = keys.attach(s.fact, spark.read.parquet(f"{base}/fact_keys"), on)
    if rewritten is not None:
        periods = [r[0] for r in stg.health.select(cfg.period).distinct().collect()]  # the configured years at most
        refresh.manifest(spark, {p: run_id if p in rewritten else holds.get(p, began[-1][1]) for p in periods}).coalesce(1).write.parquet(
            f"{base}/fact_manifest")
    star.publish(spark, root, {"dim_region": s.dim_region, "dim_period": s.dim_period, "fact_panel": fact},
                 run_id=run_id, partition_by={"fact_panel": [cfg.period]}, read=read)
    mine = lambda name: spark.read.parquet(f"{base}/{name}")
    fact = mine("fact_panel") if rewritten is None else refresh.read_by_manifest(
        spark, lambda r: star.run_folder(root, r), star.holders(spark, root, run_id))
    rec = star.run_record(fact, mine("dim_region"), mine("dim_period"), cfg,
                          run_at=run_at, run_id=run_id)
    r = rec.first()  # one row, computed once
    star.append_run_log(spark.createDataFrame([r], rec.schema), root)
    load_status = (f"loaded|regions={r['n_regions']}|periods={r['n_years']}|fact={r['fact_rows']}"
                   f"|imputed={r['imputed_rows']}|null_ir={r['null_ir_rows']}")
    star.expire(spark, root, keep=keep_runs)
    unmatched = clean.unmatched_names(clean.rename_environment(raw.environment), raw.mapping,
                                      "nama_env", cfg.entity)
    return {"run_id": run_id, "rewritten": rewritten, "checks": res, "status": status, "load_status": load_status,
            "unmatched_names": unmatched,
            "imputation_leaks": panel.imputation_leaks(build_panel0(stg, cfg), cfg)}
