"""Star schema (D1-D4), run record (D6, A14), publish (K2-K4)."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmart import config as C
from panelmart.config import PanelConfig
from panelmart.operators.refresh import read_by_manifest
from panelmart.schemas import FACT_COLUMNS, FACT_PANEL, PIPELINE_RUNS, WAREHOUSE_TABLES
from panelmart.sources.readers import write_table, write_tables


def dim_region(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """One row per entity with name / lat / lon of its earliest period,
    plus the constant province code and name."""
    e, p = cfg.entity, cfg.period
    first = F.min_by(F.struct(F.col(cfg.name).alias("n"), F.col("latitude").alias("la"),
                              F.col("longitude").alias("lo")), F.col(p))
    return (panel.groupBy(e).agg(first.alias("_f"))
            .select(F.col(e), F.col("_f.n").alias("nama_kabupaten_kota"),
                    F.lit(cfg.province_code).alias("kode_provinsi"),
                    F.lit(cfg.province_name).alias("nama_provinsi"),
                    F.col("_f.la").cast("double").alias("latitude"),
                    F.col("_f.lo").cast("double").alias("longitude")))


def dim_period(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Distinct periods with the event dummy and label."""
    p = cfg.period
    ev = F.col(p).isin(list(cfg.event_periods))
    return (panel.select(F.col(p).cast("int").alias(p)).distinct()
            .select(p, F.when(ev, 1).otherwise(0).cast("int").alias("covid_dummy"),
                    F.when(ev, F.lit(C.EVENT_LABEL)).otherwise(F.lit(C.NORMAL_LABEL))
                    .alias("keterangan_periode")))


def fact_table(features: DataFrame, cfg: PanelConfig, columns=FACT_COLUMNS) -> DataFrame:
    """The fact columns (all, or ``columns``), is_imputed NULL -> false, and a stable
    surrogate key ``fact_id = xxhash64(entity, period)`` (no sequence)."""
    e, p = cfg.entity, cfg.period
    types = {f.name: f.dataType for f in FACT_PANEL.fields}
    cols = []
    for c in columns:
        src = {"kode_bps": e, "tahun": p}.get(c, c)
        x = F.col(src)
        if c == "is_imputed":
            x = F.coalesce(x, F.lit(False))
        cols.append(x.cast(types[c]).alias(c))
    return features.select(F.xxhash64(F.col(e), F.col(p)).alias("fact_id"), *cols)


def run_record(fact: DataFrame, dim_r: DataFrame, dim_p: DataFrame, cfg: PanelConfig,
               run_at=None, run_id: int | None = None, status: str = C.RUN_STATUS_SUCCESS) -> DataFrame:
    """One row describing the load: one aggregate over the fact, the
    dimension counts as scalar subqueries."""
    run_at = run_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rid = run_id if run_id is not None else new_run_id()
    f = fact.agg(F.count(F.lit(1)).alias("fact_rows"),
                 F.count_if(F.col("is_imputed")).alias("imputed_rows"),
                 F.count_if(F.col("incidence_rate").isNull()).alias("null_ir_rows"))
    out = f.withColumns({
        "n_regions": dim_r.agg(F.count(F.lit(1))).scalar(),
        "n_years": dim_p.agg(F.count(F.lit(1))).scalar()})
    return out.select(
        F.lit(rid).cast("long").alias("run_id"),
        F.lit(run_at).cast("timestamp").alias("run_at"),
        F.lit(cfg.year_start).cast("int").alias("year_start"),
        F.lit(cfg.year_end).cast("int").alias("year_end"),
        "n_regions", "n_years", "fact_rows", "imputed_rows", "null_ir_rows",
        F.lit(status).alias("status"),
    )


def create_tables_sql(database: str, location: str) -> list[str]:
    """K4: CREATE DATABASE / TABLE IF NOT EXISTS statements (Parquet)."""
    out = [f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'"]
    for name, schema in WAREHOUSE_TABLES.items():
        cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        out.append(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({cols}) USING parquet "
                   f"LOCATION '{location.rstrip('/')}/{name}'")
    return out


def ensure_tables(spark: SparkSession, database: str, location: str) -> None:
    for stmt in create_tables_sql(database, location):
        spark.sql(stmt)


class PublishConflict(RuntimeError):
    """Another run published since this one began."""


def new_run_id() -> int:
    return uuid.uuid4().int >> 65


def run_folder(root: str, run_id: int) -> str:
    """Folder of everything one run writes: no two runs share a path."""
    return f"{root.rstrip('/')}/runs/{run_id}"


def _filesystem(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and its Path class (the one that
    Spark's own readers and writers use)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    kind = jvm.org.apache.hadoop.fs.Path
    return kind(path).getFileSystem(conf), kind


def _chain(root: str) -> str:
    return f"{root.rstrip('/')}/_versions"


def versions(spark: SparkSession, root: str, last: int | None = None) -> list[tuple[int, int]]:
    """(version, run id) of all publishes, or the ``last`` ones, oldest
    first: one small file each, whose text is the run id."""
    fs, path = _filesystem(spark, root)
    if not fs.exists(path(_chain(root))):
        return []
    names = sorted(n for n in (s.getPath().getName() for s in fs.listStatus(path(_chain(root)))) if n[:1] == "v")
    out = []
    for name in names[-last:] if last else names:
        stream = fs.open(path(f"{_chain(root)}/{name}"))
        try:
            out.append((int(name[1:]), stream.readLong()))
        finally:
            stream.close()
    return out


def current_version(spark: SparkSession, root: str) -> int:
    """Number of the newest publish; 0 before the first."""
    newest = versions(spark, root, 1)
    return newest[-1][0] if newest else 0


def commit(spark: SparkSession, root: str, run_id: int, read: int) -> int:
    """Make a run the newest version, if version ``read`` still is.

    The version's file is written under another name and renamed, which
    fails where it exists: of two runs that began from one version the first
    wins, the other gets :class:`PublishConflict` and stays unseen."""
    fs, path = _filesystem(spark, root)
    if current_version(spark, root) != read:
        raise PublishConflict(f"version {read} is no longer the newest")
    fs.mkdirs(path(_chain(root)))
    draft, final = path(f"{_chain(root)}/draft-{run_id}"), path(f"{_chain(root)}/v{read + 1:012d}")
    stream = fs.create(draft, True)
    try:
        stream.writeLong(run_id)
    finally:
        stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(final).toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(final), none)
    except Exception as e:
        fs.delete(draft, False)
        raise PublishConflict(f"version {read + 1} is taken by another run") from e
    return read + 1


def publish(spark: SparkSession, root: str, tables: dict, run_id: int | None = None,
            partition_by: dict | None = None, read: int | None = None) -> int:
    """K2: write every warehouse table of one run under ``root/runs/<id>``,
    then make the run the newest version.  Readers resolve the newest
    version, so they never see a half-written load.

    ``read`` is the version that the run began from (default: the newest
    now): if another run was published in between, this one is not.
    ``partition_by`` maps a table to its partition columns (the fact by
    period: a handful of directories, and period filters - also the
    latest-period subquery - prune files at scan time)."""
    rid = run_id if run_id is not None else new_run_id()
    read = current_version(spark, root) if read is None else read
    base = run_folder(root, rid)
    write_tables({f"{base}/{name}": df for name, df in tables.items()},
                 {f"{base}/{name}": cols for name, cols in (partition_by or {}).items()})
    commit(spark, root, rid, read)
    return rid


def latest_run_id(spark: SparkSession, root: str) -> int:
    newest = versions(spark, root, 1)
    if not newest:
        raise FileNotFoundError(f"nothing published under {root}")
    return newest[-1][1]


def holders(spark: SparkSession, root: str, run_id: int) -> dict[int, int]:
    """Period -> run that holds its partition of a run's fact; empty for a
    run that wrote the whole fact itself."""
    fs, path = _filesystem(spark, root)
    at = f"{run_folder(root, run_id)}/fact_manifest"
    if not fs.exists(path(at)):
        return {}
    return {r["tahun"]: r["run"] for r in spark.read.parquet(at).collect()}  # a row a period


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read table ``name`` of the newest published run; its fact may lie in
    several runs' folders."""
    run_id = latest_run_id(spark, root)
    if name == "fact_panel" and (where := holders(spark, root, run_id)):
        return read_by_manifest(spark, lambda run: run_folder(root, run), where)
    return spark.read.parquet(f"{run_folder(root, run_id)}/{name}")


def expire(spark: SparkSession, root: str, keep: int = 2, grace_hours: float = 24.0) -> list[int]:
    """Delete the folders of runs that are neither among the ``keep`` newest
    versions, nor hold a part of their facts, nor are younger than ``grace_hours`` (a run may still be writing, a
    reader may still read).  The run ids deleted are returned."""
    fs, path = _filesystem(spark, root)
    runs = path(f"{root.rstrip('/')}/runs")
    if not fs.exists(runs):
        return []
    kept = {run for _, run in versions(spark, root, keep)} if keep else set()
    kept |= {run for r in list(kept) for run in holders(spark, root, r).values()}
    limit = _dt.datetime.now().timestamp() * 1000 - grace_hours * 3.6e6
    gone = []
    for status in fs.listStatus(runs):
        run = status.getPath().getName()
        if run.isdigit() and int(run) not in kept and status.getModificationTime() <= limit:
            fs.delete(status.getPath(), True)
            gone.append(int(run))
    return gone


def append_run_log(run: DataFrame, root: str) -> None:
    """K3: append the run record to ``root/pipeline_runs``."""
    write_table(run.select(*[F.col(f.name).cast(f.dataType) for f in PIPELINE_RUNS.fields]),
                f"{root.rstrip('/')}/pipeline_runs", mode="append")
