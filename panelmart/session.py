"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # local mode runs every task in the driver JVM (ignored once it runs)
    "spark.driver.memory": "16g",
}


# Suggested settings for a large cluster (~100 TB input): many shuffle
# partitions that AQE coalesces to ~256 MB each, 256 MB scan splits, skew
# splitting of oversized join partitions.  Merge into ``extra=`` of
# ``get_session`` or the cluster's defaults.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "panelmart", extra: dict | None = None) -> SparkSession:
    """Session with AQE on, UTC time zone and the UI off.

    ``master`` is only applied when given (on a cluster the launcher sets it).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_FALLBACK: dict = {}


def app_id(spark: SparkSession) -> str:
    """Id of the Spark application behind ``spark``."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return spark.conf.get("spark.app.id", "app")


def shared_dir(spark: SparkSession, sub: str = "") -> str:
    """Folder on the shared store named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets ``spark.checkpoint.dir`` to shared
    storage; only when it is unset (tests, local runs) is a fresh local
    folder created and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext (Spark Connect)
        sc = None
    base = spark.conf.get("spark.checkpoint.dir", None)
    if sc is not None:
        base = base or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        master = sc.master if sc is not None else ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if "dir" not in _LOCAL_FALLBACK:
            _LOCAL_FALLBACK["dir"] = tempfile.mkdtemp(prefix="panelmart-ckpt-")
        base = _LOCAL_FALLBACK["dir"]
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/") + ("/" + sub.strip("/") if sub else "")


def cut_lineage(df, name: str = "table", compression: str | None = None):
    """Write ``df`` as a Parquet table in the shared checkpoint folder and
    read it back (never a local checkpoint or a machine-local folder).

    One pass over the input (an eager ``checkpoint()`` computes its plan
    twice unless cached); later stages read the files with column pruning,
    and a lost executor recomputes from them instead of from the sources.
    ``compression``: another codec than the session's (zstd for large texts).
    """
    path = f"{shared_dir(df.sparkSession, 'tables')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path, compression=compression)
    # the schema is known: no footer-reading job on the way back
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package (a zip file through ``addPyFile``, once
    per application), so that Python tasks can import it wherever the driver
    started."""
    app = app_id(spark)
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "panelmart-core.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
