"""Staging operators: rename, normalise codes, filter, map names, dedup.

Staging holds no derived features (those live in ``features``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmart.config import PanelConfig
from panelmart.functions.columns import nan_to_null_all, normalize_code
from panelmart.sources.readers import INPUT_ORDER, lowercase_columns


def dedup_keep_first(df: DataFrame, keys, order_by=None) -> DataFrame:
    """One row per key, the first in ``order_by`` order (ascending).

    Done as an aggregate (``min_by`` of the row over the order key), so
    duplicates are combined map-side before the shuffle: a key holding a
    third of all rows never lands whole in one task.  Without ``order_by``
    the input order recorded by the file readers (``_input_order``) is used
    when present - the first row as the files list it - else the remaining
    columns, so the result is always deterministic.  ``_input_order`` is
    dropped from the output.
    """
    return first_rows(df, keys, order_by).select(*[c for c in df.columns if c != INPUT_ORDER])


def first_rows(df: DataFrame, keys, order_by=None) -> DataFrame:
    """:func:`dedup_keep_first` with an ``_input_order`` that it went by kept."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if order_by is None and INPUT_ORDER in df.columns:
        order_by = [INPUT_ORDER]
    if INPUT_ORDER in df.columns and INPUT_ORDER not in (
            [order_by] if isinstance(order_by, str) else list(order_by or [])):
        df = df.drop(INPUT_ORDER)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    order = [order_by] if isinstance(order_by, str) else list(order_by or others)
    row = F.struct(*[F.col(c) for c in others])
    # order struct with nulls last per field: (isNull, value) pairs
    ordk = F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))])
    out = df.groupBy(*keys).agg(F.min_by(row, ordk).alias("_r"))
    return out.select(*[F.col(c) for c in keys], *[F.col(f"_r.{c}").alias(c) for c in others]).select(*df.columns)


def _order_cols(df: DataFrame) -> list:
    return [INPUT_ORDER] if INPUT_ORDER in df.columns else []


def filter_periods(df: DataFrame, period: str, start: int, end: int) -> DataFrame:
    """P5: inclusive period range (pushed to the scan when it is a column)."""
    return df.where(F.col(period).between(start, end))


def stage_health(raw: DataFrame, cfg: PanelConfig, cases_col: str = "jumlah_kasusDBD",
                 order_by=None) -> DataFrame:
    """stg_health: code -> text, year range, rename, select, keep-first."""
    e, p = cfg.entity, cfg.period
    df = (raw.withColumn(e, normalize_code(e))
          .transform(lambda d: filter_periods(d, p, cfg.year_start, cfg.year_end))
          .withColumnRenamed(cases_col, "jumlah_kasus_dbd")
          .select(e, cfg.name, F.col(p).cast("int").alias(p),
                  F.col("jumlah_kasus_dbd").cast("int").alias("jumlah_kasus_dbd"),
                  *_order_cols(raw)))
    return dedup_keep_first(df, [e, p], order_by)


def stage_demography(density: DataFrame, area: DataFrame, cfg: PanelConfig,
                     order_by=None) -> DataFrame:
    """stg_demography: density left-join area on (code, year) - before the
    dedup, as in the source pipeline - then keep-first: of several area rows
    for one density row, the first of the area files, else the smallest."""
    e, p = cfg.entity, cfg.period
    d = (density.withColumn(e, normalize_code(e))
         .transform(lambda x: filter_periods(x, p, cfg.year_start, cfg.year_end)))
    a = (area.withColumn(e, normalize_code(e))
         .transform(lambda x: filter_periods(x, p, cfg.year_start, cfg.year_end))
         .select(e, p, "luas_km2", *[F.col(c).alias("_area_order") for c in _order_cols(area)]))
    ties = ["_area_order"] if "_area_order" in a.columns else []
    if order_by is None and _order_cols(density):
        order_by = [*_order_cols(density), *(ties or ["luas_km2"])]
    df = d.join(a, [e, p], "left").select(
        e, F.col(p).cast("int").alias(p),
        F.col("kepadatan_penduduk").cast("double").alias("kepadatan_penduduk"),
        F.col("luas_km2").cast("double").alias("luas_km2"), *_order_cols(density), *ties)
    return dedup_keep_first(nan_to_null_all(df), [e, p], order_by).drop("_area_order")


def map_names(df: DataFrame, mapping: DataFrame, name_col: str, code_col: str) -> DataFrame:
    """Attach codes to names (left join).  A name mapped to two codes
    gives one row per code (T8); NULL names never match (T7).  The mapping
    is broadcast only behind adaptive execution's run-time check of its
    measured size; beyond it the join shuffles."""
    m = mapping.select(F.col(name_col), normalize_code(code_col).alias(code_col)) \
        .where(F.col(name_col).isNotNull()).distinct()
    return df.join(m, name_col, "left")


def unmatched_names(df: DataFrame, mapping: DataFrame, name_col: str,
                    code_col: str = "kode_bps") -> DataFrame:
    """Distinct names with no code (NULL names included), as rows; a
    name mapped only to something that is no code counts as one."""
    m = mapping.where(normalize_code(code_col).isNotNull()).select(name_col)
    return df.select(name_col).distinct().join(m, name_col, "left_anti")


def rename_environment(raw: DataFrame) -> DataFrame:
    """Lower-case headers, adm2_name -> nama_env, year -> tahun."""
    df = lowercase_columns(raw)
    return (df.withColumnsRenamed({"adm2_name": "nama_env", "year": "tahun"})
            .withColumn("tahun", F.col("tahun").cast("int")))


def stage_environment(raw: DataFrame, mapping: DataFrame, cfg: PanelConfig,
                      order_by=None) -> DataFrame:
    """stg_environment: rename, map names to codes, drop unmatched, select,
    keep-first.  Not year-filtered: the health-driven panel join restricts it."""
    e, p = cfg.entity, cfg.period
    values = [*[F.col(v).cast("double").alias(v) for v in cfg.env_vars], *_order_cols(raw)]
    df = nan_to_null_all(rename_environment(raw).select("nama_env", F.col("tahun").alias(p), *values))
    # a name's rows of one period all go to the same codes, where only the
    # first is kept: the others are left before many codes share a name
    df = first_rows(df, ["nama_env", p], order_by)
    df = map_names(df, mapping, "nama_env", e).where(F.col(e).isNotNull())
    return dedup_keep_first(df.select(e, p, *cfg.env_vars, *_order_cols(df)), [e, p], order_by)


def stage_geo(centroids: DataFrame, cfg: PanelConfig) -> DataFrame:
    """stg_geo: (code, nama_geo, latitude, longitude), one row per code."""
    e = cfg.entity
    return dedup_keep_first(centroids.select(e, "nama_geo", "latitude", "longitude",
                                             *_order_cols(centroids)), [e])
