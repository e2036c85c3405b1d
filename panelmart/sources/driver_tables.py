"""Raw panel sources derived from the TPC-H-style test tables.

The panel roles are played by the order / line-item tables (see README):

* entity: a customer nation (grain "nation", code 3200 + nation key) or a
  customer (grain "customer", code = customer key);
* period: the calendar year of the order date;
* cases = number of orders, density = total order price / 100000,
  area = 100 + 10 x nation key;
* environment, keyed by *name* (like the satellite table): rainfall =
  sum(quantity), lst = avg(extended price) / 1000, ndvi = 0.5 + 50 x
  (avg(discount) - 0.05), ndmi = avg(tax) x 10, over the year of the ship
  date, by supplier nation (grain "nation", nations 17 and 18 left out so
  the donors have work) or by the ordering customer (grain "customer");
* geometry: one GeoJSON-shaped feature per entity built from its columns
  (square with a hole, a second square for some), so the centroid job has
  real polygons to work on.

Aggregations are pre-aggregated before their joins (orders by (customer,
year) before the customer join, line items by (supplier, year) before the
supplier join and by (order, year) before the order join): fewer rows cross
the shuffle and a hot customer / supplier / order collapses map-side.
Only the 25-row nation table is broadcast by hint; every other join side is
left to the optimizer's size checks.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmart.config import PanelConfig

# --- fixed values of the test-table panel ----------------------------------
# year range 1996-2000, event years 1998 and 1999; donors 3217 <- 3204 and
# 3218 <- 3207 (nation grain); supplier nations 17 and 18 carry no
# environment data; 25 nations expected
NATION_YEAR_START, NATION_YEAR_END = 1996, 2000
NATION_EVENT_PERIODS = (1998, 1999)
NATION_DONORS = (("3217", "3204"), ("3218", "3207"))
NATION_CODE_BASE = 3200
NATIONS_WITHOUT_ENV = (17, 18)
NATION_COUNT = 25
CUSTOMER_DONORS = (("1", "2"), ("3", "4"))
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nation_config(**kw) -> PanelConfig:
    base = PanelConfig(year_start=NATION_YEAR_START, year_end=NATION_YEAR_END,
                       event_periods=NATION_EVENT_PERIODS, donors=NATION_DONORS,
                       expected_entities=NATION_COUNT, on_duplicate_edges="collapse")
    return base.with_(**kw)


def customer_config(**kw) -> PanelConfig:
    base = PanelConfig(year_start=NATION_YEAR_START, year_end=NATION_YEAR_END,
                       event_periods=NATION_EVENT_PERIODS, donors=CUSTOMER_DONORS,
                       expected_entities=None, on_duplicate_edges="collapse")
    return base.with_(**kw)


@dataclass
class RawSources:
    health: DataFrame        # kode_bps, nama_kabupaten_kota, tahun, jumlah_kasusDBD
    density: DataFrame       # kode_bps, tahun, kepadatan_penduduk
    area: DataFrame          # kode_bps, tahun, luas_km2
    environment: DataFrame   # ADM2_NAME, Year, Rainfall_Annual, LST_Celsius, NDVI, NDMI
    mapping: DataFrame       # kode_bps, nama_env
    features: DataFrame      # properties{ID_KAB, KABKOT}, geometry{type, coordinates}
    shared: tuple = ()       # upstream aggregates read by several sources


def money(c):
    """Cent amounts are summed exactly as decimals (no float drift)."""
    return F.col(c).cast("decimal(12,2)")


def _env_sums(q, price, disc, tax):
    return [F.sum(money(q)).alias("q"), F.sum(money(price)).alias("pr"),
            F.sum(money(disc)).alias("di"), F.sum(money(tax)).alias("tx"),
            F.count(F.lit(1)).alias("n")]


def _env_cols(q, price, disc, tax, n) -> list:
    d = lambda c: F.col(c).cast("double")
    return [d(q).alias("Rainfall_Annual"),
            (d(price) / F.col(n) / 1000.0).alias("LST_Celsius"),
            (F.lit(0.5) + F.lit(50.0) * (d(disc) / F.col(n) - F.lit(0.05))).alias("NDVI"),
            (d(tax) / F.col(n) * 10.0).alias("NDMI")]


def _square(x, y, s):
    """Closed counter-clockwise ring of a square (lower-left x, y; side s)."""
    pts = [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]
    return F.array(*[F.array(px.cast("double"), py.cast("double")) for px, py in pts])


def _hole(x, y, s):
    """Clockwise square hole of side s/4 at (x + s/4, y + s/4)."""
    hx, hy, hs = x + s / 4.0, y + s / 4.0, s / 4.0
    pts = [(hx, hy), (hx, hy + hs), (hx + hs, hy + hs), (hx + hs, hy), (hx, hy)]
    return F.array(*[F.array(px.cast("double"), py.cast("double")) for px, py in pts])


def geo_features(df: DataFrame, id_col, name_col, x, y, s, multi) -> DataFrame:
    """One GeoJSON-shaped feature per row: a square of side ``s`` at (x, y)
    with a square hole; where ``multi`` a second square of side s/2 at
    (x + 2s, y) makes it a MultiPolygon.  Coordinates as JSON text."""
    poly = F.array(_square(x, y, s), _hole(x, y, s))
    second = F.array(_square(x + s * 2.0, y, s / 2.0))
    coords = F.when(multi, F.to_json(F.array(poly, second))).otherwise(F.to_json(poly))
    return df.select(
        F.struct(id_col.cast("string").alias("ID_KAB"), name_col.alias("KABKOT")).alias("properties"),
        F.struct(F.when(multi, F.lit("MultiPolygon")).otherwise(F.lit("Polygon")).alias("type"),
                 coords.alias("coordinates")).alias("geometry"))


def nation_sources(spark: SparkSession, sf_dir: str) -> RawSources:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    code = (F.lit(NATION_CODE_BASE) + F.col("n_nationkey")).cast("int")
    # pre-aggregate orders per (customer, year) before the customer join:
    # a customer with a huge share of the orders collapses map-side
    per_cy = orders.groupBy("o_custkey", F.year("o_orderdate").alias("tahun")).agg(
        F.count(F.lit(1)).alias("cases"), F.sum(money("o_totalprice")).alias("tp"))
    by_nation_year = (per_cy.join(customer, per_cy.o_custkey == customer.c_custkey)
                      .groupBy(F.col("c_nationkey").alias("n_nationkey"), "tahun")
                      .agg(F.sum("cases").alias("cases"), F.sum("tp").alias("tp"))
                      .join(F.broadcast(nation), "n_nationkey"))
    health = by_nation_year.select(code.alias("kode_bps"), F.col("n_name").alias("nama_kabupaten_kota"),
                                   "tahun", F.col("cases").cast("int").alias("jumlah_kasusDBD"))
    density = by_nation_year.select(code.alias("kode_bps"), "tahun",
                                    (F.col("tp").cast("double") / 100000.0).alias("kepadatan_penduduk"))
    area = by_nation_year.select(code.alias("kode_bps"), "tahun",
                                 (F.lit(100.0) + F.lit(10.0) * F.col("n_nationkey")).alias("luas_km2"))
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # pre-aggregate line items per (supplier, year) before the supplier join
    per_supp = li.groupBy("l_suppkey", F.year("l_shipdate").alias("Year")).agg(
        *_env_sums("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    env = (per_supp.join(supplier.where(~F.col("s_nationkey").isin(list(NATIONS_WITHOUT_ENV))),
                         per_supp.l_suppkey == supplier.s_suppkey)
           .groupBy("s_nationkey", "Year")
           .agg(F.sum("q").alias("q"), F.sum("pr").alias("pr"), F.sum("di").alias("di"),
                F.sum("tx").alias("tx"), F.sum("n").alias("n"))
           .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
           .select(F.col("n_name").alias("ADM2_NAME"), "Year", *_env_cols("q", "pr", "di", "tx", "n")))
    mapping = nation.select(code.alias("kode_bps"), F.col("n_name").alias("nama_env"))
    nk, rk = F.col("n_nationkey"), F.col("n_regionkey")
    features = geo_features(nation, code, F.col("n_name"), nk.cast("double"), rk.cast("double"),
                            F.lit(1.0), rk >= 3)
    return RawSources(health, density, area, env, mapping, features, shared=(by_nation_year,))


def customer_sources(spark: SparkSession, sf_dir: str) -> RawSources:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                                   "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                       "c_acctbal")
    per_cy = (orders.groupBy("o_custkey", F.year("o_orderdate").alias("tahun"))
              .agg(F.count(F.lit(1)).alias("cases"), F.sum(money("o_totalprice")).alias("tp"))
              .join(customer, F.col("o_custkey") == F.col("c_custkey")))
    code = F.col("c_custkey")
    health = per_cy.select(code.alias("kode_bps"), F.col("c_name").alias("nama_kabupaten_kota"),
                           "tahun", F.col("cases").cast("int").alias("jumlah_kasusDBD"))
    density = per_cy.select(code.alias("kode_bps"), "tahun",
                            (F.col("tp").cast("double") / 100000.0).alias("kepadatan_penduduk"))
    area = per_cy.select(code.alias("kode_bps"), "tahun",
                         (F.lit(100.0) + F.lit(10.0) * F.col("c_nationkey")).alias("luas_km2"))
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    # pre-aggregate line items per (order, year) before the order join
    per_order = li.groupBy("l_orderkey", F.year("l_shipdate").alias("Year")).agg(
        *_env_sums("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    env = (per_order.join(orders.select("o_orderkey", "o_custkey"),
                          F.col("l_orderkey") == F.col("o_orderkey"))
           .groupBy("o_custkey", "Year")
           .agg(F.sum("q").alias("q"), F.sum("pr").alias("pr"), F.sum("di").alias("di"),
                F.sum("tx").alias("tx"), F.sum("n").alias("n"))
           .join(customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
           .select(F.col("c_name").alias("ADM2_NAME"), "Year", *_env_cols("q", "pr", "di", "tx", "n")))
    mapping = customer.select(code.alias("kode_bps"), F.col("c_name").alias("nama_env"))
    # few bytes a row make long texts and much work per row: the rows are dealt
    # over tasks, however few the table's files and row groups are
    features = geo_features(customer.hint("rebalance"), code, F.col("c_name"), F.col("c_nationkey").cast("double"),
                            F.col("c_acctbal") / 1000.0, F.lit(1.0) + F.col("c_nationkey") / 5.0,
                            F.col("c_acctbal") >= 5000)
    return RawSources(health, density, area, env, mapping, features, shared=(per_cy,))


def sources(spark: SparkSession, sf_dir: str, grain: str = "nation") -> RawSources:
    if grain == "nation":
        return nation_sources(spark, sf_dir)
    if grain == "customer":
        return customer_sources(spark, sf_dir)
    raise ValueError(f"unknown grain {grain!r}")


def config_for(grain: str, **kw) -> PanelConfig:
    return nation_config(**kw) if grain == "nation" else customer_config(**kw)


#: Sources that are landed together: those of a group read the shared aggregates.
_GROUPS = (("health", "density", "area"), ("environment",), ("mapping",), ("features",))


def land(spark: SparkSession, raw: RawSources, path: str, names=None) -> RawSources | dict[str, DataFrame]:
    """Write every raw source as a Parquet table under ``path`` and return
    readers of them (the one-off source load before the batch job).  Of only
    those in ``names``, the readers by name."""
    out = {}
    wanted = names or [name for group in _GROUPS for name in group]
    # aggregates shared by several sources are kept for the duration of the
    # landing only (computed once, released right after)
    shared = raw.shared if set(wanted) & set(_GROUPS[0]) else ()
    for df in shared:
        df.persist()
    try:
        for name in wanted:
            df = getattr(raw, name)
            df.write.mode("overwrite").parquet(f"{path}/{name}")
            out[name] = spark.read.schema(df.schema).parquet(f"{path}/{name}")
    finally:
        for df in shared:
            df.unpersist()
    return out if names else RawSources(**out)


class LandedSources(RawSources):
    """The fields of :class:`RawSources`, each landed once, when it is first
    read: a query waits only for the sources that it works on.  Fields given
    as ``tables`` (``dataclasses.replace``) are taken as they are."""

    def __init__(self, spark: SparkSession | None = None, raw: RawSources | None = None, path: str = "", **tables):
        self._spark, self._raw, self._path = spark, raw, path
        self._locks = {group: threading.Lock() for group in _GROUPS}
        vars(self).update(tables)

    def __getattr__(self, name: str) -> DataFrame:
        group = next((g for g in _GROUPS if name in g), None)
        if group is None:
            raise AttributeError(name)
        with self._locks[group]:  # one landing per source, also when queries run in threads
            if name not in vars(self):
                vars(self).update(land(self._spark, self._raw, self._path, group))
            return vars(self)[name]

    def land_all(self) -> None:
        for group in _GROUPS:
            getattr(self, group[0])


_LANDED: dict[tuple, LandedSources] = {}
_LANDING_LOCK = threading.Lock()


def landed_sources(spark: SparkSession, sf_dir: str, grain: str = "nation") -> LandedSources:
    """Raw sources derived from the test tables, each landed once per Spark
    application in the shared folder (``spark.checkpoint.dir``) and read
    from there by every later query of the application."""
    from panelmart.session import app_id, shared_dir
    key = (app_id(spark), sf_dir.rstrip("/"), grain)
    with _LANDING_LOCK:
        if key not in _LANDED:
            import hashlib
            tag = hashlib.sha1("|".join(key).encode()).hexdigest()[:16]
            path = shared_dir(spark, f"ingest/{grain}-{tag}")
            _LANDED[key] = LandedSources(spark, sources(spark, sf_dir, grain), path)
        return _LANDED[key]
