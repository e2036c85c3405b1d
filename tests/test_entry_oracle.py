"""Driver contract: entry smoke, one oracle SQL per query, and a sample of
queries compared with DuckDB on the smallest test tables."""
import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["nama_kabupaten_kota", "tahun", "incidence_rate", "yoy_growth_rate",
                          "rainfall_zscore", "surge_flag"]


def test_every_query_has_oracle_sql():
    from panelmart.plans import catalog
    assert set(catalog.queries()) <= set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("name", ["surge_trend", "fact_panel", "vulnerability_map",
                                  "run_quality_report", "centroids", "check_min_rows"])
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(ocols)
    a = sorted(repr([_norm(r[c]) for c in order]) for r in df.collect())
    b = sorted(repr([_norm(dict(zip(ocols, r))[c]) for c in order]) for r in res.fetchall())
    assert a == b
