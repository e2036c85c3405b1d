import math

from pyspark.sql import functions as F

from panelmart.functions.columns import ieee_div, nan_to_null, normalize_code


def test_ieee_div_zero_divisors(spark):
    df = spark.createDataFrame([(5.0, 0.0), (0.0, 0.0), (-5.0, 0.0), (None, 2.0), (2.0, None),
                                (6.0, 3.0)], "a double, b double")
    got = [r[0] for r in df.select(ieee_div("a", "b")).collect()]
    assert got[0] == math.inf and got[2] == -math.inf
    assert got[1] is None and got[3] is None and got[4] is None
    assert got[5] == 2.0


def test_ieee_div_inf_over_inf_is_null(spark):
    df = spark.createDataFrame([(math.inf, math.inf)], "a double, b double")
    assert df.select(ieee_div("a", "b")).first()[0] is None


def test_normalize_code_t6(spark):
    df = spark.createDataFrame([(None,), ("3204.0",), ("nan",), ("None",), ("",), (" 3217 ",)],
                               "c string")
    got = [r[0] for r in df.select(normalize_code("c")).collect()]
    assert got == [None, "3204", None, None, None, "3217"]
    d = spark.createDataFrame([(None,), (3204.0,), (float("nan"),), (3204.9,)], "c double")
    assert [r[0] for r in d.select(normalize_code("c")).collect()] == [None, "3204", None, "3204"]
    codes = spark.createDataFrame([("ID-A1",), ("9007199254740993",), ("-7.0",), ("32x",)], "c string")
    assert [r[0] for r in codes.select(normalize_code("c")).collect()] == ["ID-A1", "9007199254740993", "-7", "32x"]
    i = spark.createDataFrame([(3204,)], "c int")
    assert i.select(normalize_code("c")).first()[0] == "3204"


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r[0] for r in df.select(nan_to_null(F.col("x"))).collect()] == [None, 1.0]


def test_config_validation():
    import pytest

    from panelmart.config import PanelConfig
    for bad in (dict(year_start=2025, year_end=2024), dict(on_duplicate_edges="drop"),
                dict(tier_guard="x"), dict(min_row_fraction=1.5),
                dict(donors=(("1", "2"), ("1", "3")))):
        with pytest.raises(ValueError):
            PanelConfig(**bad)
    assert PanelConfig().n_years == 6
