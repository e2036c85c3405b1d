"""Inferred types against the common CSV reader's, and rejected cells."""
import io

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from panelmart.sources import inference, readers

CELLS = ["1", "-7", "+3", "007", "2.5", "1e3", ".5", "5.", "-inf", "Infinity", "", "NA", "n/a", "None", "null", "True",
         "false", "TRUE", "x", "1,2", "12a", "1 2", "0x10", "9223372036854775807", "2019.0", "1_000", "--1", "e5", "NAN"]
NAMES = {"int64": "bigint", "float64": "double", "bool": "boolean"}


def csv(columns):
    n = max(map(len, columns.values()))
    quote = lambda x: '"' + x.replace('"', '""') + '"' if x else ""
    rows = [",".join(["r", *[quote(c[i] if i < len(c) else "") for c in columns.values()]]) for i in range(n)]
    return "\n".join([",".join(["id", *columns]), *rows]) + "\n"


def write(root, text, name="a.csv"):
    with open(f"{root}/{name}", "w", encoding="utf-8") as f:
        f.write(text)
    return f"{root}/{name}"


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(CELLS), min_size=3, max_size=3), min_size=6, max_size=6),
       st.lists(st.lists(st.sampled_from(["1", "2", "2.5", "", "True", "false"]), min_size=3, max_size=3), min_size=6, max_size=6))
def test_types_are_the_csv_readers(spark, tmp_path_factory, wild, tame):
    columns = {f"c{i}": c for i, c in enumerate([*wild, *tame])}
    path = write(tmp_path_factory.mktemp("csv"), csv(columns))
    want = {c: NAMES.get(str(t), "string") for c, t in pd.read_csv(path).dtypes.items()}
    got = {r["column"]: r["type"] for r in inference.infer(inference.read_text(spark, path)).collect()}
    assert got == want


def test_rows_are_typed(spark, tmp_root):
    text = "A,b,c,d,e\n1,1,2.5,True,x\n-2,,inf,false,NA\n 3 ,7,n/a,TRUE,\" y\"\n"
    df = inference.read_csv_inferred(spark, write(tmp_root, text), lowercase=True)
    assert [t for _, t in df.drop(readers.INPUT_ORDER).dtypes] == ["bigint", "double", "double", "boolean", "string"]
    rows = [tuple(r)[:5] for r in df.orderBy(readers.INPUT_ORDER).collect()]
    assert rows == [(1, 1.0, 2.5, True, "x"), (-2, None, float("inf"), False, None), (3, 7.0, None, True, " y")]
    want = pd.read_csv(io.StringIO(text))
    assert [want.A.tolist(), want.b.dropna().tolist(), want.c.dropna().tolist()] == [[1, -2, 3], [1.0, 7.0], [2.5, float("inf")]]


def test_counts_and_empty_file(spark, tmp_root):
    raw = inference.read_text(spark, write(tmp_root, "a,b\n1,\n2.0,yes\nNA,True\n"))
    got = [tuple(r) for r in inference.infer(raw).orderBy("position").collect()]
    assert got == [(0, "a", "double", 3, 1, 1, 1, 0, 0), (1, "b", "string", 3, 1, 0, 0, 1, 1)]
    empty = inference.read_text(spark, write(tmp_root, "a,b\n", "empty.csv"))
    assert [r["type"] for r in inference.infer(empty).collect()] == ["string", "string"]


def test_rejected_cells_say_where(spark, tmp_root):
    schema = StructType([StructField("k", StringType()), StructField("n", IntegerType()), StructField("v", DoubleType()),
                         StructField("big", LongType())])
    text = "k,n,v,big,other\na,1,1.5,5,zz\nb,x,oops,9223372036854775808,zz\nc,2.5,,NA,zz\nd,2019.0,nan,7.0,zz\ne,99999999999,1e3,1e30,zz\n"
    path = write(tmp_root, text)
    raw = inference.read_text(spark, path)
    got = [(r["column"], r["text"], r["expected"]) for r in inference.rejected_cells(raw, schema).orderBy("row", "column").collect()]
    assert got == [("big", "9223372036854775808", "bigint"), ("n", "x", "int"), ("v", "oops", "double"), ("n", "2.5", "int"),
                   ("big", "1e30", "bigint"), ("n", "99999999999", "int")]
    rows = {r["row"] for r in inference.rejected_cells(raw, schema).collect()}
    assert len(rows) == 3 and all(r["file"].endswith("a.csv") for r in inference.rejected_cells(raw, schema).collect())
    good = readers.read_csv(spark, path, schema).drop(readers.INPUT_ORDER).collect()
    assert [tuple(r) for r in good][1] == ("b", None, None, None)
    assert inference.rejected_cells(inference.read_text(spark, write(tmp_root, "k,n,v,big\na,1,1,1\n", "b.csv")), schema).count() == 0


def test_missing_column_is_an_error(spark, tmp_root):
    schema = StructType([StructField("absent", IntegerType())])
    with pytest.raises(Exception, match="absent"):
        inference.rejected_cells(inference.read_text(spark, write(tmp_root, "k\n1\n")), schema)
