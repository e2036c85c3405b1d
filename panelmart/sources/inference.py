"""Column types of CSV text, and cells that don't parse.

A column's type is found by one aggregate over the text: every cell is
missing, a whole number, a decimal number, a truth value or other text, and
the counts of a column climb this lattice::

    boolean    all cells are truth values
    bigint     all cells are whole numbers
    double     all cells are numbers, some decimal or some missing (or all are)
    string     anything else

That is how the source pipeline's CSV reader chooses.  Counts are combined
before the shuffle; one row of counts leaves a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from panelmart.sources.readers import INPUT_ORDER, cast_cell, input_order, lowercase_columns

# --- fixed values: cells that count as missing, as the CSV reader has them ---
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
           "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
TRUTH = ("True", "TRUE", "true", "False", "FALSE", "false")
# ------------------------------------------------------------------------------

KINDS = ("missing", "whole", "decimal", "boolean", "text")
TYPES = {"boolean": BooleanType(), "bigint": LongType(), "double": DoubleType(), "string": StringType()}

_WHOLE = r"^\s*[+-]?[0-9]+\s*$"
_DECIMAL = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def missing(cell) -> F.Column:
    return F.col(cell).isNull() | F.col(cell).isin(*MISSING)


def kind(cell) -> F.Column:
    """Kind of a text cell.  A whole number beyond 64 bits is text."""
    c = F.col(cell)
    return (F.when(missing(cell), "missing").when(c.isin(*TRUTH), "boolean")
            .when(c.rlike(_WHOLE), F.when(F.trim(c).try_cast("bigint").isNotNull(), "whole").otherwise("text"))
            .when(c.rlike(_DECIMAL), "decimal").otherwise("text"))


def read_text(spark: SparkSession, path, lowercase: bool = False, **options) -> DataFrame:
    """A CSV file with a header as text, each row with its place in the input."""
    opts = {"header": "true", "inferSchema": "false", "mode": "PERMISSIVE", **{k: str(v) for k, v in options.items()}}
    raw = spark.read.options(**opts).csv(path).withColumn(INPUT_ORDER, input_order())
    return lowercase_columns(raw) if lowercase else raw


def infer(raw: DataFrame) -> DataFrame:
    """column, type, rows and the number of cells of each kind, in one pass
    over a table of text (a row per column; no rows at all: all string)."""
    cols = [c for c in raw.columns if c != INPUT_ORDER]
    counts = [F.count_if(kind(c) == k).alias(f"{i}_{k}") for i, c in enumerate(cols) for k in KINDS]
    one = raw.agg(F.count(F.lit(1)).alias("rows"), *counts)
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.col("rows"),
                              *[F.col(f"{i}_{k}").alias(k) for k in KINDS]) for i, c in enumerate(cols)])
    n = F.col("rows")
    kind_of = (F.when(n == 0, "string").when(F.col("boolean") == n, "boolean").when(F.col("whole") == n, "bigint")
               .when(F.col("missing") + F.col("whole") + F.col("decimal") == n, "double").otherwise("string"))
    return one.select(F.inline(rows)).select("position", "column", kind_of.alias("type"), "rows", *KINDS)


def inferred_schema(raw: DataFrame) -> StructType:
    """The types as a schema (one row per column comes to the driver)."""
    return StructType([StructField(r["column"], TYPES[r["type"]]) for r in infer(raw).orderBy("position").collect()])


def typed(raw: DataFrame, schema: StructType) -> DataFrame:
    """Text cells as the inferred types; missing cells are NULL."""
    def cell(f: StructField) -> F.Column:
        c = F.trim(F.col(f.name)) if not isinstance(f.dataType, StringType) else F.col(f.name)
        if isinstance(f.dataType, BooleanType):
            c = F.lower(c) == "true"
        return F.when(~missing(f.name), c.try_cast(f.dataType)).alias(f.name)
    return raw.select(*[cell(f) for f in schema.fields], *[c for c in raw.columns if c == INPUT_ORDER])


def read_csv_inferred(spark: SparkSession, path, lowercase: bool = False, **options) -> DataFrame:
    """A CSV file with inferred types: two passes over the text."""
    raw = read_text(spark, path, lowercase, **options)
    return typed(raw, inferred_schema(raw))


def rejected_cells(raw: DataFrame, schema: StructType) -> DataFrame:
    """file, block, row, column, text, expected: the cells of the schema's
    columns that hold something and don't parse as the column's type, which
    ``conform`` turns into NULL.  No shuffle; empty where all is well."""
    bad = F.array(*[F.when(~missing(f.name) & cast_cell(f.name, f.dataType).isNull(),
                           F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("text"),
                                    F.lit(f.dataType.simpleString()).alias("expected"))) for f in schema.fields])
    place = F.col(INPUT_ORDER)
    return (raw.select(place["file"].alias("file"), place["block"].alias("block"), place["row"].alias("row"),
                       F.inline(F.array_compact(bad))))
