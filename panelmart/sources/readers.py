"""Sources (S1-S7) and sinks (K1, K3, K5): CSV, Parquet, JDBC, GeoJSON.

Every reader takes an explicit schema; nothing is inferred.  Columns are
matched by name (case-insensitively for CSV headers) and cast once.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StructType

from panelmart.functions.columns import nan_to_null_all
from panelmart.schemas import GEOJSON_FEATURE_COLLECTION


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name; two names that collide are an error."""
    lowered = [c.lower() for c in df.columns]
    if len(set(lowered)) != len(lowered):
        raise ValueError(f"column names collide when lower-cased: {df.columns}")
    return df.toDF(*lowered)


INPUT_ORDER = "_input_order"


def input_order() -> F.Column:
    """Position of a row in its input: (file, block start, row id).

    Evaluated directly on a file scan, the row id grows with the row order
    inside each split, so ordering by this struct is the files' own order
    (files by name).  Staging uses it to keep the first duplicate the way
    the source files list them."""
    return F.struct(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def cast_cell(name: str, kind: DataType) -> Column:
    """``try_cast``; a whole number may be written as a float (2019.0)."""
    if isinstance(kind, IntegralType):
        number = F.col(name).try_cast("decimal(38,6)")
        return F.when(number == F.floor(number), number).try_cast(kind)
    return F.col(name).try_cast(kind)


def conform(df: DataFrame, schema: StructType, lowercase: bool = False,
            keep=()) -> DataFrame:
    """Select the schema's columns by name and cast each once.

    Text that does not parse becomes NULL (``try_cast``); NaN becomes NULL.
    ``keep`` names extra columns passed through unchanged.
    """
    if lowercase:
        df = lowercase_columns(df)
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    out = df.select(*[
        cast_cell(f.name, f.dataType).alias(f.name) for f in schema.fields
    ], *keep)
    return nan_to_null_all(out)


def read_csv(spark: SparkSession, path, schema: StructType, lowercase: bool = False,
             keep_input_order: bool = True, **options) -> DataFrame:
    """Header CSV read as text, then conformed to ``schema`` by name.

    Reading the header as text (no inference) keeps the scan a single pass
    and lets ``lowercase=True`` accept arbitrary header case (raw
    environment files).  Splittable: large files are read by many tasks.
    With ``keep_input_order`` an ``_input_order`` column records each row's
    position in the files (see :func:`input_order`).
    """
    opts = {"header": "true", "inferSchema": "false", "mode": "PERMISSIVE"}
    opts.update({k: str(v) for k, v in options.items()})
    raw = spark.read.options(**opts).csv(path)
    if keep_input_order:
        raw = raw.withColumn(INPUT_ORDER, input_order())
    return conform(raw, schema, lowercase=lowercase,
                   keep=[INPUT_ORDER] if keep_input_order else [])


def read_parquet(spark: SparkSession, path, schema: StructType | None = None) -> DataFrame:
    """Parquet scan; column pruning and filters reach the scan."""
    df = spark.read.parquet(path)
    return conform(df, schema) if schema is not None else df


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              columns=None, partition_column: str | None = None, lower_bound=None,
              upper_bound=None, num_partitions: int | None = None,
              properties: dict | None = None, schema: StructType | None = None) -> DataFrame:
    """RDBMS scan.

    ``columns`` becomes the SELECT list (pushed into the database);
    ``partition_column`` + bounds split the read into ``num_partitions``
    parallel range queries (e.g. on the year column).
    """
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table / query")
    if partition_column and None in (lower_bound, upper_bound, num_partitions):
        raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if query is not None and not partition_column:
        r = r.option("query", query)
    elif query is not None:
        # Spark does not combine "query" with "partitionColumn": pass the
        # query as a derived table so the range split can wrap it
        r = r.option("dbtable", f"({query}) src")
    else:
        src = table
        if columns:
            src = f"(SELECT {', '.join(columns)} FROM {table}) src"
        r = r.option("dbtable", src)
    if partition_column:
        r = (r.option("partitionColumn", partition_column)
             .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
             .option("numPartitions", str(num_partitions)))
    df = r.load()
    return conform(df, schema, lowercase=True) if schema is not None else df


def read_geojson(spark: SparkSession, path, per_line: bool = False,
                 schema: StructType = GEOJSON_FEATURE_COLLECTION, split: bool = True) -> DataFrame:
    """GeoJSON features -> one row per feature.

    A FeatureCollection document is cut into byte ranges that many tasks
    read (:mod:`feature_collection`; its chunks are written to the shared folder).
    ``per_line=True`` reads one feature per line; ``split=False`` gives a
    whole document to one task and writes nothing.  Coordinates stay JSON text here; the spatial
    operator parses them per geometry type.  Output columns: ``properties``
    (struct), ``geometry`` (struct<type, coordinates>) and ``_input_order``.
    """
    if per_line:
        feat_schema = schema["features"].dataType.elementType
        df = spark.read.schema(feat_schema).json(path)
        return df.select("properties", "geometry", input_order().alias(INPUT_ORDER))
    if split:
        from panelmart.sources.feature_collection import read_feature_collection
        return read_feature_collection(spark, path, schema["features"].dataType.elementType)
    df = spark.read.schema(schema).option("multiLine", "true").json(path)
    # one document is read by one task: rebalance the exploded features so
    # the per-feature work is spread over many tasks (AQE sizes the split);
    # the input order is (file, position in the feature array)
    return (df.select(F.col("_metadata.file_path").alias("_file"),
                      F.posexplode("features").alias("_pos", "f"))
            .select("f.properties", "f.geometry",
                    F.struct(F.col("_file").alias("file"), F.lit(0).cast("long").alias("block"),
                             F.col("_pos").cast("long").alias("row")).alias(INPUT_ORDER))
            .hint("rebalance"))


# ---- sinks ----------------------------------------------------------------

def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None,
                fmt: str = "parquet") -> None:
    """K1/K3: replace or append a table (Parquet by default)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_tables(tables: dict[str, DataFrame], partition_by: dict | None = None) -> None:
    """K1: write tables to their paths (keys), some at a time: their jobs share
    the cluster, so that small tables don't wait for each other."""
    def write(item: tuple[str, DataFrame]) -> None:
        path, df = item
        cols = (partition_by or {}).get(path)
        # one open file per task at a time
        write_table(df.sortWithinPartitions(*cols) if cols else df, path, mode="overwrite", partition_by=cols)

    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(write, tables.items()))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K5: CSV export with a header row (an export, never a hand-off)."""
    df.write.mode(mode).option("header", "true").csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite",
               properties: dict | None = None) -> None:
    """K1 over JDBC: replace / append a database table."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).mode(mode)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
