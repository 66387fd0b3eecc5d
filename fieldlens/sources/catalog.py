"""Column catalogs (the input of the schema diffs) and database reads.

``catalog_columns`` describes Spark DataFrames/tables in the shape of
``information_schema.columns`` and ``spark_catalog_columns`` every table
of a catalog database; ``jdbc_columns`` reads the real
``information_schema.columns`` of a PostgreSQL schema, and ``jdbc_table``
reads a table or query with a partitioned JDBC scan.  No JDBC driver jar
ships with this repository; the functions only need one on the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CATALOG_SCHEMA = ("table_name string, column_name string, ordinal_position int, data_type string, "
                  "max_length int, is_nullable string, column_default string")

_PG_NAMES = {
    T.LongType: "int8", T.IntegerType: "int4", T.ShortType: "int2", T.DoubleType: "float8",
    T.FloatType: "float4", T.StringType: "text", T.BooleanType: "bool", T.DateType: "date",
    T.TimestampType: "timestamptz", T.TimestampNTZType: "timestamp", T.BinaryType: "bytea",
}


def _type_name(dt: T.DataType) -> str:
    if isinstance(dt, T.DecimalType):
        return "numeric"
    if isinstance(dt, (T.VarcharType, T.CharType)):
        return "varchar" if isinstance(dt, T.VarcharType) else "bpchar"
    for k, v in _PG_NAMES.items():
        if isinstance(dt, k):
            return v
    return dt.simpleString()


def catalog_columns(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per (table, column) from DataFrame schemas (metadata only;
    no data is read)."""
    rows = []
    for name, df in tables.items():
        for i, f in enumerate(df.schema.fields, start=1):
            length = f.dataType.length if isinstance(f.dataType, (T.VarcharType, T.CharType)) else None
            rows.append((name, f.name, i, _type_name(f.dataType), length, "YES" if f.nullable else "NO", None))
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def spark_catalog_columns(spark: SparkSession, database: str, include_temp_views: bool = False) -> DataFrame:
    """Column catalog of every table in a Spark catalog database (the Spark
    counterpart of one schema's ``information_schema.columns``): compare
    two databases with P20/P21.  Only table metadata is read."""
    tables = {}
    for t in spark.catalog.listTables(database):
        if t.isTemporary and not include_temp_views:
            continue
        name = t.name if t.isTemporary else f"{database}.{t.name}"
        tables[t.name] = spark.table(name)
    return catalog_columns(spark, tables)


def jdbc_columns(spark: SparkSession, url: str, schema_name: str, properties: dict) -> DataFrame:
    """``information_schema.columns`` of one database schema (query pushed to the database)."""
    q = ("SELECT table_name, column_name, ordinal_position, udt_name AS data_type, "
         "character_maximum_length AS max_length, is_nullable, column_default "
         "FROM information_schema.columns WHERE table_schema = '" + schema_name.replace("'", "''") + "'")
    return spark.read.jdbc(url, f"({q}) c", properties=properties)


def jdbc_table(spark: SparkSession, url: str, table: str, properties: dict, partition_column: str | None = None,
               lower: int | None = None, upper: int | None = None, num_partitions: int = 64) -> DataFrame:
    """A database table (or ``(query) alias``) read in parallel ranges of a numeric column."""
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions, properties=properties)
