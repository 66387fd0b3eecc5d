"""Schema and data-quality utilities: P20 table diff, P21 column diff with
DDL, P22 column-pair difference flags, P23 long values, P25 recent rows.

Column catalogs are DataFrames with one row per (table_name,
column_name) and attributes ordinal_position, data_type, max_length,
is_nullable, column_default -- e.g. ``information_schema.columns`` read
over JDBC, or :func:`fieldlens.sources.catalog.catalog_columns` for
Spark tables.  Diffs are joins on those keys, never driver-side sets.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import ts_literal

ATTRS = ("data_type", "is_nullable", "max_length", "column_default")
OUT_ATTRS = (("data_type", "data_type"), ("is_nullable", "is_nullable"),
             ("max_length", "max_length"), ("column_default", "default"))


def _table_sides(src: DataFrame, tgt: DataFrame) -> DataFrame:
    """table_name, in_source, in_target -- one shuffle, partial aggregation."""
    both = (src.select("table_name", F.lit(True).alias("s"), F.lit(False).alias("t"))
            .unionByName(tgt.select("table_name", F.lit(False).alias("s"), F.lit(True).alias("t"))))
    return both.groupBy("table_name").agg(F.bool_or("s").alias("in_source"), F.bool_or("t").alias("in_target"))


def schema_diff_tables(src: DataFrame, tgt: DataFrame) -> DataFrame:
    """P20: tables only in the source ('Added Tables') or only in the
    target ('Removed Tables').  Columns: Change Type, Table Name, Details."""
    g = _table_sides(src, tgt).where(F.col("in_source") != F.col("in_target"))
    return g.select(F.when(F.col("in_source"), F.lit("Added Tables")).otherwise(F.lit("Removed Tables")).alias("Change Type"),
                    F.col("table_name").alias("Table Name"), F.lit("N/A").alias("Details"))


def _truthy_num(c: Column) -> Column:
    """Python truthiness of a number (NULL and 0 are false)."""
    return c.isNotNull() & (c != F.lit(0))


def _truthy_text(c: Column) -> Column:
    """Python truthiness of a text (NULL and '' are false)."""
    return c.isNotNull() & (c != F.lit(""))


def _differs(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def schema_diff_columns(src: DataFrame, tgt: DataFrame, target_schema: str = "public") -> DataFrame:
    """For tables present on both sides, columns added (source only),
    removed (target only) and modified (any attribute differs, NULLs
    equal), each with source/target attributes as text ('' for the
    missing side) and a valid PostgreSQL statement that makes the
    target match the source."""
    both_tables = _table_sides(src, tgt).where(F.col("in_source") & F.col("in_target")).select("table_name")
    keys = ["table_name", "column_name"]
    s = src.join(both_tables, "table_name", "left_semi").select(
        *keys, F.lit(True).alias("s_present"), *[F.col(a).alias(f"s_{a}") for a in ATTRS])
    t = tgt.join(both_tables, "table_name", "left_semi").select(
        *keys, F.lit(True).alias("t_present"), *[F.col(a).alias(f"t_{a}") for a in ATTRS])
    j = s.join(t, keys, "full_outer")
    sp, tp = F.col("s_present").isNotNull(), F.col("t_present").isNotNull()
    modified = sp & tp & (_differs(F.col("s_data_type"), F.col("t_data_type"))
                          | _differs(F.col("s_is_nullable"), F.col("t_is_nullable"))
                          | _differs(F.col("s_max_length"), F.col("t_max_length"))
                          | _differs(F.col("s_column_default"), F.col("t_column_default")))
    change = F.when(sp & ~tp, F.lit("added")).when(tp & ~sp, F.lit("removed")).when(modified, F.lit("modified"))
    j = j.withColumn("change", change).where(F.col("change").isNotNull())

    tbl = F.concat(F.lit(f"ALTER TABLE {target_schema}."), F.col("table_name"))
    col = F.col("column_name")
    s_type = F.concat(F.col("s_data_type"),
                      F.when(_truthy_num(F.col("s_max_length")),
                             F.concat(F.lit("("), F.col("s_max_length").cast("string"), F.lit(")"))).otherwise(F.lit("")))
    not_null = F.lower(F.col("s_is_nullable")) == F.lit("no")
    add_sql = F.concat(tbl, F.lit(" ADD COLUMN "), col, F.lit(" "), s_type,
                       F.when(not_null, F.lit(" NOT NULL")).otherwise(F.lit(" NULL")),
                       F.when(_truthy_text(F.col("s_column_default")),
                              F.concat(F.lit(" DEFAULT "), F.col("s_column_default"))).otherwise(F.lit("")),
                       F.lit(";"))
    drop_sql = F.concat(tbl, F.lit(" DROP COLUMN "), col, F.lit(";"))
    alter = F.concat(F.lit("ALTER COLUMN "), col)
    actions = F.array_compact(F.array(
        F.when(_differs(F.col("s_data_type"), F.col("t_data_type")) | _differs(F.col("s_max_length"), F.col("t_max_length")),
               F.concat(alter, F.lit(" TYPE "), s_type)),
        F.when(_differs(F.col("s_is_nullable"), F.col("t_is_nullable")),
               F.concat(alter, F.when(not_null, F.lit(" SET NOT NULL")).otherwise(F.lit(" DROP NOT NULL")))),
        F.when(_differs(F.col("s_column_default"), F.col("t_column_default")),
               F.concat(alter, F.when(F.col("s_column_default").isNotNull(),
                                      F.concat(F.lit(" SET DEFAULT "), F.col("s_column_default")))
                        .otherwise(F.lit(" DROP DEFAULT")))),
    ))
    modify_sql = F.concat(tbl, F.lit(" "), F.array_join(actions, ", "), F.lit(";"))
    sql = (F.when(F.col("change") == "added", add_sql).when(F.col("change") == "removed", drop_sql)
           .otherwise(modify_sql))

    def side(prefix, attr, present):
        return F.when(present, F.col(f"{prefix}_{attr}").cast("string")).otherwise(F.lit(""))

    attr_cols = []
    for a, name in OUT_ATTRS:
        attr_cols += [side("s", a, sp).alias(f"source_{name}"), side("t", a, tp).alias(f"target_{name}")]
    return j.select(F.col("table_name").alias("table"), F.col("column_name").alias("column"), "change",
                    *attr_cols, sql.alias("sql_query"))


# The column pairs the two reference highlighters compare.
DATATYPE_SHEET_PAIRS = [
    ("dev_datatype", "qa_datatype"),
    ("prod_datatype", "qa_datatype"),
    ("staging_datatype", "qa_datatype"),
    ("dev_datatype", "prod_datatype"),
    ("staging_datatype", "prod_datatype"),
]
SCHEMA_DIFF_PAIRS = [
    ("source_data_type", "target_data_type"),
    ("source_is_nullable", "target_is_nullable"),
    ("source_max_length", "target_max_length"),
    ("source_default", "target_default"),
]


def pair_diff_flags(df: DataFrame, pairs, nulls: str = "differ") -> DataFrame:
    """The input rows plus, per pair (a, b), ``diff_<a>__<b>`` (the two
    cells differ) and, per column in any pair, ``highlight_<c>`` (any of
    its pairs differs).  ``nulls='differ'``: an empty cell differs from
    everything, itself included (spreadsheet data read as NaN);
    ``nulls='equal'``: NULL-safe comparison."""
    if nulls not in ("differ", "equal"):
        raise ValueError("nulls must be 'differ' or 'equal'")
    flags, per_col = [], {}
    for a, b in pairs:
        ca, cb = F.col(f"`{a}`"), F.col(f"`{b}`")
        d = ~F.coalesce(ca == cb, F.lit(False)) if nulls == "differ" else ~ca.eqNullSafe(cb)
        name = f"diff_{a}__{b}"
        flags.append(d.alias(name))
        for c in (a, b):
            per_col.setdefault(c, []).append(name)
    out = df.select("*", *flags)
    hl = []
    for c, names in per_col.items():
        expr = F.col(names[0])
        for n in names[1:]:
            expr = expr | F.col(n)
        hl.append(expr.alias(f"highlight_{c}"))
    return out.select("*", *hl)


def long_values(df: DataFrame, n: int = 30) -> DataFrame:
    """Same rows and columns; a cell is kept only where its text form
    is longer than ``n`` characters, else NULL (NULL is never long)."""
    return df.select(*[F.when(F.length(F.col(f"`{c}`").cast("string")) > n, F.col(f"`{c}`")).alias(c)
                       for c in df.columns])


def long_value_findings(df: DataFrame, id_cols, n: int = 30) -> DataFrame:
    """P23 as a findings list: (id columns, column_name, value) for every
    cell whose text is longer than ``n``."""
    value_cols = [c for c in df.columns if c not in id_cols]
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value"))
                                for c in value_cols])).alias("cell")
    return (df.select(*id_cols, cells).select(*id_cols, "cell.column_name", "cell.value")
            .where(F.length("value") > n))


def recent_rows(df: DataFrame, ts_col: str, as_of, days: int = 7) -> DataFrame:
    """P25: rows whose ``ts_col`` is at or after ``as_of - days`` (later
    rows included).  A plain comparison with a literal, so it is pushed
    into the parquet scan."""
    if not isinstance(as_of, dt.datetime):
        as_of = dt.datetime.combine(as_of, dt.time())
    bound = as_of - dt.timedelta(days=days)
    col_type = df.schema[ts_col].dataType
    if isinstance(col_type, T.DateType) and bound.time() != dt.time():
        bound += dt.timedelta(days=1)  # a date is its midnight
    lit = ts_literal(bound) if isinstance(col_type, T.TimestampNTZType) else F.lit(bound).cast(col_type)
    return df.where(F.col(ts_col) >= lit)
