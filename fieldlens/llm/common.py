"""Small helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where it is unset: the context's own checkpoint folder, a temporary
    folder in local mode, and the warehouse on a cluster.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="corpus-")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_corpus_scratch"


def _path_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, and any
    executor may be lost afterwards.  The files go when the application ends,
    or earlier with ``drop_written``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop_path, fs = _path_fs(spark, path)
    fs.deleteOnExit(hadoop_path)
    out = spark.read.schema(df.schema).parquet(path)
    out._corpus_path = path
    return out


def drop_written(df: DataFrame) -> None:
    """Delete the files of a table that ``written`` made."""
    hadoop_path, fs = _path_fs(df.sparkSession, df._corpus_path)
    fs.delete(hadoop_path, True)


def id_fold(doc_id, folds: int):
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % folds


def with_columns(df: DataFrame, new: dict) -> DataFrame:
    """``df`` with the columns ``new`` at the end; an input column of the same
    name (names are compared without case, as Spark does) is replaced."""
    taken = {n.lower() for n in new}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[c.alias(n) for n, c in new.items()])


def append_columns(df: DataFrame, col: str, new: T.StructType, work, chars: int = 1 << 18, also: str | None = None) -> DataFrame:
    """``df`` with the columns ``new``, which replace input columns of the same
    names.  ``work`` gets the values of ``col`` of about ``chars`` bytes' worth
    of rows (one row at least) and returns a list of values for each new
    column, so that memory in a task follows the longest value, not the batch.
    With ``also`` it gets the values of that column as well.
    """
    taken = {f.name.lower() for f in new}
    kept = [f for f in df.schema if f.name.lower() not in taken]
    place = df.columns.index(col)
    places = [df.columns.index(f.name) for f in kept]
    others = df.columns.index(also) if also else None
    names = [f.name for f in [*kept, *new]]
    kinds = [_arrow_type(f.dataType) for f in new]

    def run(batches):
        for batch in batches:
            values = batch.column(place)
            is_list = pa.types.is_list(values.type) or pa.types.is_large_list(values.type)
            width = pc.multiply(pc.list_value_length(values), 4) if is_list else pc.binary_length(values)
            width = pc.fill_null(width, 0).to_numpy(zero_copy_only=False)
            run_no = np.cumsum(width) // chars
            starts = [0, *(np.flatnonzero(run_no[1:] != run_no[:-1]) + 1).tolist(), batch.num_rows]
            for a, b in zip(starts, starts[1:]):
                part = batch.slice(a, b - a)
                given = [part.column(i).to_pylist() for i in (place, others) if i is not None]
                made = work(*given) if b > a else [[] for _ in new]
                arrays = [pa.array(v, k, from_pandas=False) for v, k in zip(made, kinds)]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in places), *arrays], names=names)

    return df.mapInArrow(run, T.StructType([*kept, *new]))


def _arrow_type(kind: T.DataType) -> pa.DataType:
    """The Arrow type of the few types that operators make."""
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow_type(f.dataType)) for f in kind])
    return {T.StringType: pa.string(), T.IntegerType: pa.int32(), T.LongType: pa.int64(), T.DoubleType: pa.float64(),
            T.BooleanType: pa.bool_()}[type(kind)]


def smallest_ids(df: DataFrame, id_col: str, n: int) -> list:
    """Up to ``n`` distinct ids of ``df``, those of smallest hash: a sample
    that depends on the ids alone.  ``n`` bounds what the driver gets."""
    ids = (df.select(F.col(id_col).alias("id")).where("id IS NOT NULL")
           .groupBy("id").agg(F.xxhash64(F.lit("sample"), F.col("id")).alias("h")))
    return [r["id"] for r in ids.orderBy("h", "id").limit(n).collect()]


def among(df: DataFrame, id_col: str, ids: list) -> DataFrame:
    """Rows of ``df`` whose id is in the bounded list ``ids``."""
    spark = df.sparkSession
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}"
    few = spark.createDataFrame([(i,) for i in ids], schema)
    return df.join(F.broadcast(few), id_col, "left_semi")


# ------------------------------------------------------------- components

def connected_components(edges: DataFrame, what: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b: bigint).

    component is the smallest node reachable.  Alternating large-star and
    small-star steps; every step is a grouped minimum joined back, so a hub
    never gathers its neighbours in one task: the minimum combines before the
    shuffle and the join's skewed side can be split.  Each round is written to
    the shared folder; the driver sees a count and a checksum only.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    now = written(e, what)
    seen = _signature(now)
    while seen[0]:
        after = written(_small_star(_large_star(now)), what)
        sign = _signature(after)
        drop_written(now)
        now = after
        if sign == seen:
            break
        seen = sign
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _signature(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"),
              F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
    return r["n"], r["s"]


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    joined = e.join(least, "u")
    return (joined.select(F.explode(F.array(
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.u", "x.v").where("u <> v").distinct())
