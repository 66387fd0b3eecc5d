"""A table as one JSON document, written by all tasks at once.

``json_agg`` makes one value of all rows.  Here the rows are ranged over the
tasks by their order and each task writes its part as text; the parts, put one
behind the other by name, are one valid JSON array.  What stands before a row
follows from its place alone: the first row of the first part (ranges begin with
a sampled row, so the first part has one) gets the opening bracket, all others a
comma, and the closing bracket is a row of its own that sorts last.  Nothing is
gathered, and no task waits for another's number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import spare_names


def json_array_lines(df: DataFrame, order: list[str], parts: int | None = None, col: str = "line") -> DataFrame:
    """The document's lines, ordered over partitions and within.  Rows are
    ordered by ``order`` (NULL first) and then by their JSON text, so the
    document depends on the rows alone."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last, json = spare_names(order, "last", "json")
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    rows = df.select(F.lit(0).alias(last), *[F.col(f"`{c}`") for c in order], text.alias(json))
    end = df.sparkSession.range(1).select(F.lit(1).alias(last), *[
        F.lit(None).cast(df.schema[c].dataType).alias(c) for c in order], F.lit("]").alias(json))
    by = [last, *[F.col(f"`{c}`") for c in order], json]
    placed = (rows.unionByName(end).repartitionByRange(parts, *by).sortWithinPartitions(*by)
              .withColumn("place", F.monotonically_increasing_id()))
    before = F.when(F.col("place") == 0, "[").when(F.col(last) == 1, "").otherwise(",")
    return placed.select(F.concat(before, F.col(json)).alias(col))


def write_json_array(df: DataFrame, path: str, order: list[str], parts: int | None = None) -> None:
    """Write ``df`` as text parts under ``path`` (new or replaced); joined by
    name they are one JSON array of its rows."""
    json_array_lines(df, order, parts).write.mode("overwrite").text(path)


def read_json_array(spark: SparkSession, path: str, col: str = "json") -> DataFrame:
    """The array's elements as rows again (JSON text in ``col``)."""
    bare = F.regexp_replace("value", r"^[\[,]", "")
    return spark.read.text(path).where("value NOT IN (']', '[]')").select(bare.alias(col))
