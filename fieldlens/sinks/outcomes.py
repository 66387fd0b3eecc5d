"""Accepted rows, rejects and their counts from one pass.

A procedure that raises on a bad row becomes a table of all rows with a
``reason``.  Writing it partitioned by the outcome makes the accepted rows and the
rejects two tables at once, and the counts are observed while the rows go by, so
the input is read once and the caller can decide (fail, alert, go on) before
anything reads the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import spare_names

ACCEPTED, REJECTED = "accepted", "rejected"


def write_outcomes(df: DataFrame, path: str, reason: str = "reason") -> dict[str, int]:
    """Write ``df`` under ``path`` (replaced), a folder each for the rows with and
    without a reason; returns the counts of both.  A write that is run again
    gives the same folders."""
    outcome, = spare_names(df.columns, "outcome")
    kind = F.when(F.col(reason).isNull(), ACCEPTED).otherwise(REJECTED)
    seen = Observation()
    counted = df.withColumn(outcome, kind).observe(seen, *[
        F.count_if(F.col(outcome) == k).alias(k) for k in (ACCEPTED, REJECTED)])
    counted.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(outcome).parquet(path)
    return dict(seen.get)


def read_outcomes(spark: SparkSession, path: str, df: DataFrame, kind: str) -> DataFrame:
    """The rows of one outcome, with the columns of the ``df`` that was written;
    the other folder is not read."""
    outcome, = spare_names(df.columns, "outcome")
    whole = T.StructType([*df.schema.fields, T.StructField(outcome, T.StringType())])
    return spark.read.schema(whole).parquet(path).where(F.col(outcome) == kind).drop(outcome)
