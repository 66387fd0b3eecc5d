"""Stored tables that SQL's write statements change in place.

A ``KeyedTable`` is a parquet folder dealt by a hash of its key into ``parts``
partitions.  ``SELECT INTO`` makes it, ``INSERT ... SELECT`` adds files,
``UPDATE ... FROM`` and ``DELETE ... USING`` rewrite the partitions in which a
row changes and no other: the changes' keys say which partitions can hold them,
a semi-join over the key and target columns of these names the partitions with a
row that differs, and those are read whole, changed, and replaced by dynamic
partition overwrite.  Files of other partitions are not written, and those that
can hold no change are not read.  The driver sees numbers of partitions, at most
``parts`` of them.

An update is idempotent: run again, it finds no row that differs and writes
nothing, so a job that was cut off is run again.  New files are written beside
the old ones and put in place when all tasks are done.  One writer at a time;
readers that started before see missing files and have to be started again.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import spare_names
from ..operators.updates import apply_by_key, one_per_key


@dataclass(frozen=True)
class KeyedTable:
    """``path``: the folder; ``schema``: the table's columns; ``keys``: the
    columns that deal it out; ``parts``: into how many partitions, fixed when the
    table is made (so many that one is rewritten in little time, such as the
    table's bytes over some GB)."""
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    parts: int = 64

    @property
    def part(self) -> str:
        """Name of the partition column, which is none of the table's."""
        return spare_names(self.schema.names, "part")[0]

    def place(self, keys: list[Column]) -> Column:
        """The partition of a key.  Strings, numbers and dates hash alike
        wherever they come from; the types have to be the table's."""
        return F.pmod(F.xxhash64(*keys), F.lit(self.parts)).cast("int")

    def _typed(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema])

    def _write(self, df: DataFrame, mode: str) -> None:
        dealt = df.withColumn(self.part, self.place([F.col(k) for k in self.keys]))
        # Rebalancing sizes the files: small partitions share a task, a large one is cut.
        (dealt.hint("rebalance", F.col(self.part)).write.mode(mode)
         .option("partitionOverwriteMode", "dynamic").partitionBy(self.part).parquet(self.path))

    # ------------------------------------------------------------ statements

    def rows(self, spark: SparkSession, with_part: bool = False) -> DataFrame:
        """SELECT: the table's rows; with their partition if asked for."""
        whole = T.StructType([*self.schema.fields, T.StructField(self.part, T.IntegerType())])
        out = spark.read.schema(whole).parquet(self.path)
        return out if with_part else out.drop(self.part)

    def create(self, df: DataFrame) -> "KeyedTable":
        """SELECT INTO: a new table; an error if the folder is there."""
        self._write(self._typed(df), "error")
        return self

    def insert(self, df: DataFrame) -> None:
        """INSERT ... SELECT, by column name; columns that ``df`` lacks are NULL."""
        lacking = {f.name: F.lit(None).cast(f.dataType) for f in self.schema if f.name not in df.columns}
        self._write(self._typed(df.withColumns(lacking)), "append")

    def update(self, changes: DataFrame, set_cols: dict[str, str]) -> list[int]:
        """UPDATE ... SET target = changes.source FROM changes WHERE the keys
        are equal, for every ``target: source``; a NULL source sets NULL.  Of
        several different changes of a key the largest by its columns in order
        counts (``one_per_key``).  Targets may not be keys.  Returns the
        numbers of the partitions that were rewritten."""
        if set(set_cols) & set(self.keys):
            raise ValueError("an update may not set the columns that deal the table out")
        spark = changes.sparkSession
        one, _ = one_per_key(changes.select(*self.keys, *dict.fromkeys(set_cols.values())), list(self.keys))
        differs = [~F.col(f"t.{t}").eqNullSafe(F.col(f"c.{s}").cast(self.schema[t].dataType)) for t, s in set_cols.items()]
        touched = self._touched(spark, changes, one, [*self.keys, *set_cols], reduce(or_, differs))
        if touched:
            old = self.rows(spark, with_part=True).where(F.col(self.part).isin(touched)).drop(self.part)
            self._write(apply_by_key(old, one, list(self.keys), set_cols), "overwrite")
        return touched

    def delete(self, gone: DataFrame) -> list[int]:
        """DELETE ... USING gone WHERE the keys are equal (a NULL key is equal
        to none).  Returns the numbers of the partitions that were rewritten."""
        spark = gone.sparkSession
        keys = gone.select(*self.keys).distinct()
        touched = self._touched(spark, gone, keys, list(self.keys), F.lit(True))
        if touched:
            old = self.rows(spark, with_part=True).where(F.col(self.part).isin(touched)).drop(self.part)
            left = old.join(keys, list(self.keys), "left_anti")
            emptied = self._emptied(left, touched)
            self._write(left, "overwrite")
            for part in emptied:  # a partition without rows is not overwritten
                _remove(spark, f"{self.path}/{self.part}={part}")
        return touched

    # --------------------------------------------------------------- helpers

    def _touched(self, spark: SparkSession, keyed: DataFrame, changes: DataFrame, columns: list[str], differs: Column) -> list[int]:
        """Partitions with a row that the changes match and ``differs`` from.
        ``keyed``: rows with the changes' keys, which may repeat."""
        typed = changes.select(*[F.col(k).cast(self.schema[k].dataType).alias(k) if k in self.keys else F.col(k)
                                 for k in changes.columns])
        c = typed.withColumn(self.part, self.place([F.col(k) for k in self.keys])).alias("c")
        place = self.place([F.col(k).cast(self.schema[k].dataType) for k in self.keys])
        places = [r[0] for r in keyed.where(reduce(and_, [F.col(k).isNotNull() for k in self.keys]))
                  .select(place.alias("p")).distinct().collect()]  # at most ``parts`` numbers
        if not places:
            return []
        t = (self.rows(spark, with_part=True).where(F.col(self.part).isin(places))
             .select(*dict.fromkeys([*columns, self.part])).alias("t"))
        same = reduce(and_, [F.col(f"t.{k}") == F.col(f"c.{k}") for k in [self.part, *self.keys]])
        hit = t.join(c, same & differs, "left_semi").select(self.part).distinct()
        return sorted(r[0] for r in hit.collect())  # at most ``parts`` numbers

    def _emptied(self, left: DataFrame, touched: list[int]) -> list[int]:
        some = left.select(self.place([F.col(k) for k in self.keys]).alias("p")).distinct().collect()
        return sorted(set(touched) - {r["p"] for r in some})


def _remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
