"""Post-image updates: ``UPDATE ... FROM`` as a pure DataFrame transform.

Parquet tables cannot be updated in place, so an update is a function
from (base, changes) to the new image of base, written to a new path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import left_join, spare_names


def one_per_key(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """One row per key, and the keys that had several different rows.

    The winner is the row that is largest over the other columns in their order
    (NULL lowest); identical rows are one.  One grouped aggregate (partial on
    the map side, so a hot key costs one row per partition in the shuffle); no
    window over the key.
    """
    others = F.struct(*[c for c in df.columns if c not in keys])
    row, least = spare_names(keys, "row", "least")
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"), F.max(others).alias(row), F.min(others).alias(least))
    several = ~F.col(row).eqNullSafe(F.col(least))
    return g.select(*keys, f"{row}.*"), g.where(several).select(*keys, "copies")


def apply_by_key(base: DataFrame, changes: DataFrame, keys: list[str],
                 set_cols: dict[str, str]) -> DataFrame:
    """Post-image of ``base``: for rows with a matching key in ``changes``
    (which must be unique per key), ``base[target] = changes[source]`` for
    every ``target: source`` in ``set_cols`` -- NULL included.  Other rows
    are unchanged.  Column order and types of ``base`` are kept.
    """
    names = spare_names(base.columns, *(f"key_{k}" for k in keys), *(f"new_{c}" for c in set_cols), "matched")
    key_of, new_of, matched = dict(zip(keys, names)), dict(zip(set_cols, names[len(keys):])), names[-1]
    ch = changes.select(*[F.col(k).alias(key_of[k]) for k in keys],
                        *[F.col(src).alias(new_of[tgt]) for tgt, src in set_cols.items()],
                        F.lit(True).alias(matched))
    j = left_join(base, ch, [(k, key_of[k]) for k in keys])
    return j.select(*[F.when(F.col(matched).isNotNull(), F.col(new_of[c]).cast(base.schema[c].dataType))
                      .otherwise(F.col(c)).alias(c) if c in set_cols else F.col(c) for c in base.columns])
