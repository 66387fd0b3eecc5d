"""Sharding with a hierarchical weighted hash tree, law ``key``.

The tree has regions, racks in regions and shards in racks; each shard has a
weight, a subtree's weight is the sum of its shards'.  A document descends: at
each level every subtree at hand draws a hash of the id, the level and the
subtree's number, exponential with the subtree's weight as its rate, and the
smallest draw wins: first among the regions, then among the racks of that
region, then among the shards of that rack.  About a dozen draws are made for
40 shards, not one for each.  A subtree is chosen with its share of the weight,
so a shard gets its share of the whole.

A draw depends on the id and its own subtree's weight alone.  So if weights
change, documents move only into subtrees that grew, out of subtrees that
shrank, and within subtrees whose weights changed; no other subtree is touched.
A document that enters a subtree may arrive at any shard in it.  For a new shard
to take rows into itself alone it has to be a subtree of its own at the top:
``grown`` and ``even_tree`` beyond ``base`` shards give it a region of its own.

Slots number a shard's rows from 0 without gaps.  They come from running counts
over ``BUCKETS`` hash ranges of each shard, so no task holds a shard.

Defined cases: a null text has size 16 and CRC 0; rows with a null id draw as
one id, rows of one id share a shard, all rows are returned, and rows that
agree in id, size and CRC may have their slots in either order; input columns
with the names of outputs are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import written

BUCKETS = 1024


@dataclass(frozen=True)
class Shard:
    number: int
    region: int
    rack: int
    weight: float = 1.0


def even_tree(shards: int, per_rack: int = 4, racks_per_region: int = 5, base: int | None = None) -> list[Shard]:
    """Shards in order of their number, filling rack after rack; those beyond
    the first ``base`` have a region of their own each."""
    base = min(shards, shards if base is None else base)
    tree = [Shard(n, n // (per_rack * racks_per_region), n // per_rack) for n in range(base)]
    while len(tree) < shards:
        tree = grown(tree)
    return tree


def grown(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """``tree`` with one more shard, in a region of its own."""
    after = [1 + max((getattr(s, level) for s in tree), default=-1) for level in ("number", "region", "rack")]
    return [*tree, Shard(*after, weight)]


def draw(id_col: Column, level: int, number: Column, weight: Column) -> Column:
    """Exponential with rate ``weight``."""
    bits = F.shiftrightunsigned(F.xxhash64(id_col, F.lit(level), number), 11).cast("double")
    return -F.log((bits + 0.5) / float(1 << 53)) / weight


def _subtrees(tree: Iterable[Shard], levels: tuple[str, ...]) -> Column:
    """array<struct<number, weight[, below]>> of the subtrees at the first of the levels."""
    groups: dict[int, list[Shard]] = {}
    for s in tree:
        if s.weight > 0:
            groups.setdefault(getattr(s, levels[0]), []).append(s)
    return F.array(*[F.struct(
        F.lit(n).alias("number"), F.lit(float(sum(s.weight for s in own))).alias("weight"),
        *([_subtrees(own, levels[1:]).alias("below")] if levels[1:] else [])) for n, own in sorted(groups.items())])


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, not at each use in it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def descend(id_col: Column, tree: Iterable[Shard]) -> Column:
    """struct<region, rack, shard>: where the document arrives."""
    tree = list(tree)
    if not any(s.weight > 0 for s in tree):
        raise ValueError("the tree has no shard of positive weight")

    def winner(subtrees: Column, level: int) -> Column:
        drawn = lambda t: F.struct(draw(id_col, level, t["number"], t["weight"]).alias("draw"), t.alias("tree"))
        return F.array_min(F.transform(subtrees, drawn))["tree"]

    way = lambda region, rack: F.struct(region["number"].alias("region"), rack["number"].alias("rack"),
                                        winner(rack["below"], 2)["number"].alias("shard"))
    return _let(winner(_subtrees(tree, ("region", "rack", "number")), 0),
                lambda region: _let(winner(region["below"], 1), lambda rack: way(region, rack)))


def shard_documents(docs: DataFrame, tree: list[Shard], later: list[Shard] | None = None, *, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, size, text_crc32, law, region, rack,
    shard, slot, and grown_shard for the tree ``later``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = (F.octet_length(text) + 16).cast("long")
    crc = F.crc32(text)
    way = descend(F.col(id_col), tree)
    then = descend(F.col(id_col), later)["shard"] if later else F.lit(None).cast("int")
    rows = docs.select(F.col(id_col).alias("id"), size.alias("size"), crc.alias("text_crc32"), way.alias("way"),
                       then.alias("grown_shard"))
    rows = written(rows.select("id", "size", "text_crc32", "way.region", "way.rack", "way.shard", "grown_shard",
                               F.pmod(F.xxhash64("id", "size", "text_crc32"), F.lit(BUCKETS)).cast("int").alias("bucket")),
                   "shards")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "bucket").count().select(
        "shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    own = Window.partitionBy("shard", "bucket").orderBy("id", "size", "text_crc32")
    numbered = rows.withColumn("n", F.row_number().over(own))
    placed = numbered.join(F.broadcast(starts), ["shard", "bucket"])  # shards x BUCKETS rows at most
    return placed.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "region", "rack",
                         "shard", (F.col("start") + F.col("n") - 1).cast("long").alias("slot"), "grown_shard")
