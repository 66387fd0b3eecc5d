"""SimHash near-duplicate groups with a byte-position inverted index and a tally.

Fingerprints: whole texts, A-Z in lower case, split at ASCII white space into
words, shingles of ``shingle`` words (repeats included, blank-joined; a text
with fewer words is one shingle), XXH64 with seed 42.  A fingerprint bit is 1
if it is set in over half of the hashes; a text without words has fingerprint
zero and is linked like any other.

Links: two fingerprints within ``max_bits`` differing bits differ in at most
that many of their eight bytes, so they share at least 8 - max_bits positional
bytes: the guaranteed minimum.  Of the first 4 + max_bits positions they share
at least four.  The index therefore keeps one posting list for each choice of
four of these positions and the bytes there (15 rows per fingerprint for two
bits), and every pair to be found meets in a list.  In each list the shared
bytes of every pair are tallied over all eight positions, column by column; a
pair below the guaranteed minimum is dropped, and what remains is verified on
all 64 bits.  A pair is kept in the first list that it shares only.

Lists hold distinct fingerprints.  One of more than ``LONG_LIST`` entries is
split without loss: of the other four positions its pairs share at least 4 -
max_bits, so its entries go to one list for each choice of that many, keyed by
these bytes as well.  Only max_bits bytes are left free in such a list, which
for two bits has at most 65,536 entries however large the corpus is; if still
long, each entry looks up the values of the free bytes that lie within
``max_bits`` bits, 137 for two bytes, instead of all others.

Groups are the connected components of the links.  Rows of one fingerprint
are one node.  No text is shuffled.

Defined cases: null texts count as empty; rows with a null id belong to a
group but never name it (a group of null ids alone has a null id); repeated
rows are all returned; input columns with the names of outputs are replaced.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..operators.joins import spare_names
from .common import connected_components, with_columns, written

SEED = 42
#: A posting list of more entries is split.
LONG_LIST = 1024


def fingerprint(text: str | None, shingle: int) -> int:
    """The fingerprint as an unsigned integer."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(size) - 1
    n = max(1, len(words) - shingle + 1)
    first = (end + 1 - size)[:n].tolist()
    last = end[min(shingle, len(words)) - 1:].tolist()
    h64 = xxhash.xxh64_intdigest
    hashes = np.array([h64(line[a:b], SEED) for a, b in zip(first, last)], np.uint64)
    set_in = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_in += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = 3, out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint as a signed long of the same bits."""

    @F.pandas_udf("long")
    def prints(text: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in text], np.uint64).view(np.int64))

    return with_columns(docs, {out: prints.asNondeterministic()(F.col(text_col))})


# --------------------------------------------------------------------- links

def _mask(positions) -> int:
    return _signed(sum(0xFF << (8 * p) for p in positions))


def _signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def choices(max_bits: int) -> list[tuple[int, ...]]:
    """The positions of the bytes of each key."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be 0 to 3: more free bytes make posting lists too long")
    return list(combinations(range(4 + max_bits), 4))


def further_choices(key: tuple[int, ...], max_bits: int) -> list[tuple[int, ...]]:
    """The positions that a long list's keys have besides."""
    return list(combinations([p for p in range(8) if p not in key], 4 - max_bits))


def tally(prints: np.ndarray) -> np.ndarray:
    """How many positional bytes each pair of the list shares (n x n)."""
    columns = prints.view(np.uint8).reshape(-1, 8)
    shared = np.zeros((len(prints), len(prints)), np.uint8)
    for p in range(8):
        shared += columns[:, None, p] == columns[None, :, p]
    return shared


def _first_in(a: np.ndarray, b: np.ndarray, own: int, keys: list[tuple[int, ...]]) -> np.ndarray:
    """Which pairs share the bytes of no key before the own one."""
    diff = a ^ b
    first = np.ones(len(a), bool)
    for key in keys[:own]:
        first &= (diff & np.uint64(sum(0xFF << (8 * p) for p in key))) != 0
    return first


def list_pairs(prints: np.ndarray, own: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (smaller, larger; unsigned) of the posting list of choice ``own``
    within ``max_bits`` bits for which it is the first list they share."""
    prints = np.unique(prints)
    i, j = np.nonzero(np.triu(tally(prints) >= 8 - max_bits, 1))
    a, b = prints[i], prints[j]
    ok = np.bitwise_count(a ^ b) <= max_bits
    a, b = a[ok], b[ok]
    ok = _first_in(a, b, own, choices(max_bits))
    return a[ok], b[ok]


def _near_flips(free: list[int], max_bits: int) -> np.ndarray:
    """The non-zero 64-bit differences of at most ``max_bits`` bits in the free bytes."""
    at = [8 * p + b for p in free for b in range(8)]
    return np.array([sum(1 << b for b in c) for k in range(1, max_bits + 1) for c in combinations(at, k)], np.uint64)


def split_list_pairs(prints: np.ndarray, own: int, further: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The same of a part of a long list."""
    prints = np.unique(prints)
    key = choices(max_bits)[own]
    parts = further_choices(key, max_bits)
    if len(prints) <= LONG_LIST:
        a, b = list_pairs(prints, own, max_bits)
    else:
        found = [(prints[:0], prints[:0])]
        for flip in _near_flips([p for p in range(8) if p not in key + parts[further]], max_bits):
            other = prints ^ flip
            at = np.minimum(np.searchsorted(prints, other), len(prints) - 1)
            ok = (prints[at] == other) & (prints < other)
            found.append((prints[ok], other[ok]))
        a, b = (np.concatenate(x) for x in zip(*found))
        ok = _first_in(a, b, own, choices(max_bits))
        a, b = a[ok], b[ok]
    ok = _first_in(a, b, further, parts)
    return a[ok], b[ok]


def linked_prints(prints: DataFrame, col: str = "fingerprint", max_bits: int = 2) -> DataFrame:
    """(a, b) signed longs: all pairs of distinct fingerprints of the column
    (distinct, not null) that differ in 1 to ``max_bits`` bits."""
    keys = choices(max_bits)
    posted = prints.select(F.col(col).alias("p"), F.posexplode(F.array(
        *[F.col(col).bitwiseAND(F.lit(_mask(k))) for k in keys])).alias("choice", "key"))
    sizes = posted.groupBy("choice", "key").count()
    long_lists = written(sizes.where(F.col("count") > LONG_LIST).select("choice", "key"), "long-lists")

    def pairs(of):
        def work(batches):
            for pdf in batches:
                found = [of(np.asarray(p, np.int64).view(np.uint64), *x) for p, *x in zip(pdf["prints"], *(
                    pdf[c] for c in pdf.columns if c != "prints"))]
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*found)) if found else ([], [])
                yield pd.DataFrame({"a": a, "b": b})
        return work

    some_long = not long_lists.isEmpty()
    short = posted.join(long_lists, ["choice", "key"], "left_anti") if some_long else posted
    lists = (short.repartition("choice", "key")  # as they are: hardly any two of one task combine
             .groupBy("choice", "key").agg(F.collect_list("p").alias("prints"))  # at most LONG_LIST
             .where(F.size("prints") > 1).select("prints", "choice"))
    found = lists.mapInPandas(pairs(lambda p, c: list_pairs(p, c, max_bits)), "a long, b long")
    if not some_long:
        return found
    split = F.array(*[F.array(*[F.col("p").bitwiseAND(F.lit(_mask(k + more))) for more in further_choices(k, max_bits)])
                      for k in keys])
    parts = (posted.join(long_lists, ["choice", "key"], "left_semi")
             .select("p", "choice", F.posexplode(F.get(split, "choice")).alias("further", "key"))
             .groupBy("choice", "further", "key").agg(F.collect_list("p").alias("prints"))  # at most 256 ** max_bits
             .where(F.size("prints") > 1).select("prints", "choice", "further"))
    return found.unionByName(parts.mapInPandas(pairs(lambda p, c, f: split_list_pairs(p, c, f, max_bits)), "a long, b long"))


def _groups(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(id, hash of the text, print) of each row, and (print, least) of each
    print: least is the group's first (no id, id, hash)."""
    rows = written(with_fingerprint(
        docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text")),
        "text", shingle, "print").select("id", "hash", "print"), "prints")
    nodes = rows.groupBy("print").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash")).alias("least"))
    members = connected_components(linked_prints(nodes, "print", max_bits), "simhash")
    grouped = nodes.join(members.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "least", F.coalesce("component", "print").alias("component"))
    least = grouped.groupBy("component").agg(F.min("least").alias("least"))
    return rows, grouped.drop("least").join(least, "component").select("print", "least")


def simhash_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   max_bits: int = 2) -> DataFrame:
    """One row per row of ``docs``: the id, ``fingerprint`` (16 lower-case hex
    digits) and ``component_id``, the smallest id reachable by links."""
    rows, by_print = _groups(docs, id_col, text_col, shingle, max_bits)
    return rows.join(by_print, "print").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("least.id").alias("component_id"))


def keep_one_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                  max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` that represent their group, one of each: the row
    of the group's smallest id (a null id only if there is no other); of rows
    that share that id, the one with the smallest text hash; of rows equal in
    both, one."""
    _, by_print = _groups(docs, id_col, text_col, shingle, max_bits)
    of, its_id, its_hash = spare_names(docs.columns, "of", "its_id", "its_hash")
    names = by_print.select(F.col("least.id").alias(its_id), F.col("least.hash").alias(its_hash)).distinct()
    hashed = docs.withColumn(of, F.xxhash64(text_col))
    kept = hashed.join(names, hashed[id_col].eqNullSafe(names[its_id]) & (F.col(of) == F.col(its_hash)), "left_semi")
    return kept.dropDuplicates([id_col, of]).drop(of)
