"""Benchmark decontamination with an Aho-Corasick automaton.

All word windows of the benchmark's items go into one automaton; each text
is normalised and scanned once.  Words are runs of ASCII letters, digits and
all non-ASCII characters, with A-Z in lower case.  A window is ``window``
consecutive words of an item; an item with fewer words, but not none, is one
window.  A document word is hit if it lies inside an occurrence of a window.

The windows are made and grouped in Spark.  The automaton is built in the tasks
from them.  Up to ``shard_bytes`` of pattern text are one shard, which is
broadcast and scanned for in one pass, as is usual.  More windows are dealt by
hash to shards of about that size in the shared folder and never reach the
driver: each task keeps its texts in a temporary file and scans them once per
shard, one automaton in memory at a time, with the same result.  Such a folder
has to be of a kind that Arrow reads in the tasks (local, HDFS, S3, GCS, ABFS);
on any other the shards are broadcast.

Defined cases: a null or wordless text has no words and no hits; a null or
wordless item has no window; equal items (also under one id) are all
reported; repeated documents get equal results; an empty benchmark hits
nothing.  Input columns with the names of outputs are replaced.
"""

from __future__ import annotations

import pickle
import re
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..operators.joins import spare_names
from .common import drop_written, with_columns, written

#: Bytes to words: A-Z to a-z, other word bytes to themselves, the rest to a blank.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

SHARD_BYTES = 32 << 20
_STATE = "n_words long, indexes array<int>, items array<string>"
_SPANS = "array<struct<start:int,end:int>>"


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_FOLD).split() if text else []


def windows(text: str | None, window: int) -> list[bytes]:
    """The distinct windows of an item, words joined and enclosed by blanks."""
    w = words(text)
    return sorted({b" " + b" ".join(w[i:i + window]) + b" " for i in range(max(1, len(w) - window + 1))}) if w else []


def _patterns(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(pattern, items, size) of each distinct window, written; items are ids
    as text, sorted."""

    def cut(batches):
        for pdf in batches:
            for item, text in zip(pdf["item"], pdf["text"]):
                found = windows(text, window)
                yield pd.DataFrame({"pattern": found, "item": [item or ""] * len(found)}, dtype=object)

    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                            F.col(text_col).alias("text")).where("text IS NOT NULL")
    grouped = (rows.mapInPandas(cut, "pattern binary, item string")
               .groupBy("pattern").agg(F.array_sort(F.collect_set("item")).alias("items")))
    return written(grouped.withColumn("size", (F.length("pattern") + 16 * F.size("items")).cast("long")), "windows")


def _arrow_path(path: str) -> str | None:
    """The path of a shared folder as Arrow takes it; None if it has no such file system."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return parts.path
    schemes = {"hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}
    return schemes[parts.scheme] + path[len(parts.scheme):] if parts.scheme in schemes else None


def _in_folder(path: str):
    """A function that reads a shard's (pattern, items) from its folder."""

    def rows():
        import pyarrow.fs as fs
        import pyarrow.parquet as pq
        store, at = fs.FileSystem.from_uri(path)
        for f in store.get_file_info(fs.FileSelector(at)):
            if f.path.endswith(".parquet"):
                for batch in pq.ParquetFile(store.open_input_file(f.path)).iter_batches(columns=["pattern", "items"]):
                    yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

    return rows


def _broadcast(sc, rows: DataFrame):
    shared = sc.broadcast([(bytes(r["pattern"]), list(r["items"])) for r in rows.select("pattern", "items").collect()])
    return lambda: shared.value


def _shards(benchmark: DataFrame, id_col: str, text_col: str, window: int, shard_bytes: int) -> list:
    """Functions that give a shard's (pattern, items) in a task."""
    spark = benchmark.sparkSession
    patterns = _patterns(benchmark, id_col, text_col, window)
    count, total = patterns.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    n = min(count, -(-total // shard_bytes))
    if n < 2:
        shards = [_broadcast(spark.sparkContext, patterns)] if n else []
        drop_written(patterns)
        return shards
    dealt = patterns.withColumn("shard", F.pmod(F.xxhash64("pattern"), F.lit(n)).cast("int"))
    numbers = [r["shard"] for r in dealt.select("shard").distinct().orderBy("shard").collect()]
    folder = _arrow_path(patterns._corpus_path)
    if folder is None:
        return [_broadcast(spark.sparkContext, dealt.where(F.col("shard") == k)) for k in numbers]
    dealt.repartition(n, "shard").write.partitionBy("shard").parquet(patterns._corpus_path + "/dealt")
    return [_in_folder(f"{folder}/dealt/shard={k}") for k in numbers]


_BUILT: dict = {}


def _automaton(key: str, rows):
    """The automaton of a shard; each Python worker keeps the last one."""
    import ahocorasick
    if key not in _BUILT:
        _BUILT.clear()
        a = ahocorasick.Automaton()
        for pattern, items in rows():
            a.add_word(pattern.decode("latin-1"), (pattern.count(b" ") - 1, items))
        a.make_automaton()
        _BUILT[key] = a
    return _BUILT[key]


def _scan_all(shards: list, texts) -> Iterator[list[tuple[int, list[int], list[str]]]]:
    """What ``scan`` finds in each batch of texts with all of several shards."""
    with tempfile.TemporaryFile() as kept:
        sizes = []
        for batch in texts:
            pickle.dump(batch, kept)
            sizes.append(len(batch))
        found = [[(0, [], [])] * n for n in sizes]
        for key, rows in shards:
            a = _automaton(key, rows)
            kept.seek(0)
            for batch in found:
                for i, t in enumerate(pickle.load(kept)):
                    n, indexes, items = scan(a, t)
                    batch[i] = (n, sorted({*batch[i][1], *indexes}) if indexes else batch[i][1],
                                sorted({*batch[i][2], *items}) if items else batch[i][2])
    yield from found


def scan(automaton, text: str | None) -> tuple[int, list[int], list[str]]:
    """The number of words, the indexes of those that are hit, ascending, and
    the items, sorted."""
    w = words(text)
    if automaton is None or not w:
        return len(w), [], []
    line = " " + b" ".join(w).decode("latin-1") + " "
    ends, items = {}, set()
    for end, (n, ids) in automaton.iter(line):
        ends[end] = max(n, ends.get(end, 0))
        items.update(ids)
    hit, at, seen = set(), 0, 0
    for end in sorted(ends):
        seen += line.count(" ", at, end)  # as many words end before this blank
        at = end
        hit.update(range(seen - ends[end], seen))
    return len(w), sorted(hit), sorted(items)


def spans(text: str, indexes: list[int]) -> list[tuple[int, int]]:
    """(start, end) character offsets in the original text of the runs of hit
    words; what lies between two adjacent hit words belongs to the run."""
    wanted, out, last = set(indexes), [], None
    for k, m in enumerate(_WORD.finditer(text)):
        if k in wanted:
            if last == k - 1 and out:
                out[-1] = (out[-1][0], m.end())
            else:
                out.append((m.start(), m.end()))
            last = k
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = 10, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` with n_words long, n_hit long, items array<string> (ids as text,
    sorted as strings), spans array<struct<start:int,end:int>> (characters of
    the original text) and contaminated boolean."""
    shards = [(uuid.uuid4().hex, rows) for rows in _shards(benchmark, item_id, item_text, window, shard_bytes)]

    @F.pandas_udf(_STATE)
    def scanned(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if len(shards) > 1:
            found = _scan_all(shards, (t.tolist() for t in texts))
        else:
            a = _automaton(*shards[0]) if shards else None
            found = ([scan(a, t) for t in batch] for batch in texts)
        for rows in found:
            yield pd.DataFrame(rows, columns=["n_words", "indexes", "items"])

    hits, hit, found_spans = spare_names([*docs.columns, "n_words", "n_hit", "items", "spans", "contaminated"], "hits", "hit", "at")
    out = docs.withColumn(hits, scanned.asNondeterministic()(F.col(text_col)))  # so that it is planned once
    out = out.withColumn(hit, F.col(f"{hits}.indexes"))

    @F.pandas_udf(_SPANS)
    def located(text: pd.Series, indexes: pd.Series) -> pd.Series:
        return pd.Series([[{"start": s, "end": e} for s, e in spans(t, list(i))] if t else []
                          for t, i in zip(text, indexes)])

    only_hit = F.when(F.size(hit) > 0, F.col(text_col))
    out = out.withColumn(found_spans, located(only_hit, F.col(hit)))
    new = {"n_words": F.col(f"{hits}.n_words"), "n_hit": F.size(hit).cast("long"), "items": F.col(f"{hits}.items"),
           "spans": F.col(found_spans), "contaminated": F.size(hit) > 0}
    return with_columns(out, new).drop(hit, found_spans, hits)
