"""Main text of web pages with a suffix array over each host's pages.

A page is read into blocks, each in a zone: chrome (menus, headers, footers,
sidebars, notices, adverts, forms, comments, by element, role, class or id),
article (in an ``article`` or ``main`` element and not chrome) or open
(anything else that is seen).  A page's token stream holds the block marks and
words outside its article; the article stands there as a break.  Article text
is never boilerplate: a copy of an article on another page of the host is text.

The streams of a host's distinct pages (different html) are put one after
another, their suffixes sorted by prefix doubling to a depth of ``RUN``
tokens; neighbours that agree that far are a substring that repeats, and if it is on
two distinct pages, all its positions are covered.  Longer repeats are unions
of such runs, so a deeper order would cover nothing more.  A block is
boilerplate if half or more of its words are covered.  An open block stays if it
is not; chrome goes in any case; and a page with an article has that alone.

Pages are ranged over the tasks by host and key, so a host of any size is cut
into arrays of about ``ARRAY`` tokens.  For hosts that were cut each array
gives the hash of its distinct runs; runs that stand in several arrays cover
too, so results do not depend on the cuts.  Only token numbers are shuffled.
Pages are read again at the end, and what to remove is broadcast below
``BROADCAST`` bytes as written, else joined by page.

Defined cases: a null or empty html has the empty text; pages of null and
malformed URLs are one host; equal pages count as one page; a page without an
article of which every open block repeats keeps them all (it is a near copy);
an unclosed element ends with its parent; a character reference without its
semicolon is decoded as browsers do; white space is what ``str.split`` takes
for it; ``br`` is white space; input columns named ``text``, ``n_chars`` and
``n_repeated`` are replaced.
"""

from __future__ import annotations

import html as entities
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..operators.joins import spare_names
from .common import _path_fs, append_columns, written

RUN = 8
ARRAY = 1 << 20
BROADCAST = 8 << 20
CHROME, OPEN, ARTICLE = 0, 1, 2

# Elements of HTML by their role here.
_SILENT = "script|style|noscript|template|title|textarea|iframe|svg|math|canvas|object|video|audio|select|button"
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCKS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search
section summary table tbody td tfoot th thead tr ul""".split())
_CHROME_ELEMENTS = {"head", "nav", "aside", "footer", "form", "menu", "dialog", "search"}
_CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu",
                 "menubar", "toolbar"}
_CHROME_NAMES = set("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner
sidebar sidenav aside menu submenu nav navbar navigation topnav breadcrumb breadcrumbs masthead topbar header footer
pagination pager cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup
login share sharing social related recommended widget comment comments commentlist discussion disqus reply replies
respond toolbar skip""".split())
_COMMENTS = {"comment", "comments", "commentlist", "discussion", "disqus", "reply", "replies", "respond"}

_TAG = re.compile(rf"""
    <!--.*?(?:-->|\Z)
  | <(?P<silent>{_SILENT})\b(?:[^>"']|"[^"]*"|'[^']*')*+>.*?(?:</(?P=silent)\s*>|\Z)
  | <(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*+)>
  | <[!?][^>]*>
""", re.X | re.S | re.I)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


def _zone(name: str, rest: str, around: int, comments: bool) -> tuple[int, bool]:
    """Zone of what stands in the element, and whether it is a comment's."""
    words, roles = set(), set()
    if "=" in rest:
        for key, a, b, c in _NAMED.findall(rest):
            for value in (a or b or c).lower().split():
                if key.lower() == "role":
                    roles.add(value)
                elif not value.startswith(("has-", "with-", "no-", "without-")):  # says what is beside it
                    words.update(_WORD.findall(value))
    chrome = name in _CHROME_ELEMENTS or bool(roles & _CHROME_ROLES) or name not in ("body", "html") and bool(words & _CHROME_NAMES)
    if name == "header" and around != ARTICLE:
        chrome = True
    if name in ("article", "main") and (name == "main" or not chrome) and not comments:
        return ARTICLE, False
    if chrome:
        return CHROME, comments or bool(words & _COMMENTS)
    return around, comments


def blocks(page: str | None) -> list[tuple[str, str, int]]:
    """(element, text, zone) of each block with text, in page order."""
    out: list[tuple[str, str, int]] = []
    page = page or ""
    stack = [("", OPEN, False)]
    said: list[str] = []
    block, at = "", 0

    def close():
        if said:
            text = " ".join(entities.unescape("".join(said)).split())
            if text:
                out.append((block, text, stack[-1][1]))
            said.clear()

    for m in _TAG.finditer(page):
        if m.start() > at:
            said.append(page[at:m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            said.append(" ")
        elif m["end"]:
            if name in _BLOCKS or any(name == s[0] for s in stack[1:]):
                close()
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
                    if name not in _BLOCKS and stack[k][0] in _BLOCKS:
                        break
                block = stack[-1][0]
        else:
            if name in _BLOCKS:
                close()
                if name == "p" and stack[-1][0] == "p" or name == "li" and stack[-1][0] == "li":
                    stack.pop()
                elif stack[-1][0] == "p":
                    stack.pop()  # no block stands in a paragraph
                block = name
            zone, comments = _zone(name, m["rest"], stack[-1][1], stack[-1][2])
            if name in _VOID or m["rest"].endswith("/") and name not in _BLOCKS:
                continue
            if name in _BLOCKS:
                stack.append((name, zone, comments))
            elif zone != stack[-1][1]:  # an inline element that is chrome
                close()
                stack.append((name, zone, comments))
    if at < len(page):
        said.append(page[at:])
    close()
    return out


def main_text(found: list[tuple[str, str, int]], removed=()) -> tuple[str, int]:
    """The text of a page from its blocks, without the open blocks numbered in
    ``removed``; and how many of these went."""
    if any(zone == ARTICLE for _, _, zone in found):
        return "\n\n".join(text for _, text, zone in found if zone == ARTICLE), 0
    open_blocks = [text for _, text, zone in found if zone == OPEN]
    gone = set(removed)
    unique = [text for k, text in enumerate(open_blocks) if k not in gone]
    return ("\n\n".join(unique), len(gone)) if unique else ("\n\n".join(open_blocks), 0)


# ------------------------------------------------------------------- streams

def stream(found: list[tuple[str, str, int]]) -> tuple[list[int], list[int], list[int]]:
    """Token numbers of a page, 0 for its article; and the first token and the
    number of words of each open block, if the page has no article."""
    tokens: list[int] = []
    starts, sizes = [], []
    plain = not any(zone == ARTICLE for _, _, zone in found)
    for name, text, zone in found:
        if zone == ARTICLE:
            if not tokens or tokens[-1]:
                tokens.append(0)
            continue
        words = text.split(" ")
        tokens.append(zlib.crc32(b"<" + name.encode()) or 1)
        if plain and zone == OPEN:
            starts.append(len(tokens))
            sizes.append(len(words))
        tokens += [zlib.crc32(w.encode("utf-8", "replace")) or 1 for w in words]
    return tokens, starts, sizes


def suffix_ranks(text: np.ndarray, depth: int) -> np.ndarray:
    """Rank of each suffix among the distinct prefixes of ``depth`` tokens."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1
    known, n = 1, len(text)
    while known < depth:
        step = min(known, depth - known)
        later = np.zeros(n, np.int64)
        later[:max(n - step, 0)] = rank[step:]
        rank = np.unique(rank * (n + 2) + later, return_inverse=True)[1].astype(np.int64) + 1
        known += step
    return rank


def repeated_runs(pages: list[np.ndarray], run: int = RUN) -> tuple[list[np.ndarray], np.ndarray]:
    """By page, where a run of tokens starts that is on another page, too; and
    the hashes of all distinct runs (uint64)."""
    if not pages:
        return [], np.zeros(0, np.uint64)
    size = np.array([len(p) + 1 for p in pages])
    owner = np.repeat(np.arange(len(pages)), size)
    text = np.concatenate([np.append(p, 0) for p in pages]).astype(np.int64)
    breaks = np.flatnonzero(text == 0)
    text[breaks] = -1 - np.arange(len(breaks))  # each break is a token of its own
    rank = suffix_ranks(text, run)
    array = np.argsort(rank, kind="stable")  # the suffix array, to that depth
    first = np.flatnonzero(np.diff(rank[array], prepend=0))
    lowest, highest = (f.reduceat(owner[array], first) for f in (np.minimum, np.maximum))
    many = np.zeros(len(text), bool)
    many[array] = np.repeat(lowest != highest, np.diff(first, append=len(array)))
    starts = np.cumsum(size) - size
    whole = np.ones(len(text), bool)  # runs without a break
    for k in range(run):
        whole[np.maximum(breaks - k, 0)] = False
    heads = array[first]
    heads = heads[whole[heads]]
    return [np.flatnonzero(many[a:a + n - 1]) for a, n in zip(starts, size)], run_hashes(text, run)[heads]


def run_hashes(text: np.ndarray, run: int) -> np.ndarray:
    h = np.zeros(len(text), np.uint64)
    padded = np.append(text, np.zeros(run, np.int64)).astype(np.uint64)
    for k in range(run):
        h = (h ^ padded[k:k + len(text)]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def covered_blocks(n_tokens: int, runs, starts, sizes, run: int = RUN) -> list[int]:
    """Numbers of the open blocks of which half or more of the words are covered."""
    edge = np.zeros(n_tokens + run + 1, np.int64)
    runs = np.asarray(runs, np.int64)
    np.add.at(edge, runs, 1)
    np.add.at(edge, runs + run, -1)
    words = np.append(0, np.cumsum(np.cumsum(edge)[:n_tokens] > 0))
    return [k for k, (a, n) in enumerate(zip(starts, sizes)) if 2 * (words[a + n] - words[a]) >= n]


# ------------------------------------------------------------------ in Spark

_PAGE = pa.schema([("host", pa.string()), ("page", pa.string()), ("tokens", pa.list_(pa.int64())),
                   ("starts", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32()))])
_FOUND = pa.schema([("host", pa.string()), ("page", pa.string()), ("part", pa.int64()), ("n_tokens", pa.int32()),
                    ("runs", pa.list_(pa.int32())), ("starts", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32())),
                    ("wanted", pa.list_(pa.int64())), ("hashes", pa.list_(pa.int64()))])


def _rows(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{n: r.get(n) for n in schema.names} for r in rows], schema)


def _streams(batches):
    for batch in batches:
        rows = []
        for host, page, text in zip(*(batch.column(k) for k in range(3))):
            tokens, starts, sizes = stream(blocks(text.as_py()))
            if tokens:
                rows.append({"host": host.as_py(), "page": page.as_py(), "tokens": tokens, "starts": starts, "sizes": sizes})
        yield _rows(rows, _PAGE)


def _arrays(run: int, limit: int):
    """One suffix array for each host, or several for a host over the limit."""
    def array(held: list[dict], part: int) -> tuple[list[dict], np.ndarray]:
        tokens = [np.asarray(x.pop("tokens"), np.int64) for x in held]
        runs, hashes = repeated_runs(tokens, run)
        for x, t, r in zip(held, tokens, runs):
            x |= {"part": part, "n_tokens": len(t), "runs": r.tolist() if x["starts"] else []}
            if x["starts"]:
                x["wanted"] = run_hashes(t, run).view(np.int64).tolist()
        return held, hashes.view(np.int64)

    def work(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId() << 24
        held, size, last, first_host, cut = [], 0, (None, None), None, False

        def close(cut: bool):
            """The rows of the open array; with hashes if the host may go on elsewhere."""
            nonlocal part
            pages, hashes = array(held, part)
            out = [x for x in pages if x["starts"]]
            if cut:
                out += [{"host": last[0], "part": part, "hashes": hashes[k:k + 10_000].tolist()}
                        for k in range(0, len(hashes), 10_000)]
            else:
                for x in out:
                    x.pop("wanted")
            part += 1
            return _rows(out, _FOUND)

        for batch in batches:
            for x in batch.to_pylist():
                if (x["host"], x["page"]) == last:
                    continue
                if x["host"] != last[0]:
                    if held:
                        yield close(cut or last[0] == first_host)
                    first_host = x["host"] if last[0] is None else first_host
                    held, size, cut = [], 0, False
                elif size >= limit:
                    cut = True
                    yield close(cut)
                    held, size = [], 0
                last = x["host"], x["page"]
                held.append(x)
                size += len(x["tokens"])
        if held:  # the first and the last host of a task may go on in others
            yield close(True)

    return work


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


def repeated_blocks(pages: DataFrame, *, url_col: str = "url", html_col: str = "html", run: int = RUN,
                    array: int = ARRAY) -> DataFrame:
    """(host, page, removed): numbers of the open blocks that repeat on the host,
    for distinct pages (MD5 of the html) that have such ones."""
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    read = pages.select(host_of(F.col(url_col)).alias("host"), F.md5(html_col).alias("page"), F.col(html_col).alias("html"))
    streams = read.where("html <> ''").mapInArrow(
        _streams, "host string, page string, tokens array<bigint>, starts array<int>, sizes array<int>")
    found = written(streams.repartitionByRange(parts, "host", "page").sortWithinPartitions("host", "page").mapInArrow(
        _arrays(run, array), "host string, page string, part bigint, n_tokens int, runs array<int>, starts array<int>, "
        "sizes array<int>, wanted array<bigint>, hashes array<bigint>"), "runs")
    targets = found.where("page IS NOT NULL")
    across = (found.where("hashes IS NOT NULL").select("host", "part", F.explode("hashes").alias("h"))
              .groupBy("host", "h").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b").select("host", "h"))
    wanted = targets.where("wanted IS NOT NULL").select("host", "page", F.posexplode("wanted").alias("at", "h"))
    more = wanted.join(across, ["host", "h"]).groupBy("host", "page").agg(F.collect_set("at").alias("more"))  # of one page
    cover = F.udf(lambda n, runs, starts, sizes: covered_blocks(n, runs, starts, sizes, run), "array<int>", useArrow=True)
    both = targets.join(more, ["host", "page"], "left").select(
        "host", "page", cover("n_tokens", F.concat("runs", F.coalesce("more", F.array().cast("array<int>"))), "starts", "sizes").alias("removed"))
    return both.where(F.size("removed") > 0)


def extract(pages: DataFrame, *, url_col: str = "url", html_col: str = "html", run: int = RUN, array: int = ARRAY,
            broadcast: int = BROADCAST) -> DataFrame:
    """``pages`` with ``text``, ``n_chars`` (code points) and ``n_repeated``
    (open blocks removed because they repeat on the host)."""
    gone = written(repeated_blocks(pages, url_col=url_col, html_col=html_col, run=run, array=array), "repeated")
    path, fs = _path_fs(pages.sparkSession, gone._corpus_path)
    of = gone.select(F.struct("host", "page").alias("of"), "removed")
    of = F.broadcast(of) if fs.getContentSummary(path).getLength() < broadcast else of
    key, cut = spare_names([*pages.columns, "text", "n_chars", "n_repeated"], "page", "removed")
    keyed = pages.withColumn(key, F.struct(host_of(F.col(url_col)).alias("host"), F.md5(html_col).alias("page")))
    of = of.withColumnsRenamed({"of": key, "removed": cut})
    joined = keyed.join(of, key, "left").drop(key)

    def work(htmls, removed):
        made = [main_text(blocks(h), r or ()) for h, r in zip(htmls, removed)]
        return [t for t, _ in made], [len(t) for t, _ in made], [n for _, n in made]

    new = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()),
                        T.StructField("n_repeated", T.IntegerType())])
    return append_columns(joined, html_col, new, work, also=cut).drop(cut)
