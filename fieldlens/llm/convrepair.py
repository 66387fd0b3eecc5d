"""Structure repair of conversations with a grammar-compressed min-plus DP.

A conversation's rows, by turn, become symbols: the initial of the role (s, u,
a, x for any other; a capital if the text is truncated), b for a blank row and
d for a repeated one.  The cheapest edits that make the role initials match
``(s?(ua)+)?`` are a path through an automaton of four states, and a symbol is
a 4 x 4 matrix of (cost, audit) under min-plus: Keep 0, Rerole to user or
assistant 1, Delete 2 (the only edit of blank and repeated rows), Insert an
empty user or assistant row 5, and 5 more for a truncated row that is not
deleted.  Audits are the edits' initials, and of equal costs the ASCII-least
audit wins: paths of one cost between the same states never have audits of
which one begins the other, so the order is kept when audits are joined.

Re-Pair replaces the most frequent neighbours by a rule until none repeats.  A
rule's matrix is the product of its two halves, worked out once, bottom-up,
with audits as ropes that share their halves; conversations of one batch share
the rules.  Long conversations are cut into pieces of ``CHUNK`` rows that
are evaluated apart, in any task, and multiplied in order at the end.

The rows travel without their texts (key, role, fault); equal rows are counted
before they meet.  Texts are shuffled once to meet their edits by the row's
key, so a conversation that holds a third of all rows is spread; only its audit,
a value of the result, stands in one task.

Defined cases: null roles and texts are one space; null turns come first; rows
of one turn are ordered by role and then MD5 of the text, equal rows adjacent;
null conversation ids are one conversation; faults are tested in the order
blank, duplicate, truncated, and only the first counts; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import written

CHUNK = 4096
#: Symbols of one grammar.
GRAMMAR = 1 << 15
_WHITE = " \t\n\x0b\x0c\r"
_LEGAL = ("su", "ua", "au")

# States: 0 nothing yet, 1 after the system row, 2 after user, 3 after assistant.
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_TURN = {0: "u", 1: "u", 2: "a", 3: "u"}  # the one of user and assistant that may follow
_ENDS = (0, 3)
_ROLE = {"u": "user", "a": "assistant"}


# --------------------------------------------------------------------- ropes
# An audit is a string, or two audits and their length.

def size(rope) -> int:
    return len(rope) if isinstance(rope, str) else rope[2]


def join(a, b):
    n = size(a) + size(b)
    if not size(a) or not size(b):
        return a or b
    return a + b if n <= 64 else (a, b, n)


def flat(rope) -> str:
    done, todo = [], [rope]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            done.append(x)
        else:
            todo += [x[1], x[0]]
    return "".join(done)


def less(a, b) -> bool:
    """Whether audit ``a`` comes before ``b``.  Parts that both share are not
    read: the longer part is opened first, so shared ones come to lie side by side."""
    xs, ys = [a], [b]
    while xs and ys:
        x, y = xs.pop(), ys.pop()
        if x is y:
            continue
        if isinstance(x, str) and isinstance(y, str):
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return x[:n] < y[:n]
            xs += [x[n:]] if len(x) > n else []
            ys += [y[n:]] if len(y) > n else []
        elif isinstance(y, str) or not isinstance(x, str) and size(x) >= size(y):
            xs += [x[1], x[0]]
            ys.append(y)
        else:
            xs.append(x)
            ys += [y[1], y[0]]
    return bool(ys)


# ------------------------------------------------------------------ matrices
# {(from, to): (cost, audit)}, entries that cannot be reached left out.

def _put(entries: dict, at, cost: int, audit) -> None:
    old = entries.get(at)
    if old is None or cost < old[0] or cost == old[0] and less(audit, old[1]):
        entries[at] = (cost, audit)


def product(left: dict, right: dict) -> dict:
    out: dict = {}
    for (p, m), (c, x) in left.items():
        for q in range(4):
            if (then := right.get((m, q))) is not None:
                _put(out, (p, q), c + then[0], join(x, then[1]))
    return out


def _inserts(state: int):
    """(state, number of inserts): more than two only walk in a circle."""
    for k in range(3):
        yield state, k
        state = _STEP[state, _TURN[state]]


def symbol_matrix(symbol: str) -> dict:
    """Inserts before a row, and the row's own edit."""
    out: dict = {}
    for start in range(4):
        for state, k in _inserts(start):
            _put(out, (start, state), 5 * k + 2, "I" * k + "D")
            if symbol not in "bd":
                cost = 5 * k + (5 if symbol.isupper() else 0)
                _put(out, (start, _STEP[state, _TURN[state]]), cost + 1, "I" * k + "R")
                if (state, symbol.lower()) in _STEP:
                    _put(out, (start, _STEP[state, symbol.lower()]), cost, "I" * k + "K")
    return out


# ------------------------------------------------------------------- Re-Pair

def re_pair(sequences: list[str]) -> tuple[list[list], dict]:
    """The sequences over symbols and rule numbers, and the rules {number: (left, right)}."""
    sym, first = [], []
    for s in sequences:
        first.append(len(sym) + 1)
        sym += [None, *s]
    sym.append(None)
    size = len(sym)
    nxt, prv = list(range(1, size + 1)), list(range(-1, size - 1))
    places = defaultdict(set)
    for i in range(size - 1):
        if sym[i] is not None and sym[i + 1] is not None:
            places[sym[i], sym[i + 1]].add(i)
    order = lambda pair: tuple((isinstance(x, int), x) for x in pair)
    heap = [(-len(at), order(pair), pair) for pair, at in places.items() if len(at) > 1]
    heapq.heapify(heap)
    rules: dict = {}
    while heap:
        n, tie, pair = heapq.heappop(heap)
        at = places.get(pair, ())
        if len(at) < 2:
            continue
        if len(at) != -n:
            heapq.heappush(heap, (-len(at), tie, pair))
            continue
        new = len(rules)
        touched = set()
        used = 0
        for i in sorted(at):
            j = nxt[i]
            if sym[i] != pair[0] or i not in at or j >= size or sym[j] != pair[1]:
                continue
            p, k = prv[i], nxt[j]
            for a, b, where in ((p, i, p), (j, k, j)):
                if sym[a] is not None and sym[b] is not None:
                    places[sym[a], sym[b]].discard(where)
            sym[i], sym[j] = new, None
            nxt[i], prv[k] = k, i
            for a, b in ((p, i), (i, k)):
                if sym[a] is not None and sym[b] is not None:
                    places[sym[a], sym[b]].add(a)
                    touched.add((sym[a], sym[b]))
            used += 1
        del places[pair]
        if used:
            rules[new] = pair
        for other in touched:
            if len(places[other]) > 1:
                heapq.heappush(heap, (-len(places[other]), order(other), other))
    out = []
    for i in first:
        top = []
        while sym[i] is not None:
            top.append(sym[i])
            i = nxt[i]
        out.append(top)
    return out, rules


def matrices(sequences: list[str]) -> dict[str, dict]:
    """The matrix of each distinct sequence, by one grammar over all of them."""
    distinct = sorted(set(sequences))
    tops, rules = re_pair(distinct)
    known: dict = {x: symbol_matrix(x) for x in set("".join(distinct))}
    for number, (left, right) in rules.items():  # a rule's halves are older than the rule
        known[number] = product(known[left], known[right])
    out = {}
    for text, top in zip(distinct, tops):
        row = [known[x] for x in top] or [{(p, p): (0, "") for p in range(4)}]
        while len(row) > 1:
            row = [product(*row[i:i + 2]) if i + 1 < len(row) else row[i] for i in range(0, len(row), 2)]
        out[text] = row[0]
    return out


def best(vector: dict) -> tuple[int, object, int, int]:
    """The cheapest way from state 0 to an accepting end: (cost, audit, state
    behind the last row, inserts behind it)."""
    found = None
    for (_, q), (cost, audit) in vector.items():
        for state, k in _inserts(q):
            if state in _ENDS:
                way = (cost + 5 * k, join(audit, "I" * k), q, k)
                if found is None or way[0] < found[0] or way[0] == found[0] and less(way[1], found[1]):
                    found = way
    return found


def cheapest(symbols: str) -> tuple[int, str]:
    """Cost and audit of one conversation."""
    cost, audit, _, _ = best({k: v for k, v in matrices([symbols])[symbols].items() if k[0] == 0})
    return cost, flat(audit)


# ------------------------------------------------------------------ in Spark

def _tidy(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(ck, turn, role, text, digest, key): ck tells conversations apart as
    text, key tells rows apart, equal rows share it."""
    said = F.coalesce(F.col(text), F.lit(" "))
    rows = turns.select(_conv_key(F.col(conv)).alias("ck"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role), F.lit(" ")).alias("role"), said.alias("text"), F.md5(said).alias("digest"))
    when = F.coalesce(F.concat(F.lit("="), F.col("turn").cast("string")), F.lit(""))
    return rows.withColumn("key", F.unhex(F.md5(F.concat_ws("/", F.md5("ck"), when, F.md5("role"), "digest"))))


def _conv_key(conv: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def _faults(rows: DataFrame) -> DataFrame:
    """One row per key: how often it stands there, the symbol of the first of
    them and the symbol of the others, which repeat it."""
    bare = F.rtrim(F.col("text"), F.lit(_WHITE))
    told = rows.select("ck", "turn", "role", "digest", "key", (bare == "").alias("blank"),
                       (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"))
    same = told.groupBy("ck", "turn", "role", "digest", "key", "blank", "cut").agg(F.count(F.lit(1)).alias("n"))
    earliest = same.groupBy("ck", "role", "digest").agg(F.min(F.struct("turn")).alias("earliest"))
    initial = F.substring("role", 1, 1)
    own = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    first = (F.when(F.col("blank"), "b").when(F.struct("turn") > F.col("earliest"), "d")
             .when(F.col("cut"), F.upper(own)).otherwise(own))
    return same.join(earliest, ["ck", "role", "digest"]).select(
        "ck", "turn", "role", "digest", "key", "n", initial.alias("initial"), first.alias("symbol"),
        F.when(F.col("blank"), "b").otherwise("d").alias("others"))


def _evaluate(batches):
    """Each piece with its matrix, by a grammar shared by the pieces at hand."""
    def work(pieces):
        texts = ["".join(m["symbol"] + m["others"] * (m["n"] - 1) for m in x["members"]) for x in pieces]
        known = matrices(texts)
        for x, t in zip(pieces, texts):
            x["matrix"] = [{"p": p, "q": q, "cost": c, "audit": flat(a)} for (p, q), (c, a) in known[t].items()]
        return pieces

    for batch in batches:
        pieces, size = [], 0
        for x in batch.to_pylist():
            pieces.append(x)
            size += sum(m["n"] for m in x["members"])
            if size >= GRAMMAR:
                yield pa.RecordBatch.from_pylist(work(pieces), _PIECE)
                pieces, size = [], 0
        if pieces:
            yield pa.RecordBatch.from_pylist(work(pieces), _PIECE)


_MEMBERS = "array<struct<place: bigint, key: binary, n: bigint, symbol: string, others: string, initial: string>>"
_PIECE = pa.schema([
    ("ck", pa.string()), ("piece", pa.int64()),
    ("members", pa.list_(pa.struct([("place", pa.int64()), ("key", pa.binary()), ("n", pa.int64()), ("symbol", pa.string()),
                                    ("others", pa.string()), ("initial", pa.string())]))),
    ("matrix", pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))])
_EDIT = pa.schema([("ck", pa.string()), ("place", pa.int64()), ("key", pa.binary()), ("role", pa.string()),
                   ("cost", pa.int64()), ("illegal", pa.int64()), ("audit", pa.string())])


def _conversation(pieces: list[dict]):
    """The repaired rows of a conversation (place, key or None for an insert,
    new role or None), and its summary with place -1."""
    ck = pieces[0]["ck"]
    vector: dict = {(0, 0): (0, "")}
    ways = []  # by piece: {state behind it: (state before it, audit of the piece)}
    for x in pieces:
        m = {(e["p"], e["q"]): (e["cost"], e["audit"]) for e in x["matrix"]}
        after: dict = {}
        way = {}
        for (_, p), (c, a) in vector.items():
            for q in range(4):
                if (p, q) in m:
                    cost, audit = c + m[p, q][0], join(a, m[p, q][1])
                    old = after.get((0, q))
                    if old is None or cost < old[0] or cost == old[0] and less(audit, old[1]):
                        after[0, q], way[q] = (cost, audit), (p, m[p, q][1])
        vector = after
        ways.append(way)
    cost, audit, state, tail = best(vector)
    path = []
    for way in reversed(ways):
        state, piece = way[state]
        path.append(piece)
    state, place, before, illegal = 0, 0, None, 0
    for x, piece in zip(pieces, reversed(path)):
        edits = iter(piece)
        for member in x["members"]:
            if before is not None and before + member["initial"] not in _LEGAL:
                illegal += 1
            before = member["initial"]
            illegal += member["n"] - 1
            for _ in range(member["n"]):
                for edit in edits:
                    if edit == "D":
                        break
                    letter = member["symbol"].lower() if edit == "K" else _TURN[state]
                    state = _STEP[state, letter]
                    yield {"ck": ck, "place": place, "key": None if edit == "I" else member["key"],
                           "role": None if edit == "K" else _ROLE[letter]}
                    place += 1
                    if edit != "I":
                        break
    for _ in range(tail):
        letter = _TURN[state]
        state = _STEP[state, letter]
        yield {"ck": ck, "place": place, "role": _ROLE[letter]}
        place += 1
    yield {"ck": ck, "place": -1, "cost": cost, "illegal": illegal, "audit": flat(audit)}


def _edit(batches):
    def out(rows):
        return pa.RecordBatch.from_pylist([{n: r.get(n) for n in _EDIT.names} for r in rows], _EDIT)

    held: list[dict] = []
    rows: list[dict] = []
    for batch in batches:
        for x in batch.to_pylist():
            if held and held[0]["ck"] != x["ck"]:
                rows += _conversation(held)
                held = []
            held.append(x)
            if len(rows) > 10_000:
                yield out(rows)
                rows = []
    if held:
        rows += _conversation(held)
    if rows:
        yield out(rows)


@dataclass(frozen=True)
class Repaired:
    """``summary``: one row per conversation: its id, gaps, blank, duplicate,
    truncated, illegal, cost, audit.  ``turns``: its rows after repair: its id,
    place, role, text."""
    summary: DataFrame
    turns: DataFrame


def repair(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", chunk: int = CHUNK) -> Repaired:
    """``chunk``: rows of a piece, a power of two."""
    spark = turns.sparkSession
    rows = _tidy(turns, conv_col, turn_col, role_col, text_col)
    faults = _faults(rows)
    # The ranges are cut by turn, too: a long conversation is in many of them.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = written(faults.repartitionByRange(parts, "ck", "turn", "role", "digest")
                     .sortWithinPartitions("ck", "turn", "role", "digest")
                     .withColumn("place", F.monotonically_increasing_id()), "turns")
    pieces = placed.groupBy("ck", F.shiftright("place", chunk.bit_length() - 1).alias("piece")).agg(  # chunk rows at most
        F.array_sort(F.collect_list(F.struct("place", "key", "n", "symbol", "others", "initial"))).alias("members"))
    valued = pieces.mapInArrow(_evaluate, f"ck string, piece bigint, members {_MEMBERS}, "
                               "matrix array<struct<p: int, q: int, cost: bigint, audit: string>>")
    edits = written(valued.repartition(parts, "ck").sortWithinPartitions("ck", "piece").mapInArrow(
        _edit, "ck string, place bigint, key binary, role string, cost bigint, illegal bigint, audit string"), "edits")

    of_first = lambda s: F.when(F.col("symbol") == s, 1).otherwise(0)
    more = F.col("n") - 1
    days = placed.groupBy("ck", "turn").agg(
        F.sum(of_first("b") + F.when(F.col("others") == "b", more).otherwise(0)).alias("blank"),
        F.sum(of_first("d") + F.when(F.col("others") == "d", more).otherwise(0)).alias("duplicate"),
        F.sum(F.when(F.col("symbol").isin("S", "U", "A", "X"), 1).otherwise(0)).alias("truncated"))
    span = (F.max("turn") - F.min("turn") + 1 - F.count("turn")).cast("long")
    counts = days.groupBy("ck").agg(F.coalesce(span, F.lit(0).cast("long")).alias("gaps"),
                                    *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated")])
    ids = turns.groupBy(conv_col).agg(F.lit(1).alias("one")).select(F.col(conv_col), _conv_key(F.col(conv_col)).alias("ck"))
    ways = edits.where("place < 0").select("ck", "illegal", "cost", "audit")
    summary = ids.join(counts, "ck").join(ways, "ck").drop("ck")

    said = rows.groupBy("key").agg(F.first("role").alias("own"), F.first("text").alias("text"))  # equal in all rows of a key
    kept = (edits.where("place >= 0 AND key IS NOT NULL").join(said, "key")
            .select("ck", "place", F.coalesce("role", "own").alias("role"), "text"))
    made = edits.where("place >= 0 AND key IS NULL").select("ck", "place", "role", F.lit("").alias("text"))
    conv_type = turns.schema[conv_col].dataType
    conv = F.when(F.col("ck") != "", F.substr(F.col("ck"), F.lit(2)).cast(conv_type)).alias(conv_col)
    return Repaired(summary, kept.unionByName(made).select(conv, "place", "role", "text"))
