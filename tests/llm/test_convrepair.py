"""Conversation repair: against all edits of short conversations, and a plain DP over rows."""
import hashlib
import itertools
import random
import re
import zlib

import pytest

from fieldlens.llm import convrepair, queries

OK = re.compile(r"(s?(ua)+)?")
WHITE = "\t\n\x0b\x0c\r "


def every_edit(symbols):
    best = None
    inserts = [("I" * k, 5 * k, "".join(x)) for k in range(3) for x in itertools.product("ua", repeat=k)]
    rows = []
    for x in symbols:
        late = 5 if x.isupper() else 0
        rows.append([("D", 2, "")] + ([] if x in "bd" else [("R", 1 + late, "u"), ("R", 1 + late, "a")]
                                      + ([("K", late, x.lower())] if x.lower() != "x" else [])))
    for own in itertools.product(*rows):
        for between in itertools.product(inserts, repeat=len(symbols) + 1):
            steps = [between[0], *itertools.chain(*zip(own, between[1:]))]
            if OK.fullmatch("".join(s[2] for s in steps)):
                way = sum(s[1] for s in steps), "".join(s[0] for s in steps)
                best = min(best, way) if best else way
    return best


def test_short_conversations_equal_all_edits():
    rng = random.Random(5)
    texts = ["".join(rng.choices("suaxSUAXbd", k=k)) for k in (1, 2, 2, 2, 2, 3, 3, 3, 3, 3, 3)]
    assert [convrepair.cheapest(t) for t in texts] == [every_edit(t) for t in texts]


def test_re_pair_keeps_sequences_and_repeats_no_pair():
    rng = random.Random(2)
    texts = ["".join(rng.choices("uaD", k=rng.randint(0, 40))) for _ in range(50)] + ["ua" * 30, "uuuuuuu", ""]
    tops, rules = convrepair.re_pair(texts)

    def spell(x):
        return x if isinstance(x, str) else spell(rules[x][0]) + spell(rules[x][1])

    assert ["".join(map(spell, t)) for t in tops] == texts
    assert len(rules) < sum(map(len, texts)) / 2 and all(spell(r) in "|".join(texts) for r in rules)
    pairs = [p for t in tops for p in zip(t, t[1:]) if p[0] != p[1]]
    assert len(pairs) == len(set(pairs))


def test_audits_as_ropes_compare_as_text():
    rng = random.Random(3)
    parts = ["".join(rng.choices("DK", k=rng.randint(0, 70))) for _ in range(12)]

    def rope():
        out = ""
        for x in rng.choices(parts, k=6):
            out = convrepair.join(out, x) if rng.random() < .5 else convrepair.join(x, out)
        return out

    for a, b in [(rope(), rope()) for _ in range(300)]:
        assert convrepair.less(a, b) == (convrepair.flat(a) < convrepair.flat(b))


def replay(rows):
    """One conversation's row of the result, by a plain DP; rows (turn, role, text) in table order."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0], r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(WHITE)
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    def with_inserts(ways):
        out = dict(ways)
        for _ in range(2):
            for state, (c, a, lines) in list(out.items()):
                for x in "ua":
                    if (state, x) in after:
                        way = (c + 5, a + "I", lines + [names[x] + ":"])
                        to = after[state, x]
                        if to not in out or way[:2] < out[to][:2]:
                            out[to] = way
        return out

    ways = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults):
        new = {}
        for state, (c, a, lines) in with_inserts(ways).items():
            moves = [(state, 2, "D", [])]
            if fault not in ("b", "d"):
                late = 5 if fault == "t" else 0
                if (state, role[:1]) in after:
                    moves.append((after[state, role[:1]], late, "K", [f"{role}:{text}"]))
                moves += [(after[state, x], 1 + late, "R", [f"{names[x]}:{text}"]) for x in "ua" if (state, x) in after]
            for to, cost, edit, line in moves:
                way = (c + cost, a + edit, lines + line)
                if to not in new or way[:2] < new[to][:2]:
                    new[to] = way
        ways = new
    cost, audit, lines = min(w for s, w in with_inserts(ways).items() if s in ("", "a")) if rows else (0, "", [])
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return ((max(turns) - min(turns) + 1 - len(set(turns))) if turns else 0, *[faults.count(f) for f in "bdt"],
            sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
TEXTS = ["Yes.", "No!", "Well?", "and then", "", " \n", "Yes.  ", "Ü", None, "line one\nline two.", "." * 50]
ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "usher"]


def some_rows(n, convs, seed):
    rng = random.Random(seed)
    return [(rng.choice(convs), rng.choice([None, *range(12)]), rng.choice(ROLES), rng.choice(TEXTS)) for _ in range(n)]


def found(spark, rows, **kind):
    done = convrepair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ck int, place string"
                                                   if len(rows[0]) == 6 else "conv_id long, turn long, role string, text string"), **kind)
    shas = {r[0]: r[1] for r in queries.text_digests(done.turns, "conv_id").collect()}
    none = hashlib.sha256(b"").hexdigest()
    return {r["conv_id"]: (*[r[c] for c in COLUMNS[:-1]], shas.get(r["conv_id"], none)) for r in done.summary.collect()}


@pytest.mark.parametrize("chunk,convs", [(convrepair.CHUNK, [None, *range(12)]), (4, [1, 2])])
def test_equals_a_plain_dp(spark, chunk, convs):
    rows = some_rows(160, convs, chunk)
    want = {c: replay([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert found(spark, rows, chunk=chunk) == want


def test_a_long_conversation_and_clashing_names(spark):
    rows = [(1, t, "user" if t % 3 else "assistant", f"Turn {t % 40}." + "x" * (t % 2)) for t in range(700)]
    rows += [(2, 1, "user", "long " * 40_000 + "."), (2, 2, "assistant", "Short.")]
    want = {c: replay([r[1:] for r in rows if r[0] == c]) for c in (1, 2)}
    assert found(spark, [(*r, 1, "p") for r in rows], chunk=64) == want


def test_empty(spark):
    done = convrepair.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert done.summary.count() == 0 and done.turns.count() == 0


def test_query_equals_replay_of_damage(spark, tmp_path):
    rows = some_rows(150, [None, *range(20)], 9) + [(50, 1, "user", "gone")]
    rows += [(c, 0, "user", "x") for c in range(100, 140)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    want = {}
    for conv in {r[0] for r in rows}:
        left = []
        for c, t, role, text in rows:
            if c == conv:
                role, text = " " if role is None else role, " " if text is None else text
                fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
                row = (t, "user" if fate == 4 else role, "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text)
                left += [] if fate == 0 else [row, row] if fate == 3 else [row]
        want[conv] = replay(left)
    got = queries.op12_conversation_repair(spark, str(tmp_path)).collect()
    assert {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in got} == want and len(got) == len(want)
    assert any(w[5] == 0 and w[6] == "" for w in want.values())
