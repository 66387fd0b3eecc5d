import random

import numpy as np
import xxhash

from fieldlens.llm import simhash


def brute_print(text, shingle=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i:i + shingle]), 42) for i in range(max(1, len(w) - shingle + 1))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_groups(prints, bits=2):
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_prints():
    for text in [None, "", "a", "A b", "one two three four one two three", "Ünï code \x0b x\x0cy", "w " * 70_000]:
        assert simhash.fingerprint(text, 3) == brute_print(text)


def near(rng, n):
    out = []
    for _ in range(n):
        p = rng.getrandbits(64) if not out or rng.random() < 0.3 else rng.choice(out)
        for _ in range(rng.randrange(4)):
            p ^= 1 << rng.randrange(64)
        out.append(p)
    return out


def test_links_are_all_pairs(spark):
    prints = sorted({simhash._signed(p) for p in near(random.Random(3), 500)})
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    for bits in (0, 1, 2):
        got = sorted(tuple(sorted((r.a, r.b))) for r in simhash.linked_prints(df, max_bits=bits).collect())
        want = sorted((a, b) for i, a in enumerate(prints) for b in prints[i + 1:]
                      if ((a ^ b) & (1 << 64) - 1).bit_count() <= bits)
        assert got == want


def all_pairs(prints, bits):
    return sorted((a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= bits)


def test_the_tally_drops_pairs():
    """A list's pairs share four bytes; of those the tally keeps what shares six."""
    rng = random.Random(4)
    head = 0x0102_0304
    prints = sorted({head | near << 32 for near in [rng.getrandbits(32) for _ in range(30)] for near in (near, near ^ 1, near ^ 0x0101, near ^ 0x30000)})
    shared = simhash.tally(np.array(prints, np.uint64))
    want = [[sum((a >> 8 * p & 255) == (b >> 8 * p & 255) for p in range(8)) for b in prints] for a in prints]
    assert shared.tolist() == want
    pairs = [(i, j) for i in range(len(prints)) for j in range(i)]
    assert sum(4 <= want[i][j] < 6 for i, j in pairs) > 1000 and sum(want[i][j] >= 6 for i, j in pairs) > 50
    a, b = simhash.list_pairs(np.array(prints, np.uint64), 0, 2)
    assert sorted(zip(a.tolist(), b.tolist())) == all_pairs(prints, 2) != []


def test_every_choice_keeps_a_pair_once():
    rng = random.Random(6)
    for bits in (0, 1, 2, 3):
        for _ in range(200):
            a = rng.getrandbits(64)
            b = a
            while b == a:
                for _ in range(rng.randint(1, max(bits, 1))):
                    b ^= 1 << rng.randrange(64)
            found = 0
            for own, key in enumerate(simhash.choices(bits)):
                mask = sum(0xFF << 8 * p for p in key)
                if a & mask == b & mask:
                    found += len(simhash.list_pairs(np.array([a, b], np.uint64), own, bits)[0])
            assert found == ((a ^ b).bit_count() <= bits)


def test_long_lists_find_the_same(spark, monkeypatch):
    rng = np.random.default_rng(0)
    groups = [[7 | int(x) << 48 for x in rng.choice(1 << 16, 700, False)], [9 << 8 | int(x) << 32 for x in rng.integers(0, 1 << 32, 500)],
              [5 << 40 | int(x) & 0xFF | int(x >> 8) << 24 for x in rng.choice(1 << 16, 300, False)], [rng.integers(1 << 62).item() for _ in range(50)]]
    prints = sorted({p for g in groups for p in g})
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fingerprint long")
    for limit in (20, 400):
        monkeypatch.setattr(simhash, "LONG_LIST", limit)
        got = [tuple(sorted((r.a & (1 << 64) - 1, r.b & (1 << 64) - 1))) for r in simhash.linked_prints(df).collect()]
        assert sorted(got) == all_pairs(prints, 2)


def test_groups(spark, edge, empty):
    rng = random.Random(1)
    base = [" ".join(rng.choices([f"w{i}" for i in range(400)], k=120)) for _ in range(12)]
    texts = base + [b + " tail" for b in base] + [b.replace(" w1 ", " other ") for b in base] + base[:4] + [None, "", "x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in simhash.simhash_groups(docs).collect()}
    prints = {i: brute_print(t) for i, t in enumerate(texts)}
    assert {i: int(r.fingerprint, 16) for i, r in rows.items()} == prints
    want = brute_groups(prints)
    assert {i: r.component_id for i, r in rows.items()} == want
    assert sorted(r.doc_id for r in simhash.keep_one_each(docs).collect()) == sorted(set(want.values()))
    got = simhash.simhash_groups(edge).collect()
    assert len(got) == edge.count()
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {2}
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    kept = simhash.keep_one_each(edge).collect()
    assert sum(r.doc_id == 1 for r in kept) == 1 and sum(r.doc_id is None for r in kept) == 1
    assert kept[0].__fields__ == edge.columns
    assert simhash.simhash_groups(empty).count() == 0 and simhash.keep_one_each(empty).count() == 0


def test_one_id_with_two_texts(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "quite another text here now"), (2, "a b c d e f")],
                                 "doc_id long, text string")
    kept = sorted(r.text for r in simhash.keep_one_each(docs).collect())
    assert kept == ["a b c d e f", "quite another text here now"]


def test_components(spark):
    from fieldlens.llm.common import connected_components
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)] + [
        (rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(80)] + [(5, 5)]
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {n: n for e in edges for n in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    alone = {5} | {a for a, b in edges if a == b}
    assert got == {n: find(n) for n in root if n in got}
    assert set(root) - set(got) <= alone


def test_a_split_list_by_values_or_by_pairs(monkeypatch):
    rng = np.random.default_rng(5)
    key = simhash.choices(2)[3]
    for further, more in enumerate(simhash.further_choices(key, 2)):
        free = [p for p in range(8) if p not in key + more]
        low = rng.choice(1 << 16, 700, False).astype(np.uint64)
        prints = (low & np.uint64(255)) << np.uint64(8 * free[0]) | (low >> np.uint64(8)) << np.uint64(8 * free[1])
        found = []
        for limit in (1, 1 << 20):
            monkeypatch.setattr(simhash, "LONG_LIST", limit)
            a, b = simhash.split_list_pairs(prints, 3, further, 2)
            found.append(sorted(zip(a.tolist(), b.tolist())))
        assert found[0] == found[1]
