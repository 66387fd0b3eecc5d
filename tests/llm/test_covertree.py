import numpy as np
import pytest

from fieldlens.llm import covertree


def brute(rows, least):
    """rows: (id, vector or None, label); links by cosine, groups by label."""
    def unit(v):
        if v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v):
            return None
        x = np.array(v, float)
        return x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) if x.any() else None

    units = [unit(v) if label is not None else None for _, v, label in rows]
    n = len(rows)
    root, count = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] \
                    and len(units[i]) == len(units[j]) and units[i] @ units[j] >= least:
                count[i] += 1
                count[j] += 1
                root[find(i)] = find(j)
    groups = {}
    for i in range(n):
        groups.setdefault(find(i), []).append(rows[i][0])
    out = []
    for i in range(n):
        ids = [x for x in groups[find(i)] if x is not None]
        c = min(ids) if ids else None
        out.append((rows[i][0], count[i], c, rows[i][0] is not None and rows[i][0] == c))
    return sorted(out, key=str)


def check(spark, rows, least=0.93):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], k) for i, v, k in rows]
    got = covertree.near_vectors(df, least=least).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows, least)


def crowd(seed, n=260, dim=16):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, dim))
    out = []
    for i in range(n):
        v = rng.normal(size=dim) if i % 3 else centers[i % 12] + rng.choice([0.02, 0.2, 0.5]) * rng.normal(size=dim)
        out.append((i, [float(x) for x in v * rng.choice([1, 1e-20, 1e15])], int(i % 2)))
    return out


@pytest.mark.parametrize("block", [16, 1024])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(covertree, "BLOCK", block)
    check(spark, crowd(block))


def test_large_tight_group_and_copies(spark):
    rng = np.random.default_rng(2)
    c = rng.normal(size=8)
    tight = [(i, [float(x) for x in c + 0.03 * rng.normal(size=8)], 1) for i in range(150)]
    check(spark, tight + [(1000 + i, tight[0][1], 1) for i in range(40)] + [(2000, tight[0][1], 2)])


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    check(spark, [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], None), (4, None, 0), (5, [], 0), (6, [0.0, 0.0], 0),
                  (7, [nan, 1.0], 0), (8, [1.0, None], 0), (9, [inf, 1.0], 0), (10, [1.0, 0.0, 0.0], 0),
                  (None, [1.0, 0.01], 0), (None, [0.0, 1.0], 0), (1, [1.0, 0.0], 0), (11, [-1.0, 0.0], 0)])
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int, n_links string")
    assert covertree.near_vectors(empty).count() == 0


def test_tree_invariants():
    x = covertree._unit(list(np.random.default_rng(1).normal(size=(300, 5))))
    tree = covertree.CoverTree(x)
    for i, members in enumerate(tree.members):
        far = np.sqrt(np.maximum(2 - 2 * (x[members] @ x[tree.center[i]]), 0)).max()
        assert far <= tree.radius[i] + 1e-7 and tree.center[i] in members
        kids = range(tree.child[i], tree.child[i] + tree.children[i])
        if kids:
            assert sorted(np.concatenate([tree.members[k] for k in kids])) == sorted(members)
