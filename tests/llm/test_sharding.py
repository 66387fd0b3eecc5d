import math
import struct
import zlib
from collections import Counter

import xxhash

from fieldlens.llm import sharding
from fieldlens.llm.sharding import Shard


def draw(doc_id, level, number, weight=1.0):
    h = 42 if doc_id is None else xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42)
    for x in (level, number):
        h = xxhash.xxh64_intdigest(struct.pack("<i", x), h)
    return -math.log(((h >> 11) + 0.5) / 2 ** 53) / weight


def brute(doc_id, tree):
    """The draws of the regions, then of that region's racks, then of that rack's shards."""
    tree = [s for s in tree if s.weight > 0]
    for k, level in enumerate(("region", "rack", "number")):
        weight = Counter()
        for s in tree:
            weight[getattr(s, level)] += s.weight
        best = min(weight, key=lambda n: draw(doc_id, k, n, weight[n]))
        tree = [s for s in tree if getattr(s, level) == best]
    return tree[0]


def placed(spark, ids, tree):
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    rows = df.select("doc_id", sharding.descend(df.doc_id, tree).alias("w")).collect()
    return {r.doc_id: (r.w.region, r.w.rack, r.w.shard) for r in rows}


def test_descent_and_movement(spark):
    ids = list(range(3000))
    now = placed(spark, ids, sharding.even_tree(40))
    for i in [*ids[:300], None]:
        s = brute(i, sharding.even_tree(40))
        assert placed(spark, [i], sharding.even_tree(40))[i] == (s.region, s.rack, s.number) if i is None else \
            now[i] == (s.region, s.rack, s.number)
    assert all(40 < c < 120 for c in Counter(s for _, _, s in now.values()).values())
    for n in range(41, 46):  # each further shard takes rows into itself alone
        later = placed(spark, ids, sharding.even_tree(n, base=40))
        moved = [i for i in ids if now[i] != later[i]]
        assert 30 < len(moved) < 130 and all(later[i][2] == n - 1 for i in moved)
        assert all(brute(i, sharding.even_tree(n, base=40)).number == later[i][2] for i in ids[:100])
        now = later


def test_each_level_decides(spark):
    """The winner is not the smallest draw of all leaves: it is drawn level by level."""
    ids = list(range(2000))
    tree = [Shard(0, 0, 0), Shard(1, 0, 1), Shard(2, 1, 2), Shard(3, 1, 3)]
    now = placed(spark, ids, tree)
    for i in ids:
        region = min((0, 1), key=lambda r: draw(i, 0, r, 2.0))
        rack = min((2 * region, 2 * region + 1), key=lambda r: draw(i, 1, r))
        assert now[i] == (region, rack, rack)
    flat = [min(range(4), key=lambda n: draw(i, 2, n)) for i in ids]
    assert sum(now[i][2] != f for i, f in zip(ids, flat)) > 1000


def test_weights(spark):
    ids = list(range(4000))
    tree = [Shard(0, 0, 0, 1.0), Shard(1, 0, 0, 3.0), Shard(2, 0, 1, 2.0), Shard(3, 1, 2, 2.0), Shard(4, 1, 2, 0.0)]
    now = placed(spark, ids, tree)
    share = Counter(s for _, _, s in now.values())
    for s in tree:
        assert abs(share[s.number] / 4000 - s.weight / 8) < 0.03
    heavier = placed(spark, ids, [*tree[:2], Shard(2, 0, 1, 4.0), *tree[3:]])
    moved = [i for i in ids if now[i] != heavier[i]]
    # Region 0 and rack 1 grew: rows come into region 0 from outside, and within it into rack 1 only.
    assert moved and all(heavier[i][0] == 0 for i in moved)
    assert all(heavier[i] == (0, 1, 2) for i in moved if now[i][0] == 0)
    assert {now[i][0] for i in moved} == {0, 1}


def test_rows(spark, edge, empty):
    rows = sharding.shard_documents(edge, sharding.even_tree(4), sharding.even_tree(5, base=4)).collect()
    assert len(rows) == edge.count() and {r.law for r in rows} == {"key"}
    want = Counter()
    for d in edge.collect():
        raw = (d.text or "").encode()
        want[d.doc_id, len(raw) + 16, zlib.crc32(raw), brute(d.doc_id, sharding.even_tree(4)).number] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard) for r in rows) == want
    for s in {r.shard for r in rows}:
        own = sorted(r.slot for r in rows if r.shard == s)
        assert own == list(range(len(own)))
    assert all(r.grown_shard in (r.shard, 4) for r in rows)
    assert sharding.shard_documents(empty, sharding.even_tree(4)).count() == 0


def test_slots_over_many_rows(spark):
    df = spark.range(20000).selectExpr("id AS doc_id", "repeat('x', cast(id % 50 AS int)) AS text")
    rows = sharding.shard_documents(df, sharding.even_tree(3)).groupBy("shard").agg(
        {"slot": "max", "*": "count"}).toPandas()
    assert (rows["max(slot)"] + 1 == rows["count(1)"]).all()
