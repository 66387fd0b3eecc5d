"""Embedding near-duplicates by dual traversal of cover trees.

Vectors are compared within their label only, as unit vectors in double
precision; cosine >= t is a distance of at most sqrt(2 - 2 t).  Equal vectors
of a label are one point with a count.

Each label's points are put in the order of 16 fixed random projections' signs
and cut into blocks of about ``BLOCK`` points, so near points tend to meet, and
no task and no row holds a label or a crowd of near points.  Each block gets a
cover tree: nested levels whose radii halve, a child for each centre that the
radius needs, and for each node the true distance of its farthest point.
Pairs of blocks, within a label, whose balls come closer than the threshold
distance are traversed together: a pair of nodes is dropped if the distance of
the centres less both radii exceeds the threshold, is taken as a whole if the
distance plus both radii does not, and else the children are paired.  What is
left are pairs of points, decided by their cosine.  Bounds keep a margin for
rounding, so all pairs within the threshold are found and none beyond.

A traversal returns, for each point, how many vectors it newly links with and
one member of its local group: linear in the block, however many pairs there
are.  Groups are connected components of these.  In data without structure in
the chosen metric no bound can drop blocks, and the work within a label is
that of comparing all its blocks.

Defined cases: a vector that is null, empty, zero, holds null or non-finite
components, or has no label links with nothing; vectors of different lengths
link with nothing of the other length; rows are kept as they are, repeated
ones link with each other; a null id never names a component, a component of
null ids has a null id and its rows are not kept.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import connected_components, drop_written, written

BLOCK = 1024
SIGNS = 16
MARGIN = 1e-7  # above the rounding of a distance near 0
_SMALLEST = 2.0 ** -12  # radius from which on points are children themselves


class CoverTree:
    """Arrays over nodes in breadth-first order: centre (a point's index),
    radius, first child and number of children, and the node's points as a
    range of ``order``."""

    def __init__(self, x: np.ndarray):
        self.x = x
        nodes = [(0, np.arange(len(x)), np.sqrt(np.maximum(2 - 2 * (x @ x[0]), 0)), 2.0)]
        center, radius, child, children, members = [], [], [], [], []
        at = 0
        while at < len(nodes):
            c, points, dist, r = nodes[at]
            center.append(c)
            radius.append(float(dist.max()))
            members.append(points)
            child.append(len(nodes))
            if len(points) > 1:
                nodes += self._split(c, points, dist, r)
            children.append(len(nodes) - child[-1])
            at += 1
        self.center, self.radius = np.array(center), np.array(radius)
        self.child, self.children, self.members = np.array(child), np.array(children), members

    def _split(self, c: int, points: np.ndarray, dist: np.ndarray, r: float) -> list:
        """Children of radius r / 2, or of the first halving that separates."""
        while r > _SMALLEST and dist.max() <= r / 2:
            r /= 2
        if r <= _SMALLEST:
            return [(p, np.array([p]), np.zeros(1), 0.0) for p in points.tolist()]
        r /= 2
        own = dist <= r
        out = [(c, points[own], dist[own], r)]
        rest = points[~own]
        while len(rest):
            c = int(rest[0])
            d = np.sqrt(np.maximum(2 - 2 * (self.x[rest] @ self.x[c]), 0))
            d[0] = 0.0
            near = d <= r
            out.append((c, rest[near], d[near], r))
            rest = rest[~near]
        return out


def traverse(a: CoverTree, b: CoverTree | None, least: float):
    """Pairs of points with cosine >= ``least``, between the trees or, with b
    None, within a.  Yields (points of a, points of b): each combination is a
    link; within a tree, each unordered pair once, and (points, None) for all
    pairs of the points."""
    limit = float(np.sqrt(2 - 2 * least))
    same = b is None
    b = a if same else b
    todo = [(0, 0)]
    while todo:
        i, j = todo.pop()
        if same and i == j:
            if a.children[i] == 0:
                continue
            if 2 * a.radius[i] <= limit - MARGIN:
                yield a.members[i], None
                continue
            kids = np.arange(a.child[i], a.child[i] + a.children[i])
            todo += [(k, k) for k in kids.tolist() if a.children[k]]
            left, right = kids, kids
        else:
            left = np.arange(a.child[i], a.child[i] + a.children[i]) if a.children[i] else np.array([i])
            right = np.arange(b.child[j], b.child[j] + b.children[j]) if b.children[j] else np.array([j])
        cosine = a.x[a.center[left]] @ b.x[b.center[right]].T
        dist = np.sqrt(np.maximum(2 - 2 * cosine, 0))
        both = a.radius[left][:, None] + b.radius[right][None, :]
        near = dist - both <= limit + MARGIN
        if same and i == j:
            near &= np.triu(np.ones(near.shape, bool), 1)
        points = (a.children[left] == 0)[:, None] & (b.children[right] == 0)[None, :]
        whole = near & np.where(points, cosine >= least, dist + both <= limit - MARGIN)
        for p, q in zip(*np.nonzero(whole)):
            yield a.members[left[p]], b.members[right[q]]
        todo += [(int(left[p]), int(right[q])) for p, q in zip(*np.nonzero(near & ~whole & ~points))]


def links(a: CoverTree, b: CoverTree | None, a_count: np.ndarray, b_count: np.ndarray, least: float):
    """(links of a's points, links of b's points, group of each point of a and
    then b): links count vectors; a group is named by its first point."""
    n, m = len(a.x), 0 if b is None else len(b.x)
    count = np.concatenate([a_count, b_count]) if m else a_count
    found = np.zeros(n + m, np.int64)
    root = np.arange(n + m)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for p, q in traverse(a, b, least):
        if q is None:
            found[p] += count[p].sum() - count[p]
            all_points = p
        else:
            q = q + n if m else q
            found[p] += count[q].sum()
            found[q] += count[p].sum()
            all_points = np.concatenate([p, q])
        top = min(find(int(i)) for i in all_points)
        for i in all_points.tolist():
            root[find(i)] = top
    return found[:n], found[n:], np.array([find(i) for i in range(n + m)], np.int64)


# ---------------------------------------------------------------------- Spark

def _unit(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square is lost
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _signs(vectors: pd.Series) -> pd.Series:
    """The signs of projections that depend on the vector's length alone."""
    out = []
    for v in vectors:
        x = np.asarray(v, np.float64)
        directions = np.random.default_rng(len(x)).normal(size=(SIGNS, len(x)))
        out.append(int(((directions @ (x / np.abs(x).max())) > 0) @ (1 << np.arange(SIGNS))))
    return pd.Series(out, dtype=np.int32)


def _blocked(points: DataFrame) -> DataFrame:
    """``points`` with their block within (label, size)."""
    cells = points.groupBy("label", "size", "cell").agg(F.count(F.lit(1)).alias("in_cell"))
    before = Window.partitionBy("label", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("start", F.coalesce(F.sum("in_cell").over(before), F.lit(0)))  # 2 ** SIGNS rows at most
    place = F.col("start") + F.pmod(F.xxhash64("point"), F.col("in_cell"))
    return points.join(cells, ["label", "size", "cell"]).withColumn("block", F.floor(place / BLOCK))


def _grown(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    x = _unit(pdf["vector"])
    tree = CoverTree(x)
    middle = x.mean(axis=0)
    norm = np.sqrt(middle @ middle)
    center = middle / norm if norm > 0 else x[0]
    radius = float(np.sqrt(np.maximum(2 - 2 * (x @ center), 0)).max())
    blob = pickle.dumps((tree, pdf["n"].to_numpy(np.int64), pdf["point"].to_numpy(np.int64)))
    return pd.DataFrame([(*key, center, radius, blob)], columns=["label", "size", "block", "center", "radius", "tree"])


def _met(least: float):
    def met(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [pickle.loads(t) for t in pdf.sort_values("block")["tree"]]
        a, a_n, a_id = parts[0]
        b, b_n, b_id = parts[1] if len(parts) > 1 else (None, a_n[:0], a_id[:0])
        found_a, found_b, group = links(a, b, a_n, b_n, least)
        ids, found = np.concatenate([a_id, b_id]), np.concatenate([found_a, found_b])
        linked = found > 0
        return pd.DataFrame({"point": ids[linked], "found": found[linked], "root": ids[group[linked]]})

    return met


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", least: float = 0.93) -> DataFrame:
    """One row per row of ``vectors``: the id, n_links long, component_id and
    kept boolean (the id is the component's)."""
    if not 0 < least <= 1:
        raise ValueError("the threshold is a cosine above 0 and up to 1")
    vector = F.col(vector_col).cast("array<double>")
    usable = (F.col("label").isNotNull() & F.coalesce(F.size("vector") > 0, F.lit(False))
              & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists("vector", lambda x: x != 0))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vector.alias("vector"))
    rows = rows.withColumn("vector", F.when(usable, F.col("vector")))
    signs = F.pandas_udf(_signs, "int")
    points = (rows.where("vector IS NOT NULL").groupBy("label", "vector")
              .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least_id"))
              .select("label", "vector", F.size("vector").alias("size"), signs("vector").alias("cell"), "n", "least_id",
                      F.monotonically_increasing_id().alias("point")))
    points = written(points, "points")
    label = points.schema["label"].dataType.simpleString()
    blocks = _blocked(points).groupBy("label", "size", "block").applyInPandas(
        _grown, f"label {label}, size int, block long, center array<double>, radius double, tree binary")
    blocks = written(blocks, "cover-trees")
    balls = blocks.select("label", "size", "block", "center", "radius")
    other = balls.select("label", "size", F.col("block").alias("j"), F.col("center").alias("c2"),
                         F.col("radius").alias("r2"))
    cosine = F.aggregate(F.zip_with("center", "c2", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    limit = float(np.sqrt(2 - 2 * least)) + MARGIN
    meets = F.sqrt(F.greatest(2 - 2 * cosine, F.lit(0.0))) - F.col("radius") - F.col("r2") <= limit
    pairs = (balls.join(other, ["label", "size"]).where((F.col("block") <= F.col("j")) & meets)
             .select("label", "size", F.col("block").alias("i"), "j"))
    sides = pairs.select("label", "size", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    found = (sides.join(blocks.select("label", "size", "block", "tree"), ["label", "size", "block"])
             .groupBy("label", "size", "i", "j").applyInPandas(_met(least), "point long, found long, root long"))
    found = written(found, "vector-links")
    member = connected_components(found.select(F.col("point").alias("a"), F.col("root").alias("b")), "vectors")
    counted = found.groupBy("point").agg(F.sum("found").alias("found"))
    known = (points.select("label", "vector", "point", "n", "least_id").join(counted, "point", "left")
             .join(member.withColumnRenamed("node", "point"), "point", "left")
             .withColumn("component", F.coalesce("component", "point")))
    named = known.groupBy("component").agg(F.min("least_id").alias("component_id"))
    facts = known.join(named, "component").select(
        "label", "vector", (F.coalesce("found", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id",
        F.lit(True).alias("usable"))
    drop_written(blocks)
    out = rows.join(facts, ["label", "vector"], "left")
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
