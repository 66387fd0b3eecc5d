"""Toxic spans and document scores from a linear-chain conditional random field.

Training data are document labels.  A bounded sample of labelled documents
(``per_class`` of each label, those whose ids have the smallest hashes) is
turned into token labels: a token is marked toxic in a toxic document if its
word is far more frequent in toxic than in clean documents, by a likelihood
ratio test at 5 % over all words tested, near copies counting once.  The test
is repeated on the toxic documents that have no marked word yet, against all
clean ones, until it marks none: words of a rare language or topic stand out
among these only.  A two-state chain (clean, toxic) with weights for the word, the word before and
the word after, and for transitions, is fitted to segments of these tokens by
gradient ascent with forward-backward marginals.  ``segments`` with and as many
without a marked word are chosen: first one for each marked word, then a second
one, then others, and one document of each group of near copies before the
others of the group.

Scoring: forward-backward marginals over the whole text.  Tokens with a
marginal of at least ``SPAN`` are reported with character offsets in the
original text.  The sum of these marginals (of the others, a long clean text
would gather many) and the largest marginal go through a logistic curve, fitted
on the sample with the classes' true shares, to the document's probability.

Defined cases: null, empty and wordless texts get the score of a document
without evidence and no spans; several texts of one id are all learned from,
with the weight of the one that is last by its signatures; labels other than 0 and 1 and rows without an
id are not learned from; of an id with several labels the largest counts; with
one class or none to learn from, every score is that class's share (0.0 if
there are no labels); input columns with the names of outputs are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from .common import among, append_columns, drop_written, smallest_ids, with_columns, written
from .textbytes import mixed, slices, words

PER_CLASS = 3000
SEGMENT = 32
SEGMENTS = 4000
MIN_RATIO = 30.0
SPAN = 0.5
ROUNDS = 60


@dataclass
class Model:
    vocabulary: np.ndarray  # hashes of the known words, ascending
    weights: np.ndarray  # (3, words + 1): for the word, the one before, the one after; unknown words last
    bias: float
    step: np.ndarray  # (2, 2) scores of the transitions
    begin: np.ndarray  # (2,) scores of the first state
    curve: np.ndarray  # of (1, log(1 + sum of the spans' marginals), maximum)

    def known(self, hashes: np.ndarray) -> np.ndarray:
        n = len(self.vocabulary)
        if not n:
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), n - 1)
        return np.where(self.vocabulary[at] == hashes, at, n)

    def emission(self, at: np.ndarray, first: np.ndarray) -> np.ndarray:
        w = self.weights
        unknown = w.shape[1] - 1
        before, after = _neighbours(at, first, unknown)
        return np.clip(self.bias + w[0][at] + w[1][before] + w[2][after], -30, 30)

    def document_score(self, total: np.ndarray, peak: np.ndarray) -> np.ndarray:
        z = self.curve[0] + self.curve[1] * np.log1p(total) + self.curve[2] * peak
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _neighbours(at: np.ndarray, first: np.ndarray, unknown: int) -> tuple[np.ndarray, np.ndarray]:
    before = np.concatenate([[unknown], at[:-1]])
    before = np.where(first, unknown, before)
    after = np.concatenate([at[1:], [unknown]])
    last = np.concatenate([first[1:], [True]])
    return before, np.where(last, unknown, after)


def forward_backward(emit: np.ndarray, first: np.ndarray, step: np.ndarray, begin: np.ndarray, moves: bool = True):
    """Marginals of the toxic state and, with ``moves``, the expected number of
    transitions (2, 2) within sequences.  ``first`` marks each sequence's first
    token.

    All sequences are one long chain in which a first token forgets what was
    before.  The chain is cut into lanes that advance together: products of
    each lane's matrices, then the states at the lanes' borders, then the
    tokens within.
    """
    n = len(emit)
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    lanes = max(1, min(n, int(math.sqrt(4 * n))))
    steps = -(-n // lanes)
    pad = lanes * steps - n
    e = np.exp(np.concatenate([emit, np.zeros(pad)])).reshape(lanes, steps).T
    new = np.concatenate([first, np.ones(pad, bool)]).reshape(lanes, steps).T
    new[0, 0] = True
    a, b = np.exp(step), np.exp(begin)
    # matrix of token t: m[i][j] from state i before to state j
    m = [[np.where(new, b[j], a[i][j]) * (e if j else 1.0) for j in (0, 1)] for i in (0, 1)]
    scale = m[0][0] + m[0][1] + m[1][0] + m[1][1]
    m = [[x / scale for x in row] for row in m]
    # products of the lanes
    p = [[np.ones(lanes), np.zeros(lanes)], [np.zeros(lanes), np.ones(lanes)]]
    for t in range(steps):
        q = [[p[i][0] * m[0][j][t] + p[i][1] * m[1][j][t] for j in (0, 1)] for i in (0, 1)]
        s = q[0][0] + q[0][1] + q[1][0] + q[1][1]
        p = [[x / s for x in row] for row in q]
    product = np.array(p).transpose(2, 0, 1).tolist()
    fore, x = [], (0.5, 0.5)
    for (p00, p01), (p10, p11) in product:
        fore.append(x)
        y0, y1 = x[0] * p00 + x[1] * p10, x[0] * p01 + x[1] * p11
        x = (y0 / (y0 + y1), y1 / (y0 + y1))
    back, y = [], (0.5, 0.5)
    for (p00, p01), (p10, p11) in reversed(product):
        back.append(y)
        x0, x1 = p00 * y[0] + p01 * y[1], p10 * y[0] + p11 * y[1]
        y = (x0 / (x0 + x1), x1 / (x0 + x1))
    x0, x1 = np.array(fore).T
    alpha = np.empty((2, steps + 1, lanes))
    alpha[:, 0] = x0, x1
    for t in range(steps):
        y0, y1 = x0 * m[0][0][t] + x1 * m[1][0][t], x0 * m[0][1][t] + x1 * m[1][1][t]
        s = y0 + y1
        x0, x1 = y0 / s, y1 / s
        alpha[:, t + 1] = x0, x1
    y0, y1 = np.array(back[::-1]).T
    beta = np.empty((2, steps + 1, lanes))
    beta[:, steps] = y0, y1
    for t in range(steps - 1, -1, -1):
        x0, x1 = m[0][0][t] * y0 + m[0][1][t] * y1, m[1][0][t] * y0 + m[1][1][t] * y1
        s = x0 + x1
        y0, y1 = x0 / s, x1 / s
        beta[:, t] = y0, y1
    joint = alpha[:, 1:] * beta[:, 1:]
    marginal = (joint[1] / (joint[0] + joint[1])).T.reshape(-1)[:n]
    if not moves:
        return marginal, None
    inner = ~new
    edge = np.array([[alpha[i, :-1] * m[i][j] * beta[j, 1:] for j in (0, 1)] for i in (0, 1)])
    edge = edge / edge.sum(axis=(0, 1))
    return marginal, (edge * inner).sum(axis=(2, 3))


def fit_chain(hashes: np.ndarray, labels: np.ndarray, first: np.ndarray, rounds: int = ROUNDS,
              ridge: float = 1e-3) -> Model:
    """Maximum likelihood with a ridge penalty, by AdaGrad over all tokens."""
    vocabulary, at, count = np.unique(hashes, return_inverse=True, return_counts=True)
    frequent = count >= 2
    vocabulary, place = vocabulary[frequent], np.where(frequent, np.cumsum(frequent) - 1, int(frequent.sum()))
    at = place[at]
    unknown = len(vocabulary)
    model = Model(vocabulary, np.zeros((3, unknown + 1)), 0.0, np.zeros((2, 2)), np.zeros(2), np.zeros(3))
    before, after = _neighbours(at, first, unknown)
    inner = ~first
    moved = np.zeros((2, 2))
    np.add.at(moved, (labels[:-1][inner[1:]], labels[1:][inner[1:]]), 1)
    begun = np.bincount(labels[first], minlength=2).astype(float)
    seen = np.full((3, unknown + 1), 1e-6)
    seen_rest = np.full(7, 1e-6)
    for _ in range(rounds):
        marginal, expected = forward_backward(model.emission(at, first), first, model.step, model.begin)
        miss = labels - marginal
        grad = np.stack([np.bincount(x, miss, unknown + 1) for x in (at, before, after)]) - ridge * model.weights
        begin_now = np.array([(1 - marginal[first]).sum(), marginal[first].sum()])
        rest = np.concatenate([[miss.sum()], (moved - expected).ravel(), begun - begin_now])
        seen += grad ** 2
        seen_rest += rest ** 2
        model.weights += grad / np.sqrt(seen)
        move = rest / np.sqrt(seen_rest)
        model.bias += move[0]
        model.step += move[1:5].reshape(2, 2)
        model.begin += move[5:]
    return model


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Newton steps for a logistic curve with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (y - p)) - 1e-3 * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(hess, grad), -2, 2)
    return w


# ------------------------------------------------------------------ training

def _copies_once(signatures: list) -> tuple[np.ndarray, np.ndarray]:
    """For each sampled document a weight, 1 over the size of its group of near
    copies, which share one of four signatures, and whether it stands for the
    group."""
    root = list(range(len(signatures)))

    def find(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    seen: dict = {}
    for i, own in enumerate(signatures):
        for k, v in enumerate(own):
            root[find(i)] = find(seen.setdefault((k, v), i))
    group = np.array([find(i) for i in range(len(signatures))], np.int64)
    return 1 / np.bincount(group, minlength=len(signatures))[group], group == np.arange(len(signatures))


def _sample_tokens(docs: DataFrame, labels: DataFrame, per_class: int, id_col: str, text_col: str,
                   label_col: str) -> tuple[DataFrame, dict]:
    """(id, label, hashes) of the sample, written, and the classes' sizes."""
    one = labels.where(F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.max(label_col).cast("int").alias("label"))
    share = {r["label"]: r["count"] for r in one.groupBy("label").count().collect()}
    chosen = {i: k for k in (0, 1) for i in smallest_ids(one.where(F.col("label") == k), id_col, per_class)}
    texts = among(docs.select(id_col, text_col), id_col, list(chosen))

    def hashed(batches):
        for pdf in batches:
            at = 0
            for texts in slices(pdf[text_col]):
                ids = pdf[id_col].iloc[at:at + len(texts)].tolist()
                at += len(texts)
                doc, h, _, _ = words(texts)
                cut = np.searchsorted(doc, np.arange(1, len(texts)))
                yield pd.DataFrame({"id": ids, "label": [chosen[i] for i in ids],
                                    "hashes": np.split(h.view(np.int64), cut)})

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = texts.mapInPandas(hashed, f"id {id_type}, label int, hashes array<long>")
    return written(rows, "toxic-sample"), share


def _signatures(hashes: pd.Series) -> pd.Series:
    """Four signatures of two minimum hashes each over runs of three words."""

    def of(h):
        h = h.view(np.uint64)
        runs = h if len(h) < 3 else mixed(h[:-2] + mixed(h[1:-1] + mixed(h[2:])))
        least = [int(mixed(runs + np.uint64(salt)).min()) if len(h) else 0 for salt in range(8)]
        return [hash(tuple(least[i:i + 2])) for i in range(0, 8, 2)]

    return pd.Series([of(h) for h in hashes])


def _marked_words(sample: DataFrame, weights: DataFrame, of: dict) -> np.ndarray:
    """Hashes of the words that mark toxic documents, ascending.  ``of``: the
    weight of each sampled document by label and id."""
    spark = sample.sparkSession
    each = sample.join(F.broadcast(weights), "id").select("id", "label", "w", F.explode(F.array_distinct("hashes")).alias("h"))
    found, toxic, least = [], dict(of[1]), None
    clean_total = sum(of[0].values())
    while toxic:
        total = sum(toxic.values())
        left = spark.createDataFrame([(i,) for i in toxic], f"id {sample.schema['id'].dataType.simpleString()}")
        rows = each.where("label = 0").unionByName(each.where("label = 1").join(F.broadcast(left), "id", "left_semi"))
        counted = written(rows.groupBy("h").agg(F.sum(F.col("w") * F.col("label")).alias("toxic"),
                                                F.sum(F.col("w") * (1 - F.col("label"))).alias("clean")), "toxic-words")
        least = least or 2 * math.log(20 * max(1, counted.count()))
        both, every = F.col("toxic") + F.col("clean"), total + clean_total
        term = lambda x, k: F.when(x > 0, x * F.log(x * every / (both * k))).otherwise(0.0)
        marked = [r["h"] for r in counted
                  .where(2 * (term(F.col("toxic"), total) + term(F.col("clean"), clean_total)) >= least)
                  .where((F.col("toxic") + 0.5) / (total + 1) >= MIN_RATIO * (F.col("clean") + 0.5) / (clean_total + 1))
                  .select("h").collect()]
        drop_written(counted)
        if not marked:
            break
        found += marked
        words_now = spark.createDataFrame([(h,) for h in marked], "h long")
        explained = each.where("label = 1").join(F.broadcast(words_now), "h", "left_semi").select("id").distinct().collect()
        toxic = {i: w for i, w in toxic.items() if i not in {r["id"] for r in explained}}
    return np.sort(np.array(found, np.int64))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", per_class: int = PER_CLASS, segments: int = SEGMENTS) -> Model:
    """Fit on the rows of ``labels`` and the texts that ``docs`` has for them.
    ``per_class`` bounds the labelled rows of each label, ``segments`` the pieces
    of 32 words that the chain learns from, of each kind."""
    none = np.zeros(0, np.uint64)
    sample, share = _sample_tokens(docs, labels, per_class, id_col, text_col, label_col)
    spark = docs.sparkSession
    signatures = F.pandas_udf(_signatures, "array<long>")
    rows = sample.select("id", "label", signatures("hashes").alias("signatures")).orderBy("id", "signatures").collect()
    n = {k: sum(r["label"] == k for r in rows) for k in (0, 1)}
    if not n[0] or not n[1]:
        odds = 30.0 if n[1] else -30.0
        return Model(none, np.zeros((3, 1)), -30.0, np.zeros((2, 2)), np.zeros(2), np.array([odds, 0.0, 0.0]))
    weight, stands = (dict(zip((r["id"] for r in rows), x)) for x in _copies_once([r["signatures"] for r in rows]))
    weights = spark.createDataFrame([(i, float(w), not stands[i]) for i, w in weight.items()],
                                    f"id {sample.schema['id'].dataType.simpleString()}, w double, copy boolean")
    toxic_words = _marked_words(sample, weights, {k: {r["id"]: weight[r["id"]] for r in rows if r["label"] == k} for k in (0, 1)})

    def cut_up(batches):
        for pdf in batches:
            out = []
            for label, h, copy in zip(pdf["label"], pdf["hashes"], pdf["copy"]):
                toxic = np.isin(h, toxic_words) if label else np.zeros(len(h), bool)
                for i in range(0, len(h), SEGMENT):
                    y, x = toxic[i:i + SEGMENT], h[i:i + SEGMENT]
                    out.append((x, y.astype(np.int32), np.unique(x[y]), copy, int(np.bitwise_xor.reduce(x))))
            yield pd.DataFrame(out, columns=["h", "y", "marked", "copy", "o"])

    cut = sample.join(F.broadcast(weights), "id").select("label", "hashes", "copy").mapInPandas(
        cut_up, "h array<long>, y array<int>, marked array<long>, copy boolean, o long")
    # of each marked word the first and the last segment in their order
    ends = (cut.select(F.explode("marked").alias("word"), "copy", "o").groupBy("word")
            .agg(F.min(F.struct("copy", "o"))["o"].alias("first"),
                 F.min(F.struct("copy", F.bitwise_not("o").alias("o")))["o"].alias("last")).collect())  # of each marked word of the sample
    turn = {~r["last"]: 1 for r in ends} | {r["first"]: 0 for r in ends}
    turns = spark.createDataFrame(sorted(turn.items()), "o long, turn int")
    marked = (cut.where(F.size("marked") > 0).join(F.broadcast(turns), "o", "left")
              .orderBy(F.coalesce("turn", F.lit(2)), "copy", "o", "h"))
    clean = cut.where(F.size("marked") == 0).orderBy("copy", "o", "h")
    picked = [r for some in (marked, clean) for r in some.select("h", "y").limit(segments).collect()]
    first = np.concatenate([np.arange(len(r["h"])) == 0 for r in picked]) if picked else np.zeros(0, bool)
    model = fit_chain(np.concatenate([np.array(r["h"], np.int64).view(np.uint64) for r in picked] or [none]),
                      np.concatenate([np.array(r["y"], np.int64) for r in picked] or [np.zeros(0, np.int64)]), first)

    @F.pandas_udf("total double, peak double")
    def evidence(hashes: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_evidence(model, h.view(np.uint64)) for h in hashes], columns=["total", "peak"])

    seen = sample.select("label", evidence("hashes").alias("e")).select("label", "e.*").toPandas().sort_values(
        ["label", "total", "peak"])
    y = seen["label"].to_numpy(float)
    x = np.stack([np.ones(len(y)), np.log1p(seen["total"].to_numpy()), seen["peak"].to_numpy()], axis=1)
    model.curve = _logistic(x, y, np.where(y == 1, share[1] / (y == 1).sum(), share[0] / (y == 0).sum()))
    drop_written(sample)
    return model


def _evidence(model: Model, hashes: np.ndarray) -> tuple[float, float]:
    if not len(hashes):
        return 0.0, 0.0
    first = np.arange(len(hashes)) == 0
    p, _ = forward_backward(model.emission(model.known(hashes), first), first, model.step, model.begin, False)
    return float(p[p >= SPAN].sum()), float(p.max())


# ------------------------------------------------------------------- scoring

def score_texts(model: Model, texts: list) -> list[tuple]:
    """(score, spans) of each text; spans hold (start, end, probability)."""
    doc, h, start, end = words(texts)
    first = np.concatenate([[True], doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, bool)
    p, _ = forward_backward(model.emission(model.known(h), first), first, model.step, model.begin, False)
    total = np.bincount(doc, np.where(p >= SPAN, p, 0.0), len(texts))
    peak = np.zeros(len(texts))
    np.maximum.at(peak, doc, p)
    spans: list[list] = [[] for _ in texts]
    marked = np.flatnonzero(p >= SPAN)
    if len(marked):
        size = np.array([len(t.encode("utf-8", "replace")) + 1 if t else 1 for t in texts])
        begin = np.cumsum(size) - size + 1
        for i in marked.tolist():
            d = int(doc[i])
            raw = texts[d].encode("utf-8", "replace")
            a, b = int(start[i] - begin[d]), int(end[i] - begin[d])
            at = len(raw[:a].decode("utf-8"))
            spans[d].append({"start": at, "end": at + len(raw[a:b].decode("utf-8")), "probability": float(p[i])})
    return list(zip(model.document_score(total, peak).tolist(), spans))


def score(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` with score double, predicted int (1 from ``threshold`` on) and
    spans array<struct<start:int,end:int,probability:double>>."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample
    span = T.StructType().add("start", "integer").add("end", "integer").add("probability", "double")
    new = T.StructType().add("score", "double").add("spans", T.ArrayType(span))
    out = append_columns(docs, text_col, new, lambda texts: list(zip(*score_texts(shared.value, texts))))
    return with_columns(out, {"predicted": (F.col("score") >= threshold).cast("int")})
