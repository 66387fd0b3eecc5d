"""Quality by ordinal cumulative-link regression on hashed text.

A text becomes one vector: the frequencies of its byte trigrams, A-Z in lower
case, hashed to ``BUCKETS`` places, and a few shape traits (length, share of
distinct words, of words equal to the one before, of symbols, of repeated
lines, mean word length), each cut to steps and hashed to the same table.  With
shared weights w and ordered thresholds c1 < c2 < ..., the probability of a
grade of at least k is 1 / (1 + exp(ck - w x)).  All grades share the weights;
the thresholds stay ordered as the first one and the logarithms of their gaps
are what is fitted.  Fitting is AdaGrad on the likelihood, in numpy, over a
bounded sample of graded texts: ``per_grade`` ids of each grade, those of
smallest hash, weighted by the grades' true shares.  Only vectors of the sample
go to the driver, at most ``BUCKETS`` numbers a text.

Scoring gives the expected grade and the tail probability of ``from_grade``;
texts whose tail probability is at least ``select_at`` are selected.

Defined cases: null texts count as empty, empty texts have length traits only;
null grades and ids are not learned from; of an id with several grades the
largest counts; with one grade to learn from, every text has it, with none the
outputs are null and nothing is selected; input columns with the names of
outputs are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from .common import among, append_columns, smallest_ids, with_columns
from .textbytes import joined, mixed, slices, words

BITS = 14
BUCKETS = 1 << BITS
PER_GRADE = 1000
EPOCHS = 12
_NOT_BLANK = np.array([c > 0x20 and c != 0x7F for c in range(256)])
_SYMBOL = np.array([c > 0x20 and c < 0x7F and not chr(c).isalnum() for c in range(256)])


@dataclass
class Model:
    grades: np.ndarray  # ascending
    weights: np.ndarray
    thresholds: np.ndarray  # one less than grades

    def tails(self, z: np.ndarray) -> np.ndarray:
        """P(grade >= k) for all grades but the lowest, one row for each text."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - z[:, None], -30, 30)))


def _steps(x: np.ndarray, cuts: list[float]) -> np.ndarray:
    return np.searchsorted(np.array(cuts), x, "right")


def vectors(texts) -> np.ndarray:
    """(texts, BUCKETS): trigram frequencies of length 1, plus the traits."""
    n = len(texts)
    b, ends = joined(texts)
    out = np.zeros((n, BUCKETS), np.float32)
    if len(b) >= 3:
        w = b.astype(np.uint64)
        gram = w[:-2] << np.uint64(16) | w[1:-1] << np.uint64(8) | w[2:]
        doc = np.searchsorted(ends, np.arange(1, len(b) - 1), "right")
        inside = doc < n
        inside[ends[:-1] - 1] = False  # around the blank between two texts
        cell = doc[inside] * BUCKETS + (mixed(gram[inside]) >> np.uint64(64 - BITS)).astype(np.int64)
        out += np.bincount(cell, minlength=n * BUCKETS).reshape(n, BUCKETS)
        out /= np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-9)
    doc, h, start, end = words(texts, _NOT_BLANK)
    count = np.bincount(doc, minlength=n)
    many = np.maximum(count, 1)
    pairs = np.unique(np.stack([doc.astype(np.uint64), h]), axis=1)[0].astype(np.int64)
    distinct = np.bincount(pairs, minlength=n) / many
    again = np.zeros(n) if len(h) < 2 else np.bincount(doc[1:], (h[1:] == h[:-1]) & (doc[1:] == doc[:-1]), n) / many
    size = np.diff(np.concatenate([[1], ends + 1])) - 1
    at = np.searchsorted(ends, np.arange(len(b)), "right")
    symbols = np.bincount(at[_SYMBOL[b]], minlength=n + 1)[:n] / np.maximum(size, 1)
    lines = [[x for x in t.split("\n") if x.strip()] if t else [] for t in texts]
    repeated = np.array([1 - len(set(x)) / len(x) if x else 0.0 for x in lines])
    length = np.bincount(doc, end - start, n) / many
    traits = [_steps(np.log2(count + 1), [1, 2, 3, 4, 5, 6, 8, 10, 12]), _steps(distinct, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]),
              _steps(again, [0.001, 0.01, 0.03, 0.1, 0.3]), _steps(symbols, [0.01, 0.02, 0.04, 0.06, 0.1, 0.2, 0.4]),
              _steps(repeated, [0.01, 0.1, 0.2, 0.4, 0.6]), _steps(length, [2, 3, 4, 5, 6, 8, 12])]
    for k, step in enumerate(traits):
        place = (mixed((np.uint64(1 << 40) + np.uint64(k << 8)) + step.astype(np.uint64)) >> np.uint64(64 - BITS)).astype(np.int64)
        out[np.arange(n), place] += 0.5
    return out


# ------------------------------------------------------------------ training

def train(rows: list[tuple[np.ndarray, np.ndarray]], grade: np.ndarray, weight: np.ndarray, seed: int = 3,
          ridge: float = 1e-4) -> Model:
    """Rows are (places, values); grade and weight are those of each row."""
    grades, y = np.unique(grade, return_inverse=True)
    k = len(grades)
    w = np.zeros(BUCKETS)
    if k < 2:
        return Model(grades, w, np.zeros(max(0, k - 1)))
    share = np.array([weight[y >= j].sum() for j in range(1, k)]) / weight.sum()
    start = np.log((1 - share) / share)
    raw = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    seen, seen_raw = np.full(BUCKETS, 1e-4), np.full(k - 1, 1e-4)
    rng = np.random.default_rng(seed)
    weight = weight / weight.mean()
    sigma = lambda t: 1 / (1 + np.exp(-np.clip(t, -30, 30)))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            gaps = np.exp(raw[1:])
            c = np.cumsum(np.concatenate([raw[:1], gaps]))
            z = float(w[at] @ x)
            # P(y) = up - down, of the tails at the grade's two thresholds
            up = sigma(z - c[y[i] - 1]) if y[i] > 0 else 1.0
            down = sigma(z - c[y[i]]) if y[i] < k - 1 else 0.0
            p = max(up - down, 1e-9)
            d_up, d_down = up * (1 - up) / p, down * (1 - down) / p
            step = weight[i] * (d_up - d_down)
            grad = step * x - ridge * w[at]
            seen[at] += grad * grad
            w[at] += 0.1 * grad / np.sqrt(seen[at])
            by_c = np.zeros(k - 1)
            if y[i] > 0:
                by_c[y[i] - 1] -= weight[i] * d_up
            if y[i] < k - 1:
                by_c[y[i]] += weight[i] * d_down
            sums = np.cumsum(by_c[::-1])[::-1]
            by_raw = np.concatenate([sums[:1], sums[1:] * gaps])
            seen_raw += by_raw * by_raw
            raw = raw + 0.1 * by_raw / np.sqrt(seen_raw)
    return Model(grades, w, np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])])))


def fit(docs: DataFrame, ratings: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        grade_col: str = "grade", per_grade: int = PER_GRADE) -> Model:
    one = ratings.where(F.col(grade_col).isNotNull()).groupBy(id_col).agg(F.max(grade_col).cast("int").alias("grade"))
    total = {r["grade"]: r["count"] for r in one.groupBy("grade").count().collect()}
    chosen = {i: g for g in sorted(total) for i in smallest_ids(one.where(F.col("grade") == g), id_col, per_grade)}
    few = among(docs.select(id_col, text_col), id_col, list(chosen)).groupBy(id_col).agg(F.max(text_col).alias(text_col))

    @F.pandas_udf("at array<int>, x array<float>")
    def vector(text: pd.Series) -> pd.DataFrame:
        out = []
        for part in slices(text):
            for i in range(0, len(part), 64):
                for v in vectors(part[i:i + 64]):
                    at = np.flatnonzero(v)
                    out.append((at, v[at]))
        return pd.DataFrame(out, columns=["at", "x"])

    got = few.select(F.col(id_col).alias("id"), vector(text_col).alias("v")).select("id", "v.*").toPandas().sort_values("id")
    grade = np.array([chosen[i] for i in got["id"]], np.int64)
    sampled = dict(zip(*np.unique(grade, return_counts=True)))
    weight = np.array([total[g] / sampled[g] for g in grade])
    rows = [(np.asarray(a, np.int64), np.asarray(x, np.float64)) for a, x in zip(got["at"], got["x"])]
    return train(rows, grade, weight)


# ------------------------------------------------------------------- scoring

def score(docs: DataFrame, model: Model, *, text_col: str = "text", from_grade: int = 1,
          select_at: float = 0.5) -> DataFrame:
    """``docs`` with expected_grade double, tail_probability double (of at
    least ``from_grade``) and selected boolean."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    new = T.StructType().add("expected_grade", "double").add("tail_probability", "double")

    def work(texts):
        m, expected, tail = shared.value, [], []
        above = int(np.searchsorted(m.grades, from_grade))
        for i in range(0, len(texts), 64):
            v = vectors(texts[i:i + 64])
            tails = m.tails(v @ m.weights)
            expected += (m.grades[0] + tails @ np.diff(m.grades)).tolist()
            tail += ([1.0] * len(v) if above == 0 else tails[:, above - 1].tolist() if above < len(m.grades) else [0.0] * len(v))
        return [expected, tail]

    if len(model.grades):
        out = append_columns(docs, text_col, new, work)
    else:
        out = with_columns(docs, {f.name: F.lit(None).cast("double") for f in new})
    return with_columns(out, {"selected": F.coalesce(F.col("tail_probability") >= select_at, F.lit(False))})
