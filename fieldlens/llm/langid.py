"""Language identification: averaged hashed subword embeddings with a linear
softmax.

Subwords are runs of 2 to 4 bytes of a word, which is enclosed by blanks; A-Z
are in lower case, and a word is a run of ASCII letters and non-ASCII bytes.
Each subword hashes to one of ``BUCKETS`` rows of an embedding table; a text is
the mean of its subwords' embeddings, counted with repeats, and a linear layer
with a softmax gives the language.  Table and layer are trained by stochastic
gradient descent in numpy on a bounded sample of labelled texts:
``per_language`` distinct texts of each language, those of smallest hash, so
that rare languages are learned and exact copies count once.  Only subword
counts go to the driver, at most ``BUCKETS`` numbers a text.

A fifth of each language's sample is kept from training.  The languages' true
shares of distinct texts enter as a prior and as weights of the kept texts.  On
these a temperature is fitted, so that the score is a probability, and the
lowest score is found from which on at least ``precision`` of the predictions
are right: predictions below it are rejected.

Defined cases: a null text, or one without any Unicode letter, is ``und`` with
score 0 and rejected; so is every text if there is nothing to learn from; with
one language to learn from, each text with a letter gets that one; of equal
scores the language first in the alphabet wins; input columns with the names
of outputs are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from .common import append_columns, drop_written, written
from .textbytes import LETTERS, joined, mixed, slices

BITS = 14
BUCKETS = 1 << BITS
DIMENSIONS = 16
EPOCHS = 8
RATE = 0.5
PER_LANGUAGE = 500
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # (BUCKETS, languages): embeddings times the linear layer
    temperature: float
    least: float  # a score below it is rejected
    prior: np.ndarray | float = 0.0  # of each language, logarithm of its share over its share of the sample


def subword_counts(texts) -> np.ndarray:
    """(texts, BUCKETS) counts of each text's subwords."""
    b, ends = joined(texts)
    letter = LETTERS[b]
    packed = np.where(letter, b, 0x20).astype(np.uint64)
    buckets, docs = [], []
    for n in (2, 3, 4):
        if len(b) < n:
            continue
        last = len(b) - n + 1
        gram = np.full(last, n, np.uint64)
        inside = np.ones(last, bool)
        for k in range(n):
            gram = (gram << np.uint64(8)) | packed[k:k + last]
            if 0 < k < n - 1:
                inside &= letter[k:k + last]
        if n == 2:
            inside = letter[:last] | letter[1:]
        at = np.flatnonzero(inside)
        buckets.append((mixed(gram[at]) >> np.uint64(64 - BITS)).astype(np.int64))
        docs.append(np.searchsorted(ends, at, "right"))
    if not buckets:
        return np.zeros((len(ends), BUCKETS), np.float32)
    cell = np.concatenate(docs) * BUCKETS + np.concatenate(buckets)
    return np.bincount(cell, minlength=len(ends) * BUCKETS).reshape(len(ends), BUCKETS).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


# ------------------------------------------------------------------ training

def train(rows: list[tuple[np.ndarray, np.ndarray, int]], languages: list[str], seed: int = 7,
          precision: float = 0.98, total: np.ndarray | None = None) -> Model:
    """Rows are (buckets, counts, index of the language); ``total`` are the
    languages' true sizes, those of the sample if not given."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((DIMENSIONS, len(languages)), np.float32)
    order = rng.permutation(len(rows))
    of = np.array([rows[i][2] for i in order], np.int64)
    sampled = np.bincount(of, minlength=len(languages))
    place = np.zeros(len(rows), np.int64)  # within the language
    for k in range(len(languages)):
        place[of == k] = np.arange(sampled[k])
    keep = place < sampled[of] // 5
    kept, train_on = order[keep], order[~keep]
    weight = np.ones(len(languages)) if total is None else total / np.maximum(sampled, 1)
    prior = np.log(weight / weight.max())
    steps, done = EPOCHS * max(1, len(train_on)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(train_on):
            at, n, y = rows[i]
            if not len(at):
                continue
            share = (n / n.sum()).astype(np.float32)
            mean = share @ table[at]
            p = _softmax(mean @ layer)
            p[y] -= 1
            rate = RATE * (1 - done / steps)
            back = layer @ p
            layer -= rate * np.outer(mean, p)
            table[at] -= (rate * share)[:, None] * back * len(at) ** 0.5
            done += 1
    scores = table @ layer
    logits = np.array([(n / max(1, n.sum())) @ scores[at] for at, n, _ in (rows[i] for i in kept)])
    truth = np.array([rows[i][2] for i in kept])
    if not len(truth):
        return Model(languages, scores, 1.0, 0.0, prior)
    own = weight[truth]
    grid = np.geomspace(0.02, 5, 60)
    loss = [-(own * np.log(_softmax(logits / t + prior)[np.arange(len(truth)), truth] + 1e-12)).sum() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = _softmax(logits / temperature + prior)
    best, right = p.max(axis=1), p.argmax(axis=1) == truth
    down = np.argsort(-best, kind="stable")
    good = np.cumsum((own * right)[down]) >= precision * np.cumsum(own[down])
    good &= np.concatenate([best[down][1:] < best[down][:-1], [True]])  # equal scores go together
    least = float(best[down][np.flatnonzero(good)[-1]]) if good.any() else 1.1
    return Model(languages, scores, temperature, 0.0 if good[-1] else least, prior)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _drawn(known: DataFrame, per_language: int) -> tuple[list, dict]:
    """(id, lang, hash) of up to ``per_language`` distinct texts of each
    language, those of smallest hash, and the languages' numbers of distinct
    texts.  ``known`` has id, lang and hash.

    Hashes are even over their range, so all but the smallest are left out by a
    bound that follows from the language's size; six deviations above the
    mean, it leaves enough."""
    texts = written(known.groupBy("lang", "hash").agg(F.min("id").alias("id")), "languages")
    total = {r["lang"]: r["count"] for r in texts.groupBy("lang").count().collect()}
    part = {k: (per_language + 6 * per_language ** 0.5 + 6) / n for k, n in total.items()}
    bounds = known.sparkSession.createDataFrame(
        [(k, min((1 << 63) - 1, int(x * 2.0 ** 64) - (1 << 63))) for k, x in part.items()],
        f"lang {known.schema['lang'].dataType.simpleString()}, most long")
    drawn: dict = {}
    for r in texts.join(F.broadcast(bounds), "lang").where("hash <= most").select("id", "lang", "hash").collect():
        drawn.setdefault(r["lang"], []).append((r["hash"], r["id"]))
    drop_written(texts)
    return [(i, k, h) for k in sorted(drawn) for h, i in sorted(drawn[k])[:per_language]], total


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = PER_LANGUAGE, precision: float = 0.98) -> Model:
    """Learn from the rows of ``docs`` that have an id, a text and a language."""
    known = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.xxhash64(text_col).alias("hash"),
                        F.col(text_col).alias("text")).where("id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    chosen, total = _drawn(known.select("id", "lang", "hash"), per_language)
    kinds = ", ".join(f"{c} {known.schema[c].dataType.simpleString()}" for c in ("id", "lang", "hash"))
    few = (known.join(F.broadcast(docs.sparkSession.createDataFrame(chosen, kinds)), ["id", "lang", "hash"], "left_semi")
           .dropDuplicates(["id", "lang", "hash"]))

    @F.pandas_udf("at array<int>, n array<int>")
    def counted(text: pd.Series) -> pd.DataFrame:
        out = []
        for part in slices(text):
            for k in range(0, len(part), 64):
                for c in subword_counts(part[k:k + 64]):
                    at = np.flatnonzero(c)
                    out.append((at, c[at].astype(np.int64)))
        return pd.DataFrame(out, columns=["at", "n"])

    got = few.select("lang", "hash", counted("text").alias("c")).select(
        "lang", "hash", "c.at", "c.n").toPandas().sort_values(["lang", "hash"])
    languages = sorted(got["lang"].unique())
    index = {lang: k for k, lang in enumerate(languages)}
    rows = [(np.asarray(a, np.int64), np.asarray(n, np.float64), index[lang])
            for a, n, lang in zip(got["at"], got["n"], got["lang"])]
    if not rows:
        return Model([], np.zeros((BUCKETS, 0)), 1.0, 1.0)
    return train(rows, languages, precision=precision, total=np.array([total[k] for k in languages], float))


# ---------------------------------------------------------------- prediction

def predict_texts(model: Model, texts: list) -> list[tuple[str, float, bool]]:
    """(language, score, rejected) of each text."""
    out = []
    for k in range(0, len(texts), 64):
        part = texts[k:k + 64]
        counts = subword_counts(part)
        size = np.maximum(counts.sum(axis=1, dtype=np.float64), 1)
        if model.languages:
            p = _softmax((counts @ model.scores) / size[:, None] / model.temperature + model.prior)
            best = p.argmax(axis=1)
        for i, text in enumerate(part):
            if not model.languages or not has_letter(text):
                out.append((UNKNOWN, 0.0, True))
            else:
                score = float(p[i, best[i]])
                out.append((model.languages[best[i]], min(1.0, score), score < model.least))
    return out


def identify(docs: DataFrame, model: Model, *, text_col: str = "text", reject: bool = True) -> DataFrame:
    """``docs`` with lang_pred string, score double and rejected boolean.  With
    ``reject``, rejected predictions read ``und``; without, only texts that have
    no letter do."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows

    def work(texts):
        lang, score, rejected = zip(*predict_texts(shared.value, texts))
        return [[UNKNOWN if r and reject else p for p, r in zip(lang, rejected)], score, rejected]

    new = T.StructType().add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return append_columns(docs, text_col, new, work)
