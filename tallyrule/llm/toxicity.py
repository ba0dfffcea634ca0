"""Toxicity by non-negative positive-unlabelled learning.

Positives are documents confirmed as toxic; everything else that may be
learned from is unlabelled, neither clean nor toxic. A linear classifier over
hashed words and word beginnings is trained in numpy on the risk

    prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)])

whose second part, the risk on the unknown negatives, is kept from falling
below zero: when a step would push it there, the step goes back instead. How
sparse the weights are is chosen by the same risk on a part kept from training.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrule.llm.common import fresh_name, held_out, ship

BITS = 18
PREFIX = 4  # letters of a word's beginning that count as a feature of their own
SPARSITIES = (3.6e-3, 1e-2, 3e-2)  # tried by the risk on a kept quarter, least first
THRESHOLD = 0.3
MAX_POSITIVES, MAX_UNLABELLED = 4_000, 8_000  # the bounded sample that the classifier is fitted on
_WORD = re.compile(r"\w+")


class _Buckets(dict):
    """Hash buckets of words and, of longer ones, of their beginnings; emptied when full."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 100_000:
            self.clear()
        parts = (word, "^" + word[:PREFIX])[: 1 + (len(word) > PREFIX)]
        b = self[word] = tuple(zlib.crc32(x.encode()) & (1 << BITS) - 1 for x in parts)
        return b


_BUCKETS = _Buckets()


def features(text: str | None) -> list[int]:
    """Distinct buckets of a whole text's lower-cased words and their beginnings."""
    return list({b for w in set(_WORD.findall((text or "").lower())) for b in _BUCKETS[w]})


@dataclass
class Model:
    weights: list[float]
    bias: float

    def score(self, text: str | None) -> float:
        """Probability of label 1; a text without words gets the bias alone."""
        # fsum: the same to the last bit in whatever order the words come
        f = self.bias + math.fsum(map(self.weights.__getitem__, features(text)))
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, f))))


def _sums(rows: list[np.ndarray]):
    """Row sums of a weight vector, and back: gradients of row values."""
    sizes = np.array([r.size for r in rows])
    of = np.repeat(np.arange(len(rows)), sizes)
    at = np.concatenate([np.empty(0, np.int32), *rows])
    return (
        lambda w: np.bincount(of, weights=w[at], minlength=len(rows)),
        lambda g: np.bincount(at, weights=g[of], minlength=1 << BITS),
    )


def fit(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    steps: int = 150,
    rate: float = 0.05,
    sparsity: float | None = None,
) -> Model:
    """Minimise the non-negative risk by Adam with soft thresholding of the weights.

    The threshold is ``sparsity`` over the root of the number of positives, the
    scale of a weight's noise; by default ``choose_sparsity`` gives it. Features
    that one positive alone has are left out, as they tell nothing of others.
    Without positives or prior all scores are near 0.
    """
    if not positive or not unlabelled or prior <= 0:
        return Model([0.0] * (1 << BITS), -30.0)
    prior = min(prior, 0.99)
    if sparsity is None:
        sparsity = choose_sparsity(positive, unlabelled, prior, steps, rate)
    seen = np.bincount(np.concatenate([np.unique(r) for r in positive]).astype(np.int64), minlength=1 << BITS) > 1
    positive, unlabelled = ([r[seen[r]] for r in rows] for rows in (positive, unlabelled))
    sparsity /= math.sqrt(len(positive))
    to_p, from_p = _sums(positive)
    to_u, from_u = _sums(unlabelled)
    w, b = np.zeros(1 << BITS), math.log(prior / (1 - prior))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    n_p, n_u = len(positive), len(unlabelled)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(b + to_p(w), -30, 30)))
        u = 1 / (1 + np.exp(-np.clip(b + to_u(w), -30, 30)))
        # logistic loss: l(-f) = -log(1 - s); its derivative is s, that of l(f) is s - 1
        negative = -np.log1p(-u).mean() + prior * np.log1p(-p).mean()
        if negative >= 0:
            g_p, g_u = prior * ((p - 1) - p) / n_p, u / n_u
        else:
            g_p, g_u = prior * p / n_p, -u / n_u
        g, gb = from_p(g_p) + from_u(g_u), g_p.sum() + g_u.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        fix = np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        step = rate * fix / (np.sqrt(v) + 1e-5)
        w = w - step * m
        w = np.sign(w) * np.maximum(0, np.abs(w) - step * sparsity)
        b -= rate * fix * mb / (np.sqrt(vb) + 1e-5)
    return Model(w.tolist(), float(b))


def risk(model: Model, positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> tuple[float, float]:
    """The non-negative risk of a model on rows, and its standard error."""
    w = np.array(model.weights)
    f_p, f_u = (np.array([model.bias + w[r].sum() for r in rows]) for rows in (positive, unlabelled))
    as_one, as_zero, unknown = np.logaddexp(0, -f_p), np.logaddexp(0, f_p), np.logaddexp(0, f_u)
    value = prior * as_one.mean() + max(0.0, unknown.mean() - prior * as_zero.mean())
    error = math.sqrt((prior * (as_one - as_zero)).var() / f_p.size + unknown.var() / f_u.size)
    return float(value), error


def choose_sparsity(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = 150, rate: float = 0.05
) -> float:
    """The least of ``SPARSITIES`` whose risk on a kept quarter is within one standard error of the lowest.

    The quarter is chosen by a hash of a row's features, so copies stay together.
    """

    def split(rows: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        kept = [zlib.crc32(np.sort(r).astype("<i8").tobytes()) % 4 == 0 for r in rows]
        return [r for r, k in zip(rows, kept, strict=True) if not k], [r for r, k in zip(rows, kept, strict=True) if k]

    (learn_p, test_p), (learn_u, test_u) = split(positive), split(unlabelled)
    if not (learn_p and test_p and learn_u and test_u):
        return SPARSITIES[0]
    found = [risk(fit(learn_p, learn_u, prior, steps, rate, s), test_p, test_u, prior) for s in SPARSITIES]
    lowest, error = min(found)
    return next(s for s, (value, _) in zip(SPARSITIES, found, strict=True) if value <= lowest + error)


def _share(key: Column, n: int, most: int) -> Column:
    """A reproducible share of about ``most`` of ``n`` rows, by a hash of the key."""
    return F.pmod(F.xxhash64(F.lit("share"), key), F.lit(1 << 31)) < F.lit(math.ceil((1 << 31) * min(1.0, most / max(1, n))))


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    prior: float | None = None,
    max_positives: int = MAX_POSITIVES,
    max_unlabelled: int = MAX_UNLABELLED,
) -> Model:
    """Fit on documents outside the held-out fold.

    Positives are a share by id hash of about ``max_positives`` documents with
    a label 1 (never over twice that); unlabelled are a share of about
    ``max_unlabelled`` of all documents, labelled or not. Both bounds hold at
    any size of input. ``prior``, the share of label 1, is by default that of
    all learnable labels. A document with several labels counts as positive if
    any is 1; null labels and null ids are passed over. Rows that share an id are
    examples each. Null and empty texts are examples without features, very long
    ones are read whole, and an example is as large as its distinct words. Empty
    tables give the model without positives.
    """
    ship(docs.sparkSession)
    known = (
        labels.select(F.col(doc_id).alias("id"), F.col(label).alias("y"))
        .filter(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("y").alias("y"))
    )
    n, n_pos = known.agg(F.count("*"), F.count(F.when(F.col("y") == 1, 1))).first()
    if prior is None:
        prior = n_pos / n if n else 0.0
    learnable = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).filter(
        F.col("id").isNotNull() & ~held_out(F.col("id"))
    )
    buckets = F.pandas_udf(lambda s: pd.Series([sorted(features(t)) for t in s], dtype=object), "array<int>")

    def gathered(rows: DataFrame, most: int) -> list[np.ndarray]:
        found = rows.select(buckets("t").alias("f")).limit(2 * most).collect()
        return [np.array(r[0], dtype=np.int64) for r in found]

    # Bounded by max_positives, whatever the number of labels.
    chosen = known.filter((F.col("y") == 1) & _share(F.col("id"), n_pos, max_positives)).select("id").limit(2 * max_positives)
    positive = gathered(learnable.join(F.broadcast(chosen), "id", "left_semi"), max_positives)
    unlabelled = gathered(learnable.filter(_share(F.col("id"), learnable.count(), max_unlabelled)), max_unlabelled)
    return fit(positive, unlabelled, prior)


def score_documents(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 if at or over ``threshold``) to every row.

    Only the text is read, whole however long it is, so repeated rows score
    alike. Null and empty texts score by the bias alone. An empty table stays
    empty. Columns called ``score`` or ``predicted`` are replaced.
    """
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    score = F.pandas_udf(lambda s: pd.Series([held.value.score(t) for t in s], dtype="float64"), "double")
    return (
        docs.drop("score", "predicted")
        .withColumn("score", score(F.col(text)))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that a model trained on ``docs`` and ``labels`` does not predict as 1; same columns."""
    cols = docs.columns
    p, s = fresh_name(docs, "p"), fresh_name(docs, "s")
    model = train(docs, labels, doc_id, text, **options)
    held = docs.sparkSession.sparkContext.broadcast(model)
    score = F.pandas_udf(lambda x: pd.Series([held.value.score(t) for t in x], dtype="float64"), "double")
    return docs.withColumn(s, score(F.col(text))).withColumn(p, F.col(s) >= THRESHOLD).filter(~F.col(p)).select(*cols)
