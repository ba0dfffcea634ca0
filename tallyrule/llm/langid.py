"""Language identification by multilingual mixture inference.

Each language is a distribution over hashed byte n-grams. A document is a
mixture of languages: expectation-maximisation estimates its proportions from
the n-grams' likelihoods. Which languages take part is chosen by penalised
likelihood: languages join one at a time, best first, as long as the
log-likelihood gains more than the penalty of one more proportion.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrule.llm.common import fresh_name, held_out, ship

BITS = 15  # n-gram buckets: 32,768 for each language
ORDERS = (2, 3, 4)
SMOOTHING = 0.5
MAX_LANGUAGES = 512  # of a model, by default; more than asked for are refused, not cut
EM_STEPS = 25
UNKNOWN = "und"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def ngrams(text: str) -> np.ndarray:
    """Buckets of all byte n-grams of the lower-cased text, white space as one blank at either end."""
    b = np.frombuffer(b" " + b" ".join(text.lower().encode().split()) + b" ", dtype=np.uint8).astype(np.uint64)
    out = []
    for n in ORDERS:
        if b.size >= n:
            code = np.full(b.size - n + 1, n, dtype=np.uint64)
            for k in range(n):
                code = code << np.uint64(8) | b[k : b.size - n + 1 + k]
            out.append((code * _MIX >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(out) if out else np.empty(0, dtype=np.int64)


@dataclass
class Model:
    languages: list[str]
    likelihood: np.ndarray  # n-gram bucket by language; columns sum to one

    def proportions(self, text: str | None, penalty: float = 1.0) -> tuple[list[int], np.ndarray]:
        """Chosen languages and their proportions, which sum to one; none without a letter."""
        if not self.languages or not has_letter(text):
            return [], np.empty(0)
        counts = np.bincount(ngrams(text), minlength=1 << BITS)
        at = np.flatnonzero(counts)
        counts = counts[at].astype(np.float64)
        lik, total = self.likelihood[at], counts.sum()
        loglik = counts @ np.log(lik)
        chosen = [int(np.argmax(loglik))]
        share, best = np.ones(1), float(loglik[chosen[0]])
        # n-grams overlap, so each byte is counted once for the penalty's sample size
        cost = penalty * math.log(max(2.0, total / len(ORDERS))) * len(ORDERS)
        while len(chosen) < len(self.languages):
            mix = lik[:, chosen] @ share
            # gain of a little of each other language: the slope of the log-likelihood
            slope = (counts / mix) @ lik - total
            slope[chosen] = -np.inf
            nxt = int(np.argmax(slope))
            # The log-likelihood is concave: no proportions gain more than the slope.
            if slope[nxt] <= cost:
                break
            trial = [*chosen, nxt]
            share_, value = _em(lik[:, trial], counts, np.append(share * 0.9, 0.1))
            if value - best <= cost:
                break
            chosen, share, best = trial, share_, value
        return chosen, share

    def predict(self, text: str | None) -> tuple[str, float, list[str], list[float]]:
        """The largest language, its proportion, and all chosen with their proportions."""
        chosen, share = self.proportions(text)
        if not chosen:
            return UNKNOWN, 0.0, [], []
        order = sorted(range(len(chosen)), key=lambda k: (-share[k], self.languages[chosen[k]]))
        names = [self.languages[chosen[k]] for k in order]
        shares = [min(1.0, float(share[k])) for k in order]
        return names[0], shares[0], names, shares


def _em(lik: np.ndarray, counts: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float]:
    total = counts.sum()
    for _ in range(EM_STEPS):
        joint = lik * share
        new = counts @ (joint / joint.sum(axis=1, keepdims=True)) / total
        done = np.abs(new - share).max() < 1e-4
        share = new
        if done:
            break
    return share, float(counts @ np.log(lik @ share))


def train(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    max_languages: int = MAX_LANGUAGES,
) -> Model:
    """Count n-grams of every learnable text by language.

    Learnable are rows outside the held-out fold with a text and a language.
    Counts cover all of them: each task sums its rows to one vector a language,
    partial sums are added by bucket and packed to one row a language. A
    language takes 256 KB on the driver and in each worker, so more than
    ``max_languages`` are an error. Rows that repeat, by id or in all columns,
    count each time; very long texts count whole, and empty ones hold no more
    than blanks. Without any learnable row, as in an empty table, the model has
    no language and predicts ``und``. Other columns are not read.
    """
    ship(docs.sparkSession)
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(doc_id)))
    languages = sorted(r[0] for r in rows.select(lang).distinct().limit(max_languages + 1).collect())
    if len(languages) > max_languages:
        raise ValueError(f"over {max_languages} languages; raise max_languages (256 KB a language)")
    size = 1 << BITS

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for pdf in parts:
            for name, t in zip(pdf["l"], pdf["t"], strict=True):
                held = sums.setdefault(name, np.zeros(size, dtype=np.int64))
                held += np.bincount(ngrams(t), minlength=size)
        for name, held in sums.items():
            at = np.flatnonzero(held)
            yield pd.DataFrame({"lang": name, "bucket": at.astype(np.int32), "n": held[at]})

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        held = np.zeros(size, dtype=np.int64)
        held[pdf["bucket"].to_numpy()] = pdf["n"].to_numpy()
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "counts": [held.tobytes()]})

    packed = (
        rows.select(F.col(lang).alias("l"), F.col(text).alias("t"))
        .mapInPandas(count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")  # at most one row a bucket
        .applyInPandas(pack, "lang string, counts binary")
    )
    n = np.full((size, len(languages)), SMOOTHING)
    column = {name: k for k, name in enumerate(languages)}
    for r in packed.toLocalIterator():
        n[:, column[r["lang"]]] += np.frombuffer(r["counts"], dtype=np.int64)
    n /= n.sum(axis=0)
    return Model(languages, n)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score``, ``langs`` and ``shares`` to every row, from the text alone.

    ``langs`` are the chosen languages with their proportions in ``shares``,
    largest first (equal ones by name); ``lang_pred`` is the first and
    ``score`` its proportion. A text that is null, empty or without a letter
    is ``und`` with score 0. Very long texts are read whole, rows that repeat
    are judged alike and an empty table stays empty. Columns with the four names
    are replaced.
    """
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score", "langs", "shares")
    m = fresh_name(docs, "m")

    @F.pandas_udf("lang_pred string, score double, langs array<string>, shares array<double>")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = [held.value.predict(t) for t in texts]
        return pd.DataFrame(rows, columns=["lang_pred", "score", "langs", "shares"])

    out = docs.withColumn(m, run(F.col(text)))
    return out.select(*docs.columns, *[F.col(m)[c].alias(c) for c in ("lang_pred", "score", "langs", "shares")])
