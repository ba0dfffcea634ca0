"""Periodic runs of words, found by minimizers at several scales.

A run is a stretch of consecutive words in which words ``period`` apart are
identical, as long as it can be, at least four periods and six words long.

Periods above :data:`SHORT` are found at scales ``Q = 16, 32, 64, ...``: the scale
answers for periods from ``Q / 2 + 1`` to ``Q``. Its seeds are the hashes of ``Q``
words in a row, and its minimizers those that are least in some window of
``Q / 2`` seeds, ties included. Inside a run of period ``q`` a window and the one
``q`` later hold the same seeds and fit both (``Q / 2 + q + Q - 1 <= 4 q``), so
the window minima repeat at distance ``q``; a seed of ``q`` words or more cannot
come back sooner without giving the run a smaller period. Neighbouring places of
equal minimizers are therefore all a scale needs to look at: each pair is
extended both ways by comparing words. Periods up to :data:`SHORT` have too few
words for a seed and are scanned lag by lag.

Documents are independent, so nothing is shuffled. The texts of a slice of rows
are scanned as one array, with a word between them that equals no other; slices
are bounded in rows and bytes, so memory follows the longest single text.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrule.llm.common import ship

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
SHORT = 8  # periods up to here are scanned lag by lag
SLICE_ROWS, SLICE_BYTES = 512, 4 << 20

RUNS = T.ArrayType(
    T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")]), False
)


def words_of(text: str | None) -> list[bytes]:
    """Words are what lies between the six ASCII blanks, unchanged; a null text has none."""
    return text.encode().split() if text else []


# stretches of equal words at a lag


def _least(period: int) -> int:
    return max(LEAST_LENGTH, LEAST_EXPONENT * period)


def _smallest(x: np.ndarray, start: int, period: int) -> bool:
    """Whether a stretch has no smaller period: over four periods long, it could only be a divisor."""
    rest, f = period, 2
    while rest > 1:
        if f * f > rest:
            f = rest
        if rest % f == 0:
            d, end = period // f, start + 2 * period
            if np.array_equal(x[start : end - d], x[start + d : end]):
                return False
            while rest % f == 0:
                rest //= f
        f += 1
    return True


def _scan_lag(x: np.ndarray, lag: int) -> Iterator[tuple[int, int, int]]:
    at = np.flatnonzero(x[lag:] == x[:-lag])
    if len(at) == 0:
        return
    breaks = np.flatnonzero(np.diff(at) != 1)
    first, last = at[np.r_[0, breaks + 1]], at[np.r_[breaks, len(at) - 1]]
    length = last - first + 1 + lag
    for k in np.flatnonzero(length >= _least(lag)):
        if _smallest(x, int(first[k]), lag):
            yield int(first[k]), int(length[k]), lag


def _extend(x: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The places around ``at`` whose word is also ``lag`` later: ``[from, to)``, empty if ``at`` is none."""
    to, end, size = at, len(x) - lag, 64
    while to < end:
        stop = min(to + size, end)
        other = np.flatnonzero(x[to:stop] != x[to + lag : stop + lag])
        if len(other):
            to += int(other[0])
            break
        to, size = stop, 2 * size
    start, size = at, 64
    while start > 0:
        stop = max(start - size, 0)
        other = np.flatnonzero(x[stop:start] != x[stop + lag : start + lag])
        if len(other):
            start = stop + int(other[-1]) + 1
            break
        start, size = stop, 2 * size
    return start, to


# minimizers


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * np.uint64(0x9E3779B97F4A7C15) + b
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _sliding(h: np.ndarray, window: int, pick) -> np.ndarray:
    """``pick`` over every ``window`` neighbours; ``window`` is a power of two."""
    done = 1
    while done < window:
        h = pick(h[:-done], h[done:])
        done *= 2
    return h


def _minimizers(h: np.ndarray, window: int) -> np.ndarray:
    """Places whose seed is the least of some window that holds them."""
    least = _sliding(h, window, np.minimum)
    edge = np.zeros(window - 1, np.uint64)
    return np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), window, np.maximum) == h)


def _scan_scale(x: np.ndarray, seeds: np.ndarray, scale: int) -> Iterator[tuple[int, int, int]]:
    at = _minimizers(seeds, scale // 2)
    order = at[np.argsort(seeds[at], kind="stable")]
    lag = np.diff(order)
    pair = np.flatnonzero((seeds[order[1:]] == seeds[order[:-1]]) & (lag > scale // 2) & (lag <= scale))
    places, lags = order[pair], lag[pair]
    lag_before = done = -1
    for k in np.lexsort((places, lags)):
        p, d = int(places[k]), int(lags[k])
        if d == lag_before and p < done:
            continue  # this stretch has been measured
        start, to = _extend(x, p, d)
        lag_before, done = d, to
        if to > start and to - start + d >= _least(d) and _smallest(x, start, d):
            yield start, to - start + d, d


def find_runs_in(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of all runs of each text, by start and period."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    # Longest first, so that the texts long enough for a scale are the head of the array.
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    sizes = np.array([len(texts[k]) for k in order], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)]) + 1  # one dividing word before each
    ids: dict[bytes, int] = defaultdict(count().__next__)
    x = np.empty(int(begins[-1]), np.int64)
    x[begins - 1] = -1 - np.arange(len(begins))
    for k, at, n in zip(order, begins, sizes):
        x[at : at + n] = np.fromiter(map(ids.__getitem__, texts[k]), np.int64, n)

    def head(period: int) -> int:
        """Length of the array up to the last text that may have the period."""
        return int(begins[np.searchsorted(-sizes, -_least(period), side="right")])

    def keep(runs: Iterator[tuple[int, int, int]]) -> None:
        for start, length, period in runs:
            k = int(np.searchsorted(begins, start, side="right")) - 1
            found[order[k]].append((start - int(begins[k]), length, period))

    for lag in range(1, SHORT + 1):
        part = x[: head(lag)]
        if len(part) > lag:
            keep(_scan_lag(part, lag))
    seeds, width, scale = _mixed(x.view(np.uint64), x.view(np.uint64) >> np.uint64(7)), 1, 2 * SHORT
    while (size := head(scale // 2 + 1)) > 1:
        while width < scale:
            seeds = _mixed(seeds[:-width], seeds[width:])
            width *= 2
        seeds = seeds[: size - width + 1]
        keep(_scan_scale(x[:size], seeds, scale))
        scale *= 2
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run holds after its first period, joined by one space."""
    if runs:
        gone = np.zeros(len(words), bool)
        for start, length, period in runs:
            gone[start + period : start + length] = True
        words = [words[k] for k in np.flatnonzero(~gone)]
    return b" ".join(words).decode()


def repeat_tail(key: int | None, words: list[bytes]) -> list[bytes]:
    """Plants a run: of a tenth of the keys, every word from a place on becomes one of a few, in turn.

    Place and period come from the CRC-32 of the key in decimal digits. A null key changes nothing.
    """
    h, n = (1 if key is None else zlib.crc32(str(key).encode())), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[: n - a]


def _slices(batch: pa.RecordBatch, at: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    texts, start, held = batch.column(at).to_pylist(), 0, 0
    for k, t in enumerate(texts):
        held += len(t or "")
        if k + 1 == len(texts) or k + 1 - start == SLICE_ROWS or held >= SLICE_BYTES:
            yield batch.slice(start, k + 1 - start), texts[start : k + 1]
            start, held = k + 1, 0


def _mapped(docs: DataFrame, text: str, collapse: bool, edit, key: str | None) -> DataFrame:
    ship(docs.sparkSession)
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "runs"])
    at, names = docs.columns.index(text), docs.columns
    key_at = None if key is None else names.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _slices(batch, at):
                words = [words_of(t) for t in texts]
                if edit is not None:
                    keys = [None] * len(words) if key_at is None else part.column(key_at).to_pylist()
                    words = [edit(k, w) for k, w in zip(keys, words)]
                runs = find_runs_in(words)
                columns = list(part.columns)
                if collapse:
                    columns[at] = pa.array([collapsed(w, r) for w, r in zip(words, runs)], pa.string())
                ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
                flat = np.array([r for rs in runs for r in rs], np.int64).reshape(-1, 3)
                values = pa.StructArray.from_arrays(
                    [pa.array(flat[:, j]) for j in range(3)], names=["start", "length", "period"]
                )
                columns.append(pa.ListArray.from_arrays(pa.array(ends), values))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "runs"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("runs", RUNS, False)]))


def find_runs(
    docs: DataFrame,
    text: str = "text",
    edit: Callable[[object, list[bytes]], list[bytes]] | None = None,
    key: str | None = None,
) -> DataFrame:
    """Add ``runs``: every run of the whole text as ``(start, length, period)`` in words, by start and period.

    Periods are smallest periods. Null, empty and blank texts have no runs.
    Every row is answered by itself, so repeated rows and rows that share a key
    get equal answers; an empty table gives an empty result. Other columns pass
    through, one called ``runs`` is replaced. ``edit(key, words)`` changes the
    words before they are searched. A very long text is searched whole, in the
    task that holds its row: time follows its length (with a factor for each
    doubling), memory is some hundred bytes a word.
    """
    return _mapped(docs, text, False, edit, key)


def collapse_runs(
    docs: DataFrame,
    text: str = "text",
    edit: Callable[[object, list[bytes]], list[bytes]] | None = None,
    key: str | None = None,
) -> DataFrame:
    """As :func:`find_runs`; the text keeps of each run its first period only.

    A word goes if any run holds it after that run's first ``period`` words.
    The words that stay are joined by one space; a null text becomes empty.
    """
    return _mapped(docs, text, True, edit, key)
