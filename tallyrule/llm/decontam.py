"""Benchmark decontamination by generalised suffix automata of the items.

Equal items are one sequence of words. Sequences are dealt by hash into small
blocks; a task builds the automaton of one block. It reads words and keeps, at
every word, the longest suffix that occurs in some item. Where that length
reaches the window, the last words are a window of an item; the automaton's
states name the items. Items shorter than a window count as a whole.

Only stretches of documents meet the blocks. A bitmap of the hashes of all
windows, of bounded size, finds where a window may lie; each distinct stretch
goes to the blocks that hold one of its hashes, and what a block's automaton
finds goes back to the stretch's places. A false hit of the bitmap costs a
stretch that no block finds; a missed window cannot occur.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrule.llm.common import fresh_name, ship, staged

WINDOW = 10
COVERAGE = 0.9  # share of hit words from which a document goes
MAX_BLOCK_BYTES = 256 << 10  # item text in one automaton
GROUP_BYTES = 4 << 20  # stretches that one building of an automaton reads
MAX_FILTER_BITS = 1 << 27  # 16 MB in every worker
SLICE_BITS = 1 << 13  # of the bitmap, made by one group
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

# Word bytes: digits, a-z after lower-casing, and everything beyond ASCII.
_WORD = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+")
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


class _WordHashes(dict):
    """64-bit hashes of words; emptied when it is full, so memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def words(text: str | None) -> list[bytes]:
    """Normalised words of a whole text."""
    return (text or "").encode().translate(_TABLE).split()


class ItemAutomaton:
    """Generalised suffix automaton over the items' word ids."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.names = [name for name, _ in items]
        seqs = [[self.ids.setdefault(w, len(self.ids)) for w in words(text)] for _, text in items]
        for seq in seqs:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        self.windows: dict[int, set[int]] = {}
        self.whole: dict[int, list[tuple[int, int]]] = {}
        for k, seq in enumerate(seqs):
            s = 0
            for at, c in enumerate(seq):
                s = self.next[s][c]
                if at + 1 >= window:
                    self.windows.setdefault(self._suffix(s, window), set()).add(k)
            if 0 < len(seq) < window:
                self.whole.setdefault(self._suffix(s, len(seq)), []).append((len(seq), k))
        # every whole short item that ends where a state ends
        self.short = [[] for _ in self.next]
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.short[s] = self.short[self.link[s]] + self.whole.get(s, [])
        self.least = min([window, *(len(s) for s in seqs if s)])
        pairs = {a * len(self.ids) + b for seq in seqs for a, b in zip(seq, seq[1:])}
        self.pairs = np.array(sorted(pairs) or [-1], dtype=np.int64)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if (q := nxt[last].get(c)) is not None:
            return q if length[q] == length[last] + 1 else self._split(last, q, c)
        cur = self._state({}, length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p == -1:
            link[cur] = 0
        else:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, q, c)
        return cur

    def _state(self, arcs: dict[int, int], length: int) -> int:
        self.next.append(arcs)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        """A copy of ``q`` for the shorter words that reach it from ``p``."""
        copy = self._state(dict(self.next[q]), self.length[p] + 1)
        self.link[copy], self.link[q] = self.link[q], copy
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _suffix(self, s: int, n: int) -> int:
        """The state of the last ``n`` words of state ``s``."""
        while self.length[self.link[s]] >= n:
            s = self.link[s]
        return s

    def _stretches(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Where a window may lie: runs of words of which each adjacent pair is in some item."""
        known = ids >= 0
        if self.least == 1:
            ok, extra = known, 0
        else:
            codes = ids[:-1] * len(self.ids) + ids[1:]
            at = np.searchsorted(self.pairs, codes)
            ok = known[:-1] & known[1:] & (self.pairs[np.minimum(at, self.pairs.size - 1)] == codes)
            extra = 1
        edges = np.flatnonzero(np.diff(np.concatenate(([0], ok.astype(np.int8), [0]))))
        runs = edges.reshape(-1, 2)
        runs = runs[runs[:, 1] - runs[:, 0] + extra >= self.least]
        return [(int(a), int(b) + extra) for a, b in runs]

    def match(self, doc: list[bytes]) -> tuple[list[tuple[int, int]], set[int], int]:
        """Hit spans as ``[from, to)`` in order, the items found, and the longest match that holds a window."""
        get = self.ids.get
        ids = np.fromiter((get(w, -1) for w in doc), dtype=np.int64, count=len(doc))
        spans: list[list[int]] = []
        found: set[int] = set()
        longest = 0
        for a, b in self._stretches(ids) if len(doc) >= self.least else ():
            s = n = 0
            for at, c in enumerate(ids[a:b].tolist(), a):
                while s and c not in self.next[s]:
                    s = self.link[s]
                    n = self.length[s]
                t = self.next[s].get(c)
                if t is None:
                    continue
                s, n = t, n + 1
                lengths = [m for m, _ in self.short[s] if m <= n]
                found.update(k for m, k in self.short[s] if m <= n)
                if n >= self.window:
                    found |= self.windows.get(self._suffix(s, self.window), set())
                    lengths.append(self.window)
                if lengths:
                    longest = max(longest, n if n >= self.window else max(lengths))
                    start = at + 1 - max(lengths)
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append([start, at + 1])
        return [tuple(s) for s in spans], found, longest


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the characters from each span's first word to its last."""
    places = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return "".join(out) + text[at:]


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def word_hashes(doc: list[bytes], cache: _WordHashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, doc), dtype=np.uint64, count=len(doc))


def grams(w: np.ndarray, lengths: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each of ``lengths`` that fits: the hashes of all runs of so many words, in order."""
    h = np.zeros(w.size + 1, dtype=np.uint64)
    for n in range(1, min(max(lengths, default=0), w.size) + 1):
        h = h[:-1] * np.uint64(_ODD[0]) + w[n - 1 :]
        if n in lengths:
            yield n, h ^ h >> np.uint64(32)


def filter_places(h: np.ndarray, n_bits: int) -> np.ndarray:
    """The bits of each hash, one row a probe; ``n_bits`` is a power of two."""
    shift = np.uint64(65 - n_bits.bit_length())
    return np.stack([h * np.uint64(odd) >> shift for odd in _ODD])


def may_hold(h: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    out = np.ones(h.size, dtype=bool)
    for at in filter_places(h, 8 * bitmap.size):
        out &= (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return out


def stretches(w: np.ndarray, lengths: set[int], bitmap: np.ndarray) -> list[tuple[int, int, list[int]]]:
    """Runs ``[from, to)`` of words in windows that the bitmap lets pass, and the hashes of these windows."""
    starts, hashes = [], []
    edge = np.zeros(w.size + 1, dtype=np.int64)
    for n, h in grams(w, lengths):
        at = np.flatnonzero(may_hold(h, bitmap))
        if at.size:
            edge[at] += 1
            edge[at + n] -= 1
            starts.append(at)
            hashes.append(h[at])
    if not starts:
        return []
    inside = np.cumsum(edge) > 0
    runs = np.flatnonzero(np.diff(np.concatenate(([False], inside)).astype(np.int8))).reshape(-1, 2)
    owner = np.searchsorted(runs[:, 0], np.concatenate(starts), side="right") - 1
    h = np.concatenate(hashes).view(np.int64)
    return [(int(a), int(b), np.unique(h[owner == k]).tolist()) for k, (a, b) in enumerate(runs)]


def item_sequences(items: DataFrame, item_id: str, text: str, max_bytes: int) -> DataFrame:
    """``(sid, block, seq, names)``: one row per distinct sequence of words, with the ids of its items."""
    spark = items.sparkSession
    size = items.agg(F.sum(F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 64)).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // max_bytes))
    normal = F.pandas_udf(lambda s: pd.Series([b" ".join(words(t)).decode() for t in s], dtype=object), "string")
    rows = items.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("None")).alias("name"), normal(F.col(text)).alias("seq")
    ).filter("seq != ''")
    return staged(
        rows.groupBy("seq")
        .agg(F.collect_set("name").alias("names"))
        .select(
            F.monotonically_increasing_id().alias("sid"),
            F.pmod(F.xxhash64("seq"), F.lit(n)).cast("int").alias("block"),
            "seq",
            "names",
        ),
        "sequences",
    )


def item_grams(sequences: DataFrame, window: int) -> DataFrame:
    """``(h, n, block)``: the hashes of all windows of a block, ``n`` words each."""

    def windows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = _WordHashes()
        for pdf in parts:
            for block, seq in zip(pdf["block"], pdf["seq"], strict=True):
                w = word_hashes(seq.encode().split(), cache)
                for n, h in grams(w, {min(window, w.size)}):
                    yield pd.DataFrame({"h": np.unique(h).view(np.int64), "n": n, "block": block})

    found = sequences.select("block", "seq").mapInPandas(windows, "h long, n int, block int")
    return staged(found.distinct(), "grams")


def filter_bitmap(hashes: DataFrame) -> np.ndarray:
    """Bitmap of the column ``h``: 16 bits a row or more, up to ``MAX_FILTER_BITS``; made in slices by Spark tasks."""
    n_bits = 8 * SLICE_BITS
    rows = hashes.count()
    while n_bits < min(16 * rows, MAX_FILTER_BITS):
        n_bits *= 2

    def places(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            at = np.unique(filter_places(pdf["h"].to_numpy(np.int64).view(np.uint64), n_bits)).astype(np.int64)
            yield pd.DataFrame({"part": at // SLICE_BITS, "bit": at % SLICE_BITS})

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(SLICE_BITS, dtype=np.uint8)
        bits[pdf["bit"].to_numpy()] = 1
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    found = hashes.select("h").mapInPandas(places, "part int, bit int").distinct()
    out = np.zeros(n_bits // 8, dtype=np.uint8)
    for part, bits in found.groupBy("part").applyInPandas(pack, "part int, bits binary").collect():
        out[part * SLICE_BITS // 8 : (part + 1) * SLICE_BITS // 8] = np.frombuffer(bits, np.uint8)
    return out


_SPANS = "array<struct<from: int, to: int>>"
_MARK = "n_words long, runs array<struct<at: int, run: string, hs: array<bigint>>>"
_CUT = "text string, clean boolean"


def _match_runs(runs: DataFrame, sequences: DataFrame, held: DataFrame, window: int) -> DataFrame:
    """``(run, spans, names, longest)`` of each distinct run in which some block finds a window."""
    pairs = staged(
        runs.select("run", "hs")
        .distinct()
        .select("run", F.explode("hs").alias("h"))
        .join(held.select("h", "block"), "h")
        .select("run", "block")
        .distinct(),
        "pairs",
    )
    # A block that very many stretches ask is built several times, each time for a part of them.
    loads = staged(
        pairs.groupBy("block").agg((F.sum(F.octet_length("run")) / GROUP_BYTES + 1).cast("int").alias("salts")), "loads"
    )
    asked = pairs.join(loads, "block").select("block", F.pmod(F.xxhash64("run"), "salts").cast("int").alias("salt"), "run")
    built = sequences.join(loads, "block").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "sid", "seq"
    )

    def match(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(left) and len(right):
            automaton = ItemAutomaton(list(zip(right["sid"], right["seq"])), window)
            for run in left["run"]:
                spans, found, longest = automaton.match(run.encode().split())
                if spans:
                    sids = [int(automaton.names[k]) for k in found]
                    rows.append((run, [{"from": a, "to": b} for a, b in spans], sids, longest))
        return pd.DataFrame(rows, columns=["run", "spans", "sids", "longest"])

    found = staged(
        asked.groupBy("block", "salt")
        .cogroup(built.groupBy("block", "salt"))
        .applyInPandas(match, f"run string, spans {_SPANS}, sids array<bigint>, longest int"),
        "matches",
    )

    @F.pandas_udf(_SPANS)
    def merge(lists: pd.Series) -> pd.Series:
        merged = [_merge([(s["from"], s["to"]) for s in spans]) for spans in lists]
        return pd.Series([[{"from": a, "to": b} for a, b in spans] for spans in merged], dtype=object)

    names = (
        found.select("run", F.explode("sids").alias("sid"))
        .join(sequences.select("sid", "names"), "sid")
        .groupBy("run")
        .agg(F.array_distinct(F.flatten(F.collect_list("names"))).alias("names"))
    )
    spans = found.groupBy("run").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.max("longest").alias("longest")
    )
    return staged(spans.join(names, "run").select("run", merge("spans").alias("spans"), "names", "longest"), "found")


def _find(
    docs: DataFrame, items: DataFrame, text: str, item_id: str, item_text: str, window: int, max_bytes: int, f: str
) -> DataFrame:
    """``docs`` with a struct column ``f`` of ``n_words``, ``hits``, ``items`` and ``longest``."""
    spark = docs.sparkSession
    sequences = item_sequences(items, item_id, item_text, max_bytes)
    held = item_grams(sequences, window)
    lengths = {r["n"] for r in held.select("n").distinct().collect()}  # at most ``window`` numbers
    bitmap = spark.sparkContext.broadcast(filter_bitmap(held))

    @F.pandas_udf(_MARK)
    def mark(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cache = _WordHashes()
        for texts in parts:
            rows = []
            for t in texts:
                doc = words(t)
                found = stretches(word_hashes(doc, cache), lengths, bitmap.value)
                rows.append(
                    (len(doc), [{"at": a, "run": b" ".join(doc[a:b]).decode(), "hs": hs} for a, b, hs in found])
                )
            yield pd.DataFrame(rows, columns=["n_words", "runs"])

    m, r = fresh_name(docs, "m"), fresh_name(docs, "r")
    # The row numbers are written, so they stay the same.
    marked = staged(docs.withColumn(m, mark(F.col(text))).withColumn(r, F.monotonically_increasing_id()), "marked")
    some = F.size(F.col(m)["runs"]) > 0
    runs = marked.filter(some).select(F.col(r).alias("r"), F.explode(F.col(m)["runs"]).alias("x")).select("r", "x.*")
    found = _match_runs(runs, sequences, held, window)

    shifted = F.transform("spans", lambda s: F.struct((s["from"] + F.col("at")).alias("from"), (s["to"] + F.col("at")).alias("to")))
    by_row = (
        runs.select("r", "at", "run")
        .join(found, "run")
        .groupBy(F.col("r").alias(r))
        .agg(
            F.array_sort(F.flatten(F.collect_list(shifted))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("items"),
            F.max("longest").alias("longest"),
        )
        .select(r, F.struct("hits", "items", "longest").alias(f))
    )

    def told(hits, names, longest):
        return F.struct(
            F.col(m)["n_words"].alias("n_words"),
            F.coalesce(hits, F.array().cast(_SPANS)).alias("hits"),
            F.coalesce(names, F.array().cast("array<string>")).alias("items"),
            F.coalesce(longest, F.lit(0)).alias("longest"),
        )

    none = told(F.lit(None).cast(_SPANS), F.lit(None).cast("array<string>"), F.lit(None).cast("int"))
    clean = marked.filter(~some).select(*docs.columns, none.alias(f))
    dirty = marked.filter(some).join(by_row, r, "left")
    return clean.unionByName(
        dirty.select(*docs.columns, told(F.col(f)["hits"], F.col(f)["items"], F.col(f)["longest"]).alias(f))
    )


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_bytes: int = MAX_BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (word spans ``from``, ``to``), ``items`` and ``longest``.

    Words are runs of digits, letters A-Z (lower-cased) and characters beyond
    ASCII. A window is ``window`` consecutive words of an item; an item with
    fewer words, but not none, is one window. A word inside any occurrence of
    a window is hit; ``hits`` are the maximal spans of hit words, ``items``
    the sorted ids, as strings, of items with an occurring window. ``longest``
    is the longest match, in words, that holds a window (0 if there is none).
    Null and empty texts have no words; items without words match nothing; a
    null item id is the string ``None``. Other columns pass through; columns
    with the four names are replaced.

    The items' size is measured first, and blocks have about ``max_bytes`` of
    item text or less. No item reaches the driver, and a worker holds one
    block's automaton at a time; of all items, only the bitmap of their
    windows' hashes, at most ``MAX_FILTER_BITS``, goes everywhere.
    """
    ship(docs.sparkSession)
    docs = docs.drop("n_words", "hits", "items", "longest")
    f = fresh_name(docs, "f")
    out = _find(docs, items, text, item_id, item_text, window, max_bytes, f)
    return out.select(*docs.columns, *[F.col(f)[c].alias(c) for c in ("n_words", "hits", "items", "longest")])


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def remove_contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_bytes: int = MAX_BLOCK_BYTES,
    coverage: float = COVERAGE,
) -> DataFrame:
    """``docs`` with every hit span cut from ``text``; other columns unchanged.

    The cut runs from the first character of a span's first word to the last
    of its last. Documents without a hit are untouched. A document goes if the
    share of its words that are hit is ``coverage`` or more; with 1, only one
    whose words are all hit.
    """
    ship(docs.sparkSession)
    f, m = fresh_name(docs, "f"), fresh_name(docs, "m")
    found = _find(docs, items, text, item_id, item_text, window, max_bytes, f)

    def cut(texts: pd.Series, n_words: pd.Series, hits: pd.Series) -> pd.DataFrame:
        rows = []
        for t, n, found in zip(texts, n_words, hits, strict=True):
            spans = [(s["from"], s["to"]) for s in found]
            clean = not spans or sum(b - a for a, b in spans) < coverage * n
            rows.append((cut_spans(t, spans) if spans and clean else t, clean))
        return pd.DataFrame(rows, columns=["text", "clean"])

    # Declared nondeterministic so that the filter is not pushed below it and the texts cut twice.
    cutter = F.pandas_udf(cut, _CUT).asNondeterministic()
    kept = found.withColumn(m, cutter(F.col(text), F.col(f)["n_words"], F.col(f)["hits"])).filter(F.col(m)["clean"])
    return kept.select(*[F.col(m)["text"].alias(c) if c == text else F.col(c) for c in docs.columns])
