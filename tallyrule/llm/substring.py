"""Substring dedup by relative Lempel-Ziv parsing against blocks of reference text.

Three steps, each one shuffle:

1. *Which blocks.* The hashes of all windows of ``min_words`` words meet by
   hash, and each window that an earlier document has learns one such source.
   This only routes: a document is sent to the reference blocks that hold one of
   its windows, not to all, and a block need hold no text that nobody asks for.
2. *Parse.* A reference block holds the asked stretches of the documents dealt to
   it, indexed by a suffix array over word numbers with the document of every
   suffix. Each stretch sent there is factored greedily: the longest match that a
   smaller document id has is a factor, and the parse goes on behind it. Factors
   of ``min_words`` or more are duplicates; the windows across a factor's end,
   which lie in no factor, are looked up one by one.
3. *Cut.* The factors come back to their document, and the words that they cover go.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrule.llm.common import fresh_name, ship

MIN_WORDS = 13
BLOCK_BYTES = 16 << 20  # corpus text for one block of hashes, or of references
CHUNK_SEEDS = 1 << 20  # seeds held at once by a reading task
NO_ID = 1 << 40  # version of rows without an id; others are 32-bit hashes
FAN = 64  # documents of one window that a block sends to the same source
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)

_ASKED = "block int, ids binary, texts binary, counts binary, places binary, seeds binary, sources binary"
_FOUND = "part int, ids binary, texts binary, counts binary, places binary, sources binary"
_STRETCH = "block int, doc long, version long, place int, words string, asks boolean"


def seeds(words: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """For every run of ``size`` words, in order: its hash, and a second one that chooses its block."""
    if len(words) < size:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    w = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), dtype=np.uint64)
    h, g = (_polynomials(w, size, odd) for odd in _ODD[:2])
    return h, (g ^ g >> np.uint64(29)) * np.uint64(_ODD[2]) >> np.uint64(32)


def _polynomials(w: np.ndarray, size: int, odd: int) -> np.ndarray:
    """The sum of ``w[i + k] * odd ** (size - 1 - k)`` for every run of ``size`` numbers, by doubling the length."""
    h, n = w, 1
    for bit in f"{size:b}"[1:]:
        h = h[:-n] * np.uint64(pow(odd, n, 1 << 64)) + h[n:]
        n *= 2
        if bit == "1":
            h = h[:-1] * np.uint64(odd) + w[n:]
            n += 1
    return h


def _pack(a: np.ndarray) -> bytes:
    """Small or rising numbers as compressed differences, equal bytes of neighbours together."""
    d = np.diff(a, prepend=a.dtype.type(0))
    z = zlib.compressobj(1, strategy=zlib.Z_RLE)
    return z.compress(np.ascontiguousarray(d.view(np.uint8).reshape(d.size, -1).T).tobytes()) + z.flush()


def _short(h: np.ndarray) -> bytes:
    """The low seven bytes of every seed; its block gives the rest."""
    return np.ascontiguousarray(h.view(np.uint8).reshape(-1, 8)[:, :7]).tobytes()


def _seeds_of(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 7, 8), dtype=np.uint8)
    out[:, :7] = np.frombuffer(b, np.uint8).reshape(-1, 7)
    return out.reshape(-1).view(np.uint64)


def _unpack(b: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(b), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view(kind), dtype=kind)


def _part(doc: np.ndarray, parts: int) -> np.ndarray:
    """The part of the documents, and the reference block, that an id belongs to."""
    return ((doc.astype(np.uint64) * np.uint64(_ODD[0]) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _changes(doc: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Where the next document begins."""
    new = np.ones(doc.size, dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (text[1:] != text[:-1])
    return new


# --- step 1: which reference blocks hold a document's windows --------------------------


def _questions(chunk: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]], blocks: int) -> pd.DataFrame:
    """One row for each block that the chunk's seeds fall in, and for each part of the documents with settled seeds.

    A document has each of its seeds once. Seeds that an earlier document of
    the same chunk has are settled here, with that document as their source:
    they need no answer and go, without their hash, to the block that is their
    documents' part, as do the places of the sources. So a seed that very many
    documents share reaches its own block once per chunk.
    """
    chunk.sort(key=lambda x: x[0])
    ids = np.array([x[0] for x in chunk], dtype=np.int64)
    texts = np.array([x[1] for x in chunk], dtype=np.int32)
    sizes = np.array([x[2].size for x in chunk])
    h = np.concatenate([x[2] for x in chunk])
    block = (np.concatenate([x[3] for x in chunk]) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
    row = np.repeat(np.arange(ids.size), sizes)
    place = np.concatenate([x[4] for x in chunk]).astype(np.int32)
    order = np.argsort(h, kind="stable")
    new = np.concatenate(([True], h[order][1:] != h[order][:-1]))
    first = np.empty(h.size, dtype=np.int64)
    first[order] = order[new][np.cumsum(new) - 1]  # earliest place in the chunk of the same seed
    known = ids[row] > ids[row[first]]
    given = np.unique(first[known])
    home = _part(ids, blocks)

    out = []
    for some, where, kind in (
        (np.flatnonzero(~known), block[~known], "seeds"),
        (np.flatnonzero(known), home[row[known]], "asks"),
        (given, home[row[given]], "gives"),
    ):
        by = np.argsort(where, kind="stable")
        some, where = some[by], where[by]
        for a, b in _slices(where):
            q = some[a:b]
            at = np.flatnonzero(np.diff(row[q], prepend=-1))
            of = row[q][at]
            counts = np.diff(at, append=q.size).astype(np.int32)
            head = (int(where[a]), _pack(ids[of]), texts[of].tobytes(), _pack(counts), _pack(place[q]))
            out.append((*head, _short(h[q]) if kind == "seeds" else None, _pack(ids[row[first[q]]]) if kind == "asks" else None))
    return pd.DataFrame(out, columns=["block", "ids", "texts", "counts", "places", "seeds", "sources"])


def _slices(a: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of equal neighbours."""
    cuts = (np.flatnonzero(np.diff(a)) + 1).tolist() if a.size else []
    return list(zip([0, *cuts], [*cuts, a.size], strict=True)) if a.size else []


def _answers(pdf: pd.DataFrame, parts: int, fan: int = FAN) -> pd.DataFrame:
    """Of one block: the places of seeds that a smaller id has, with a source, and the sources' places, by part of the documents.

    The first ``fan`` documents behind a seed's first one have it as source,
    the next ones the second, and so on, so that no document serves more than
    ``fan`` others. Settled rows pass through as they are.
    """
    known = pdf["seeds"].isna()
    settled = pdf[known].rename(columns={"block": "part"})[["part", "ids", "texts", "counts", "places", "sources"]]
    pdf = pdf[~known]
    if pdf.empty:
        return settled
    doc, text, place = _opened(pdf)
    seed = np.concatenate([_seeds_of(h) for h in pdf["seeds"]])
    order = np.lexsort((text, doc, seed))
    doc, text, place, seed = doc[order], text[order], place[order], seed[order]
    start = np.ones(seed.size, dtype=bool)
    start[1:] = seed[1:] != seed[:-1]
    group = np.cumsum(start) - 1
    fresh = start.copy()
    fresh[1:] |= doc[1:] != doc[:-1]
    nth = np.cumsum(fresh) - 1  # documents of all groups, numbered through
    head = np.flatnonzero(fresh)  # first entry of each of them
    begin = nth[np.flatnonzero(start)][group]
    place_in_group = nth - begin
    hit = np.flatnonzero(place_in_group > 0)
    source = head[begin[hit] + (place_in_group[hit] - 1) // fan]
    out = _packed(doc[hit], text[hit], place[hit], doc[source], parts)
    given = np.unique(source)
    out += _packed(doc[given], text[given], place[given], None, parts)
    return pd.concat([settled, pd.DataFrame(out, columns=settled.columns)])


def _packed(doc: np.ndarray, text: np.ndarray, place: np.ndarray, source: np.ndarray | None, parts: int) -> list[tuple]:
    """Places by part of their documents, packed."""
    part = _part(doc, parts)
    by = np.lexsort((place, text, doc, part))
    doc, text, place, part = doc[by], text[by], place[by], part[by]
    out = []
    for a, b in _slices(part):
        at = a + np.flatnonzero(_changes(doc[a:b], text[a:b]))
        counts = np.diff(at, append=b).astype(np.int32)
        sources = None if source is None else _pack(source[by[a:b]])
        out.append((int(part[a]), _pack(doc[at]), text[at].tobytes(), _pack(counts), _pack(place[a:b]), sources))
    return out


def _opened(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, version and place of every seed in packed rows."""
    counts = [_unpack(c, np.int32) for c in pdf["counts"]]
    doc = [np.repeat(_unpack(x, np.int64), n) for x, n in zip(pdf["ids"], counts, strict=True)]
    text = [np.repeat(np.frombuffer(x, np.int32), n) for x, n in zip(pdf["texts"], counts, strict=True)]
    return np.concatenate(doc), np.concatenate(text), np.concatenate([_unpack(x, np.int32) for x in pdf["places"]])


def _gathered(pdf: pd.DataFrame) -> pd.DataFrame:
    """All answers for a part of the documents: a row a document with asked places and their sources, and one with given places."""
    rows = []
    for asks in (True, False):
        some = pdf[pdf["sources"].notna() == asks]
        if some.empty:
            continue
        doc, text, place = _opened(some)
        by = np.lexsort((place, text, doc))
        doc, text, place = doc[by], text[by], place[by]
        source = np.concatenate([_unpack(x, np.int64) for x in some["sources"]])[by] if asks else None
        new = _changes(doc, text)
        once = new.copy()
        once[1:] |= place[1:] != place[:-1]
        at = np.flatnonzero(new)
        for a, b in zip(at, [*at[1:], doc.size], strict=True):
            q = a + np.flatnonzero(once[a:b])
            rows.append((int(doc[a]), int(text[a]), _pack(place[q]), _pack(source[q]) if asks else None))
    return pd.DataFrame(rows, columns=["doc", "version", "places", "sources"]).astype({"doc": "int64", "version": "int64"})


def routed_places(asked: DataFrame, min_words: int, blocks: int, chunk_seeds: int) -> DataFrame:
    """``(doc, version, places, sources)``, packed: asked places with the document to look in, or (no sources) places that others ask for.

    ``asked`` has the columns ``d``, ``v`` and ``t``: id, hash of the text
    (which tells rows sharing an id apart) and text.
    """

    def ask(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk, seen, held = [], set(), 0
        for pdf in parts:
            for doc, version, t in zip(pdf["d"], pdf["v"], pdf["t"], strict=True):
                if (doc, version) in seen:
                    continue
                h, g = seeds(t.encode().split(), min_words)
                at = np.sort(np.unique(h, return_index=True)[1])
                if at.size:
                    seen.add((doc, version))
                    chunk.append((doc, version, h[at], g[at], at))
                    held += at.size
                if held >= chunk_seeds:
                    yield _questions(chunk, blocks)
                    chunk, seen, held = [], set(), 0
        if chunk:
            yield _questions(chunk, blocks)

    return (
        asked.mapInPandas(ask, _ASKED)
        .repartitionById(blocks, "block")
        .groupBy("block")
        .applyInPandas(lambda pdf: _answers(pdf, blocks), _FOUND)
        .repartitionById(blocks, "part")
        .groupBy("part")
        .applyInPandas(_gathered, "doc long, version long, places binary, sources binary")
    )


# --- step 2: the parse ---------------------------------------------------------------


def _runs(places: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Runs of neighbouring places, sorted, as spans ``[from, to)`` of the words they cover."""
    if not len(places):
        return []
    ends = np.flatnonzero(np.diff(places) > 1)
    first = places[np.concatenate(([0], ends + 1))]
    last = places[np.concatenate((ends, [len(places) - 1]))]
    return list(zip(first.tolist(), (last + size).tolist(), strict=True))


def _stretches(words: list[bytes], places: np.ndarray, sources: np.ndarray | None, size: int, blocks: int):
    """``(block, from, to)`` of the stretches to parse against a block, wherever the document has an asked window."""
    h, _ = seeds(words, size)
    keys, block = h[places], _part(sources, blocks)
    by = np.argsort(keys)
    at = np.minimum(np.searchsorted(keys[by], h), keys.size - 1)
    where = np.flatnonzero(keys[by][at] == h)
    of = block[by][at[where]]
    for b in np.unique(of).tolist():
        for start, end in _runs(where[of == b], size):
            yield b, start, end


class Reference:
    """Stretches of reference text, indexed by a suffix array over word numbers; each has a document id."""

    def __init__(self, texts: list[list[bytes]], docs: list[int]):
        self.numbers: dict[bytes, int] = {}
        text, owner = [], []
        for words, doc in zip(texts, docs, strict=True):
            text += [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]
            text.append(0)  # no word: a match never leaves its stretch
            owner += [doc] * (len(words) + 1)
        codes = np.array(text, dtype=np.int64)
        order = _suffix_array(codes, max(map(len, texts), default=0))
        self.codes = codes.astype(">u4").tobytes()
        self.owner = np.array(owner, dtype=np.int64)[order]
        self.order = order.tolist()

    def numbered(self, words: list[bytes]) -> bytes:
        """Words as the index compares them; words that the references lack match nothing."""
        return np.array([self.numbers.get(w, 0xFFFFFFFF) for w in words], dtype=">u4").tobytes()

    def _places(self, pattern: bytes, lo: int, hi: int) -> tuple[int, int]:
        size, codes = len(pattern), self.codes

        def key(i: int) -> bytes:
            return codes[4 * i : 4 * i + size]

        lo = bisect_left(self.order, pattern, lo, hi, key=key)
        return lo, bisect_right(self.order, pattern, lo, hi, key=key)

    def _narrowed(self, codes: bytes, at: int, size: int, below: int, lo: int, hi: int) -> tuple[int, int, int] | None:
        """The suffixes in ``lo:hi`` that begin with ``size`` words from ``at``, and their least id if it is below ``below``."""
        lo, hi = self._places(codes[4 * at : 4 * (at + size)], lo, hi)
        if lo == hi:
            return None
        least = int(self.owner[lo:hi].min())
        return (lo, hi, least) if least < below else None

    def has(self, codes: bytes, at: int, size: int, below: int) -> int | None:
        """Least id below ``below`` of a document with the ``size`` words from ``at``."""
        found = self._narrowed(codes, at, size, below, 0, len(self.order))
        return None if found is None else found[2]

    def longest(self, codes: bytes, at: int, below: int, first: int) -> tuple[int, int | None]:
        """Length and source of the longest match from ``at`` in documents with an id below ``below``.

        Lengths are tried from ``first`` on, doubled while they match, then halved in between.
        """
        end = len(codes) // 4 - at
        good, bad, best = 0, end + 1, (0, len(self.order), None)
        size = min(first, end)
        while bad - good > 1:
            found = self._narrowed(codes, at, size, below, best[0], best[1])
            if found is None:
                bad = size
            else:
                good, best = size, found
            size = min(2 * good, end) if bad > end and good else (good + bad) // 2
        return good, best[2]

    def parse(self, words: list[bytes], below: int, size: int) -> list[tuple[int, int, int]]:
        """Greedy factors of ``size`` words or more, and windows of ``size`` words across a factor's end, as ``(from, to, source)``."""
        codes, out, at = self.numbered(words), [], 0
        while at + size <= len(words):
            length, source = self.longest(codes, at, below, size)
            if length >= size:
                out.append((at, at + length, source))
            behind = at + max(1, length)
            for k in range(max(at + 1, behind - size + 1), min(behind, len(words) - size + 1)):
                held = self.has(codes, k, size, below)
                if held is not None:
                    out.append((k, k + size, held))
            at = behind
        return out


def _suffix_array(text: np.ndarray, longest: int) -> np.ndarray:
    """Suffixes in the order of their first ``longest`` words, by doubling."""
    rank, size = text, 1
    order = np.argsort(rank, kind="stable")
    while size < longest and text.size > 1:
        second = np.zeros(text.size, dtype=np.int64)
        second[:-size] = rank[size:] + 1
        key = rank * (int(rank.max()) + 2) + second
        order = np.argsort(key, kind="stable")
        rank = np.empty(text.size, dtype=np.int64)
        rank[order] = np.cumsum(np.diff(key[order], prepend=key[order[0]]) != 0)
        if rank[order[-1]] == text.size - 1:
            break
        size *= 2
    return order


def _parsed(pdf: pd.DataFrame, size: int) -> pd.DataFrame:
    """Factors of every stretch sent to one block, in places of its document."""
    asks = pdf["asks"].to_numpy(dtype=bool)
    given = pdf[~asks]
    index = Reference([w.encode().split() for w in given["words"]], given["doc"].tolist())
    rows = []
    for doc, version, place, words in pdf[asks][["doc", "version", "place", "words"]].itertuples(index=False):
        found = index.parse(words.encode().split(), doc, size)
        rows += [(doc, version, place + a, place + b, source) for a, b, source in found]
    return pd.DataFrame(rows, columns=["doc", "version", "from", "to", "source"]).astype(
        {"doc": "int64", "version": "int64", "from": "int32", "to": "int32", "source": "int64"}
    )


def factors(texts: DataFrame, min_words: int, block_bytes: int, chunk_seeds: int) -> DataFrame:
    """``(doc, version, from, to, source)``: the factors of ``min_words`` words or more that a smaller id has, and such windows across factor ends.

    ``texts`` has the columns ``d``, ``v`` and ``t``. Documents are dealt to
    reference blocks by a hash of their id; there are as many blocks as keep one's
    share of the corpus near ``block_bytes``.
    """
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // block_bytes))

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for doc, version, t, packed, sources in pdf[["d", "v", "t", "places", "sources"]].itertuples(index=False):
                words, places = t.encode().split(), _unpack(packed, np.int32)
                if sources is None:
                    own = int(_part(np.array([doc]), blocks)[0])
                    found = [(own, a, b) for a, b in _runs(places, min_words)]
                else:
                    found = _stretches(words, places, _unpack(sources, np.int64), min_words, blocks)
                rows += [(b, doc, version, start, b" ".join(words[start:end]).decode(), sources is not None) for b, start, end in found]
            yield pd.DataFrame(rows, columns=["block", "doc", "version", "place", "words", "asks"])

    asked = texts.filter((F.col("v") != NO_ID) & F.col("t").isNotNull())
    found = routed_places(asked, min_words, blocks, chunk_seeds)
    each = texts.join(found, (F.col("d") == F.col("doc")) & (F.col("v") == F.col("version")))
    each = each.groupBy("d", "v", F.col("sources").isNull()).agg(*[F.first(c).alias(c) for c in ("t", "places", "sources")])
    return (
        each.select("d", "v", "t", "places", "sources")
        .mapInPandas(cut, _STRETCH)
        .repartitionById(blocks, "block")
        .groupBy("block")
        .applyInPandas(lambda pdf: _parsed(pdf, min_words), "doc long, version long, from int, to int, source long")
    )


# --- step 3: the cut -----------------------------------------------------------------


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that touch or overlap become one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _cut(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, lists in parts:
        rows = []
        for t, found in zip(texts, lists, strict=True):
            words = (t or "").encode().split()
            spans = _joined([(f["from"], f["to"]) for f in found]) if found is not None else []
            left, end = [], 0
            for a, b in spans:
                left += words[end:a]
                end = b
            left += words[end:]
            rows.append((len(words), len(words) - len(left), [{"from": a, "to": b} for a, b in spans], b" ".join(left).decode()))
        yield pd.DataFrame(rows, columns=["n_words", "n_removed", "spans", "kept"])


def _id(docs: DataFrame, doc_id: str) -> Column:
    kind = docs.schema[doc_id].dataType.typeName()
    if kind not in ("byte", "short", "integer", "long", "void"):
        raise TypeError(f"{doc_id} must hold whole numbers, not {kind}: sources are ordered by it")
    return F.col(doc_id).cast("long")


def duplicate_spans(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    block_bytes: int = BLOCK_BYTES,
    chunk_seeds: int = CHUNK_SEEDS,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed``, ``spans``, ``factors`` and ``kept``.

    Words are runs without ASCII white space, unchanged. A window of
    ``min_words`` words is a duplicate if its words also start somewhere in a
    document with a smaller id; windows are judged on the input. ``factors``
    are the copied stretches ``from``, ``to`` with the document ``source``
    that they were found in, by ``from`` (they may overlap); ``spans`` are the
    maximal word spans ``from``, ``to`` that they cover; ``kept`` is what is
    left, joined by one space.

    A null text has no words, no spans and an empty ``kept``. Rows with a null
    id are nobody's source and lose nothing. Rows that share an id are one
    document: neither is the other's source. Ids are whole numbers; other types
    raise ``TypeError``. Other columns pass through; columns with the five names
    are replaced. A very long text is parsed like any other, in stretches. An
    empty table gives an empty one.

    Windows are compared by 56 bits within a block of an independent range to
    choose where to look; words decide. Of two different windows that share block
    and bits (some 2.4 million windows are in a block, so odds of about 3e-11 a
    window), one may be sent to the wrong reference. Its words are still found if
    a neighbouring window covers them.
    """
    ship(docs.sparkSession)
    docs = docs.drop("n_words", "n_removed", "spans", "factors", "kept")
    whole, kind = _id(docs, doc_id), docs.schema[doc_id].dataType
    d, v, t, f, r = (fresh_name(docs, x) for x in "dvtfr")
    # Keys that are never null, and the id and text only from them: so the two joins with
    # the texts read one shuffle of them, unless there are other columns to carry.
    keyed = docs.select(
        *[c for c in docs.columns if c not in (doc_id, text)],
        F.coalesce(whole, F.lit(0)).alias(d),
        F.when(F.col(doc_id).isNull(), F.lit(NO_ID)).otherwise(F.hash(text)).alias(v),
        F.col(text).alias(t),
    )
    texts = keyed.select(F.col(d).alias("d"), F.col(v).alias("v"), F.col(t).alias("t"))
    lists = (
        factors(texts, min_words, block_bytes, chunk_seeds)
        .groupBy("doc", "version")
        .agg(F.array_sort(F.collect_set(F.struct("from", "to", "source"))).alias(f))
    )
    cut = F.pandas_udf(_cut, "n_words long, n_removed long, spans array<struct<from: int, to: int>>, kept string")
    joined = keyed.join(lists, (F.col(d) == F.col("doc")) & (F.col(v) == F.col("version")), "left")
    own = {doc_id: F.when(F.col(v) != NO_ID, F.col(d)).cast(kind), text: F.col(t)}
    return joined.withColumn(r, cut(F.col(t), F.col(f))).select(
        *[own[c].alias(c) if c in own else keyed[c] for c in docs.columns],
        *[F.col(r)[c].alias(c) for c in ("n_words", "n_removed", "spans")],
        F.coalesce(f, F.array()).alias("factors"),
        F.col(r)["kept"].alias("kept"),
    )
