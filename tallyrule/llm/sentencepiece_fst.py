"""SentencePiece encoding and decoding as weighted finite-state transduction.

A model file is compiled into three transducers: the normaliser (dummy prefix,
white space to U+2581), the pieces (a trie from characters to piece ids) and
the byte fallback (a character without a piece to its UTF-8 byte pieces). An
input is composed with them into a lattice whose states are text places and
whose arcs are pieces; the encoding is the path of least weight, weights
adding along a path and the least winning among paths (tropical semiring).

For a unigram model an arc weighs minus the piece's score. For a BPE model the
result of the merges is a regular language over pieces: a sequence is the
encoding of its text exactly if each adjacent pair is the encoding of the
pair's text. The lattice is therefore composed with the acceptor of those
pairs, where a pair outside the language has infinite weight; one path of
finite weight is left.
"""

from __future__ import annotations

import math
import re
import struct
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrule.llm.common import ship

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
UNKNOWN_PENALTY = 10.0
SLICE = 256  # texts encoded before their ids leave the worker
MEMO, MEMO_CHARS = 200_000, 48  # remembered words in each generation of a worker, and their longest
PARTS = 1 << 16  # remembered stretches within words
PAIRS, HEADS, HEAD = 1 << 18, 1 << 15, 4  # remembered pairs, remembered starts of arc lists and their characters
UNIT = re.compile(" +[^ ]*")


def _varint(b: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        x = b[i]
        i += 1
        value |= (x & 127) << shift
        if x < 128:
            return value, i
        shift += 7


def _fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """``(number, value)`` of a protocol buffer message."""
    i = 0
    while i < len(b):
        tag, i = _varint(b, i)
        kind = tag & 7
        if kind == 0:
            value, i = _varint(b, i)
        elif kind == 2:
            n, i = _varint(b, i)
            value, i = b[i : i + n], i + n
        else:
            n = 8 if kind == 1 else 4
            value, i = b[i : i + n], i + n
        yield tag >> 3, value


class Processor:
    """A compiled model. ``encode`` gives piece ids, ``decode`` the text of ids."""

    def __init__(self, model: bytes):
        pieces, trainer, normaliser = [], {}, {}
        for number, value in _fields(model):
            if number == 1:
                f = dict(_fields(value))
                score = struct.unpack("<f", f[2])[0] if 2 in f else 0.0
                pieces.append((f.get(1, b"").decode(), score, f.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        self.kind = trainer.get(3, UNIGRAM)
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        if normaliser.get(2):
            raise ValueError("models with a precompiled character map are not supported")
        self.add_prefix = bool(normaliser.get(3, 1))
        self.squeeze = bool(normaliser.get(4, 1))
        self.escape = bool(normaliser.get(5, 1))
        self.pieces = [text for text, _, _ in pieces]
        self.scores = [score for _, score, _ in pieces]
        self.kinds = [kind for _, _, kind in pieces]
        if USER in self.kinds:
            raise ValueError("models with user-defined symbols are not supported")
        self.ids = {text: k for k, (text, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.unknown = self.kinds.index(UNKNOWN) if UNKNOWN in self.kinds else 0
        byte = {text: k for k, (text, _, kind) in enumerate(pieces) if kind == BYTE}
        self.bytes = [byte.get(f"<0x{v:02X}>") for v in range(256)] if byte else None
        self.unknown_score = min([self.scores[k] for k in self.ids.values()], default=0.0) - UNKNOWN_PENALTY
        # No arc crosses between two characters that no piece has side by side.
        self.inner = {t[i : i + 2] for t in self.ids for i in range(len(t) - 1)}
        alone = not any(c != SPACE and d == SPACE for c, d in self.inner)
        words = f"{SPACE}*[^\\W_{SPACE}]+|{SPACE}*(?:[^\\w{SPACE}]|_)+|{SPACE}+"
        self.stretch = re.compile(words if alone else "(?s).+")
        # Without bytes, unknown neighbours join across any cut.
        self.by_word = alone and self.add_prefix and self.escape and self.bytes is not None
        # Pieces that the merges of their own text do not give occur in no encoding.
        self.halves: dict[str, tuple[str, str]] = {}
        if self.kind == BPE:
            self.ids = {t: k for t, k in self.ids.items() if self._merge(t, self.halves) == [t]}
            counts = Counter(self.scores[k] for k in self.ids.values())
            self.plain: dict[str, bool] = {}
            for t, k in sorted(self.ids.items(), key=lambda x: len(x[0])):
                self.plain[t] = all(
                    len(h) == 1 or (self.plain[h] and self.scores[self.ids[h]] > self.scores[k])
                    for h in self.halves.get(t, ())
                ) and (len(t) == 1 or counts[self.scores[k]] == 1)
        # Trie arcs: character to (next state, ``(length, piece)`` of the piece that ends there or None).
        self.trie: dict = {}
        self.longest = max(map(len, self.ids), default=1)
        for text, k in self.ids.items():
            node = self.trie
            for c in text[:-1]:
                node = node.setdefault(c, [{}, None])[0]
            node.setdefault(text[-1], [{}, None])[1] = (len(text), k)
        self.spelled = [
            bytes([int(text[3:5], 16)])
            if kind == BYTE
            else " ⁇ ".encode()
            if kind == UNKNOWN
            else b""
            if kind == CONTROL
            else text.encode()
            for text, _, kind in pieces
        ]
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.part = lru_cache(PARTS)(self._packed)
        self.edge = lru_cache(1 << 16)(self._edge)
        self.pairs: dict[int, dict[int, bool]] = {}
        self.held_pairs = 0
        self.heads: dict[str, tuple] = {}
        self.spelled_array = pa.array(self.spelled, pa.large_binary())

    # normaliser

    def _spaced(self, text: str) -> str:
        """The normalised text before its spaces are escaped."""
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        return " " + text if text and self.add_prefix else text

    def normalise(self, text: str) -> str:
        """The text as pieces spell it."""
        text = self._spaced(text)
        return text.replace(" ", SPACE) if self.escape else text

    # pieces and byte fallback

    def _head(self, ahead: str) -> tuple:
        """Arcs within a text's first characters, and the trie state after them if pieces go on."""
        node, found = self.trie, []
        for c in ahead:
            step = node.get(c)
            if step is None:
                node = None
                break
            node, arc = step
            if arc is not None:
                found.append(arc)
        if not found or found[0][0] != 1:
            found.insert(0, (1, -1 - ord(ahead[0])))
        if len(self.heads) >= HEADS:
            self.heads.clear()
        entry = self.heads[ahead] = (tuple(reversed(found)), node or None)
        return entry

    def arcs(self, text: str, at: int) -> tuple[tuple[int, int], ...]:
        """Arcs that leave place ``at``: ``(length, piece)``, longest first.

        The fallback of a character is -1 minus its code point.
        """
        ahead = text[at : at + HEAD]
        found, node = self.heads.get(ahead) or self._head(ahead)
        if node is None:
            return found
        longer = ()
        for c in text[at + HEAD : at + self.longest]:
            step = node.get(c)
            if step is None:
                break
            node, arc = step
            if arc is not None:
                longer = (arc, *longer)
        return longer + found if longer else found

    def _spell(self, path: list[int]) -> list[int]:
        """Ids of a path; the fallback of a character is its bytes, or the unknown piece."""
        if min(path, default=0) >= 0:
            return path
        out: list[int] = []
        for k in path:
            if k >= 0:
                out.append(k)
            elif self.bytes is not None:
                out += [self.bytes[b] for b in chr(-1 - k).encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)  # neighbouring unknown characters are one
        return out

    # the acceptor of adjacent BPE pieces

    def _merge(self, text: str, halves: dict | None = None) -> list[str]:
        """What the merges make of a short text: best score first, then leftmost."""
        parts = list(text)
        while True:
            best, where = -math.inf, -1
            for i in range(len(parts) - 1):
                k = self.ids.get(parts[i] + parts[i + 1])
                if k is not None and self.scores[k] > best:
                    best, where = self.scores[k], i
            if where < 0:
                return parts
            both = parts[where] + parts[where + 1]
            if halves is not None and both == text:
                halves[text] = (parts[where], parts[where + 1])
            parts[where : where + 2] = [both]

    def _edge(self, text: str, side: int) -> list[tuple[str, float]]:
        """What stands at one side of a piece while it is merged, and the score that ends it."""
        out, end = [], -math.inf
        while True:
            out.append((text, end))
            if text not in self.halves:
                return out
            end = self.scores[self.ids[text]]
            text = self.halves[text][side]

    def _pair(self, a: str, b: str) -> bool:
        """Whether the merges of ``a + b`` give ``a, b``: whether none crosses from one to the other."""
        if a[-1] + b[0] not in self.inner:
            return True
        if not (self.plain.get(a, True) and self.plain.get(b, True)):
            return self._merge(a + b) == [a, b]
        # Scores fall along a piece's merges, so a crossing merge is made exactly
        # if it scores above those that would use up its two sides.
        for y, ends_y in self.edge(b, 0):
            for x, ends_x in self.edge(a, 1):
                k = self.ids.get(x + y)
                if k is not None and self.scores[k] > ends_x and self.scores[k] >= ends_y:
                    return False
        return True

    # composition and shortest path

    def _best_unigram(self, text: str) -> list[int]:
        best: list[tuple[float, int, int]] = [(0.0, -1, 0)] + [(math.inf, -1, 0)] * len(text)
        for at in range(len(text)):
            here = best[at][0]
            for size, k in reversed(self.arcs(text, at)):
                w = here - (self.scores[k] if k >= 0 else self.unknown_score)
                if w < best[at + size][0]:
                    best[at + size] = (w, k, size)
        path, to = [], len(text)
        while to:
            path.append(best[to][1])
            to -= best[to][2]
        return path[::-1]

    def _fits(self, a: int, b: int) -> bool:
        """Whether arc ``b`` may follow arc ``a``; remembered in ``pairs``."""
        first, second = (self.pieces[k] if k >= 0 else chr(-1 - k) for k in (a, b))
        if self.held_pairs >= PAIRS:
            self.pairs.clear()
            self.held_pairs = 0
        fits = self.pairs.setdefault(a, {})[b] = self._pair(first, second)
        self.held_pairs += 1
        return fits

    def _best_bpe(self, text: str) -> list[int]:
        # Weights are nothing or infinite, so a search in any order finds the least.
        # Each place has one path of finite weight (the encoding of the text
        # before it): longer arcs go first and no place is entered twice.
        n, pairs, heads = len(text), self.pairs, self.heads
        path: list[int] = []
        open_, left = [], set()
        at, before, fit, arcs = 0, 0, {}, iter(self.arcs(text, 0))
        while True:
            for size, k in arcs:
                to = at + size
                if to in left:
                    continue
                if at:
                    fits = fit.get(k)
                    if not (self._fits(before, k) if fits is None else fits):
                        continue
                path.append(k)
                if to == n:
                    return path
                open_.append((at, before, fit, arcs))
                at, before, fit = to, k, pairs.get(k) or {}
                found = heads.get(text[at : at + HEAD])
                arcs = iter(found[0] if found is not None and found[1] is None else self.arcs(text, at))
                break
            else:
                left.add(at)
                at, before, fit, arcs = open_.pop()
                path.pop()

    def _encode(self, text: str) -> list[int]:
        if not text:
            return []
        return self._spell(self._best_bpe(text) if self.kind == BPE else self._best_unigram(text))

    def _packed(self, text: str) -> bytes:
        return array("i", self._encode(text)).tobytes()

    def _cut(self, text: str) -> list[str]:
        """The text's stretches, cut where no piece can cross: a shortest path through there is two shortest paths."""
        inner, out, held = self.inner, [], ""
        for part in self.stretch.findall(text):
            if part[0] != SPACE and held and held[-1] + part[0] in inner:
                held += part
                continue
            if held:
                out.append(held)
            held = part
        if held:
            out.append(held)
        return out

    def _part(self, part: str) -> bytes:
        """The packed ids of a stretch, remembered if it is short."""
        return self.part(part) if len(part) <= MEMO_CHARS else self._packed(part)

    def _word(self, word: str) -> bytes:
        """The packed ids of a space and ``word``. Two generations: what was not used since the last one goes."""
        ids = self.older.pop(word, None)
        if ids is None:
            first, *rest = self._cut(SPACE + word.replace(" ", SPACE))
            if rest:
                start = first[1:].replace(SPACE, " ")
                ids = b"".join([self.memo.get(start) or self._word(start), *map(self._part, rest)])
            else:
                ids = self._packed(first)
        if len(word) < MEMO_CHARS:
            if len(self.memo) >= MEMO:
                self.older = dict(self.memo)
                self.memo.clear()
            self.memo[word] = ids
        return ids

    def pack(self, text: str | None) -> bytes:
        """Piece ids of a whole text as packed 32-bit integers; a null or empty text has none.

        The text is cut before its spaces where no piece crosses one, else as
        ``_cut`` does; what was found for words and stretches is remembered.
        """
        if not text:
            return b""
        if not self.by_word:
            text = self.normalise(text)
            return self._packed(text) if self.bytes is None else b"".join(map(self._part, self._cut(text)))
        text = self._spaced(text).replace(SPACE, " ")
        words = [unit[1:] for unit in UNIT.findall(text)] if "  " in text else text[1:].split(" ") if text else []
        known, word = self.memo.get, self._word
        return b"".join([known(w) or word(w) for w in words])

    def encode(self, text: str | None) -> np.ndarray:
        """Piece ids of a whole text; a null or empty text has none."""
        return np.frombuffer(self.pack(text), dtype=np.int32)

    def decode(self, ids) -> str:
        """The text of the ids; bytes that are no UTF-8 become U+FFFD."""
        return self._text(b"".join(map(self.spelled.__getitem__, ids)))

    def _text(self, spelled: bytes) -> str:
        text = spelled.decode(errors="replace")
        if self.escape:
            text = text.replace(SPACE, " ")
        return text[1:] if self.add_prefix and text.startswith(" ") else text

    def decode_lists(self, ids: pa.Array, ends: np.ndarray) -> Iterator[str]:
        """The texts of the lists of ids that ``ends`` cuts from ``ids``, spelled by one look-up for all."""
        _, places, data = self.spelled_array.take(ids).buffers()
        cuts = np.frombuffer(places, np.int64)[ends].tolist()
        spelled = memoryview(data or b"")
        return (self._text(bytes(spelled[i:j])) for i, j in zip(cuts, cuts[1:]))


def load_model(path: str) -> bytes:
    """The model file, read on the driver; it is sent to the executors as bytes."""
    with open(path, "rb") as f:
        return f.read()


_COMPILED: dict[int, Processor] = {}


def _compiled(held) -> Processor:
    """The worker's processor: compiled once in each Python worker, and kept for its later tasks.

    It stays bounded: one model, ``MEMO`` words and ``PARTS`` stretches of ``MEMO_CHARS`` characters.
    """
    key = hash(held.value)
    if key not in _COMPILED:
        _COMPILED.clear()
        _COMPILED[key] = Processor(held.value)
    return _COMPILED[key]


def _mapped(docs: DataFrame, model: bytes, text: str, names: list[str], exact: bool) -> DataFrame:
    """``docs`` with the encoding's columns, ``SLICE`` rows at a time, so that few texts are held at once."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(*[c for c in docs.columns if c.lower() not in names])
    at = docs.columns.index(text)
    kinds = [T.ArrayType(T.IntegerType()), T.LongType(), T.BooleanType()]
    fields = [T.StructField(n, kind) for n, kind in zip(names, kinds)]
    schema, columns = T.StructType(docs.schema.fields + fields), [*docs.columns, *names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _compiled(held)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                texts = part.column(at).to_pylist()
                ids = [p.pack(t) for t in texts]
                ends = (np.cumsum([0, *map(len, ids)]) // 4).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(ids), np.int32), pa.int32())
                found = [pa.ListArray.from_arrays(pa.array(ends), values)]
                if exact:
                    found.append(pa.array(np.diff(ends).astype(np.int64)))
                    back = p.decode_lists(values, ends)
                    found.append(pa.array([s == t for s, t in zip(back, texts, strict=True)], pa.bool_()))
                yield pa.RecordBatch.from_arrays([*part.columns, *found], names=columns)
        # Workers live on: the compiled model and the words last used stay for the next task.
        p.older = {}
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, schema)


def encode_texts(docs: DataFrame, model: bytes, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the piece ids of every whole text as ``ids``, an int array.

    Null and empty texts have no ids. Other columns pass through; a column
    called ``ids`` is replaced. Long texts are encoded stretch by stretch, so
    memory follows the longest stretch between cuts, not the text.
    """
    return _mapped(docs, model, text, [ids], exact=False)


def decode_ids(docs: DataFrame, model: bytes, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of an array of piece ids; a null array gives null, an empty one the empty text."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def run(arrays: pd.Series) -> pd.Series:
        p = _compiled(held)
        return pd.Series([None if a is None else p.decode(np.asarray(a).tolist()) for a in arrays], dtype=object)

    return docs.withColumn(text, run(F.col(ids)))


def round_trip(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """Add ``ids``, ``n_ids`` and ``exact``: whether decoding the ids gives the text back.

    Both directions run in one pass over the texts. ``exact`` is false where
    the model itself loses something: a null text comes back empty, and a
    U+2581 in the text comes back as a space. Columns with the three names are
    replaced; empty texts have no ids and are exact.
    """
    return _mapped(docs, model, text, ["ids", "n_ids", "exact"], exact=True)


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    """Where the public tokenizer file lies on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)
