"""Document fingerprints: a homomorphic hash of the multiset of paragraphs.

A paragraph (the text between line feeds) hashes to a wide vector, and a
document's fingerprint is the sum of its paragraphs' vectors, lane by lane,
modulo 2**32. The sum does not depend on the paragraphs' order, and a paragraph
is put in or taken out by adding or subtracting its vector
(:func:`combined`, :func:`without`). A vector has, in this order:

* two lanes that count paragraphs and pieces; a piece is three words of a
  paragraph, cut from its start, the last one shorter;
* 16 lanes of XXH64 bits of the whole paragraph. Texts with the same paragraphs
  agree in them, others do so by chance only (512 bits);
* 128 lanes, one for each of 128 hash bits, that count the pieces with that bit
  set. Twice such a lane less the number of pieces is a sum of random signs, so
  products of two documents' lanes estimate how many pieces they share:
  :func:`likeness`, with a standard deviation of at most 0.09.

Only built-in functions are used. Lanes are summed in packed pairs while rows
are still in their task, so what is shuffled is one vector a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrule.llm.sharding import numbered

STRONG_WORDS, SIGN_WORDS, PIECE = 8, 2, 3
COUNTS, STRONG, SIGNS = 2, 2 * STRONG_WORDS, 64 * SIGN_WORDS
LANE = 0xFFFFFFFF
PAIR = 0x0000000100000001  # bit j and bit j + 32 of a hash, each in its half of a long


def _piece_hashes(paragraph: Column) -> Column:
    """One hash for each piece of a paragraph; none if it has no words."""
    words = F.array_remove(F.split(paragraph, "[\\x20\\x09-\\x0D]+"), "")

    def of(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 1, F.lit(PIECE))
        each = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(PIECE)]))
        return F.when(F.size(w) > 0, each).otherwise(F.array().cast("array<bigint>"))

    # the words are bound once through a one-element array, not split again for each piece
    return F.transform(F.array(words), of)[0]


def _sums(paragraphs: DataFrame, keys: list[str], paragraph: str) -> DataFrame:
    """The sum of the paragraphs' vectors for each key."""
    strong = [F.xxhash64(F.lit(i), F.col(paragraph)).alias(f"__s{i}") for i in range(STRONG_WORDS)]
    rows = paragraphs.select(*keys, *strong, F.posexplode_outer(_piece_hashes(F.col(paragraph))).alias("__i", "__h0"))
    rows = rows.withColumns({f"__h{i}": F.xxhash64(F.lit(i), F.col("__h0")) for i in range(1, SIGN_WORDS)})
    first = F.coalesce(F.col("__i"), F.lit(0)) == 0  # what belongs to the paragraph counts in its first row only
    sums = [F.sum(F.when(first, 1).otherwise(0)), F.count("__h0")]
    for i in range(STRONG_WORDS):
        s = F.col(f"__s{i}")
        halves = (s.bitwiseAND(F.lit(LANE)), F.shiftrightunsigned(s, 32))
        sums += [F.sum(F.when(first, half).otherwise(F.lit(0))) for half in halves]
    for i in range(SIGN_WORDS):
        h = F.when(F.col("__i").isNull(), F.lit(0)).otherwise(F.col(f"__h{i}"))
        sums += [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(PAIR))) for j in range(32)]
    names = [f"__v{i}" for i in range(len(sums))]
    out = rows.groupBy(*keys).agg(*[s.alias(n) for s, n in zip(sums, names)])
    lanes = [F.col(n).bitwiseAND(F.lit(LANE)) for n in names[: COUNTS + STRONG]]
    for n in names[COUNTS + STRONG :]:
        lanes += [F.col(n).bitwiseAND(F.lit(LANE)), F.shiftrightunsigned(F.col(n), 32)]
    return out.select(*keys, F.array(*lanes).alias("__f"))


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and ``fingerprint``, one row for each key: an array of lanes below 2**32.

    Rows that share a key are one document: their paragraphs are summed. A null
    text counts as empty, and an empty text is one empty paragraph without
    pieces; null keys group together, an empty table gives an empty result.
    Columns that are neither key nor text are left out, whatever their names.
    A very long text is cut into rows at once and summed within its task; sums
    are exact below 2**31 paragraphs and pieces a key.
    """
    group = [f"__k{i}" for i in range(len(keys))]
    rows = texts.select(
        *[F.col(f"`{k}`").alias(g) for k, g in zip(keys, group)],
        F.explode(_paragraphs(F.coalesce(F.col(f"`{text}`"), F.lit("")))).alias("__p"),
    )
    return _sums(rows, group, "__p").select(*[F.col(g).alias(k) for k, g in zip(keys, group)], F.col("__f").alias("fingerprint"))


def _paragraphs(text: Column) -> Column:
    return F.split(text, "\n", -1)


def combined(a: Column, b: Column) -> Column:
    """Fingerprint of the paragraphs of both: insertion."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(LANE)))


def without(a: Column, b: Column) -> Column:
    """Fingerprint of ``a`` less the paragraphs of ``b``: deletion."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(LANE)))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of pieces that two documents have in common, 0 to 1 (Dice: twice the shared over the sum).

    Equal fingerprints are 1; a document without words is 0 to any other. Both
    columns should be stored columns: each is read several times.
    """

    def signed(f: Column) -> Column:
        return F.transform(F.slice(f, COUNTS + STRONG + 1, SIGNS), lambda x: (2 * x - f[1]).cast("double"))

    def product(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    def of(p: Column) -> Column:
        both = product(p["a"], p["a"]) + product(p["b"], p["b"])
        return F.when(both == 0, F.lit(0.0)).otherwise(
            F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * product(p["a"], p["b"]) / both))
        )

    estimate = F.transform(F.array(F.struct(signed(a).alias("a"), signed(b).alias("b"))), of)[0]
    return F.when(a == b, F.lit(1.0)).otherwise(estimate)


def as_text(fingerprint: Column) -> Column:
    """Eight hexadecimal digits a lane."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


# parts of a document and of the one after it, whose sums make up three fingerprints
KEPT, GONE, JOINED, TAKEN, LEFT = range(5)


def _parts(text: Column, keep: Column, following: Column, take: Column) -> Column:
    """``(part, paragraph)`` of every paragraph of two texts, and of those where the edited text cuts or joins.

    The edited text is the first ``keep`` code points of one and ``take`` of the
    other. Whole paragraphs of either that it holds are summed once for both.
    """
    held = F.array(
        F.struct(
            _paragraphs(text).alias("own"),
            _paragraphs(F.left(text, keep)).alias("kept"),
            _paragraphs(following).alias("next"),
            _paragraphs(F.left(following, take)).alias("taken"),
        )
    )

    def tagged(part: int, paragraphs: Column) -> Column:
        return F.transform(paragraphs, lambda p: F.struct(F.lit(part).alias("part"), p.alias("p")))

    def rest(a: Column, start: Column) -> Column:
        return F.slice(a, start, F.greatest(F.size(a) - start + 1, F.lit(0)))

    def of(s: Column) -> Column:
        whole = F.size(s["kept"]) - 1  # the last kept paragraph may be cut
        inner = F.greatest(F.size(s["taken"]) - 2, F.lit(0))  # the first is joined on, the last may be cut
        seam = F.concat(F.element_at(s["kept"], -1), s["taken"][0])
        tail = F.slice(s["taken"], F.greatest(F.size(s["taken"]), F.lit(2)), 1)
        return F.concat(
            tagged(KEPT, F.slice(s["own"], 1, whole)),
            tagged(GONE, rest(s["own"], whole + 1)),
            tagged(JOINED, F.concat(F.array(seam), tail)),
            tagged(TAKEN, F.slice(s["next"], 2, inner)),
            tagged(LEFT, F.concat(F.slice(s["next"], 1, 1), rest(s["next"], inner + 2))),
        )

    return F.transform(held, of)[0]


def fingerprint_edits(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every document, of its edited text and of the next document.

    Documents stand in a ring by ascending ``id``, null first; rows that share
    an id follow each other by the XXH64 and length of their texts. In the
    edited text the last ``floor(n_chars / 2)`` code points give way to the
    first as many, or all, of the next document. Its fingerprint is the
    document's without the paragraphs that go, with those that come. Returns
    ``id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint`` and ``next_fingerprint``.

    A null text is empty. Rows equal in id and text are one place of the ring
    and give equal result rows, as many as there are; a single document is its
    own neighbour; an empty table gives an empty result. Other columns are
    ignored. Whole texts are shuffled twice: to their key, and to the document
    before them.
    """
    # A key that is never null, so that joins on it keep their partitioning for the sums.
    key = F.coalesce(F.concat(F.lit("="), F.col(f"`{id}`").cast("string")), F.lit(""))
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id}`").alias("id"), key.alias("k"), F.xxhash64(body).alias("h"), F.length(body).alias("n"), body.alias("t")
    )
    keys = ["k", "h", "n"]
    once = rows.groupBy(*keys).agg(F.first("id").alias("id"), F.count("*").alias("copies"))
    places, total = numbered(once, ["id"], "at")
    before = places.select(*[F.col(c).alias(f"b{c}") for c in keys], ((F.col("at") + 1) % max(total, 1)).alias("at"))
    ring = places.select(*keys, "at").join(before, "at").drop("at")
    # Only keys and text, wherever it is read, so that one shuffle of the texts serves all.
    own = rows.groupBy(*keys).agg(F.first("t").alias("t"))
    following = own.join(ring, keys).select(*[F.col(f"b{c}").alias(c) for c in keys], F.col("t").alias("next"))
    pairs = own.join(following, keys)
    half = F.floor(F.col("n") / 2).cast("int")
    keep = F.col("n") - half
    parts = pairs.select(*keys, F.explode(_parts(F.col("t"), keep, F.col("next"), half)).alias("x"))
    found = _sums(parts.select(*keys, "x.part", "x.p"), [*keys, "part"], "p")
    # at most five rows a document, whatever its size
    found = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("part", "__f"))).alias("f"))
    edited = F.concat(F.left("t", keep), F.left("next", half))
    out = pairs.select(*keys, F.sha2(edited.cast("binary"), 256).alias("edited_sha256")).join(found, keys)
    out = out.join(places.select(*keys, "id", "copies"), keys)

    def total_of(*parts: int) -> Column:
        nothing = F.array_repeat(F.lit(0).cast("long"), COUNTS + STRONG + SIGNS)
        found = [F.coalesce(F.try_element_at("f", F.lit(p)), nothing) for p in parts]
        return combined(found[0], found[1]) if len(found) == 2 else combined(combined(found[0], found[1]), found[2])

    # Equal rows again, in two steps, so that no array is long.
    step = 4096
    out = out.withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / step))))
    out = out.withColumn("c", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(step), F.col("copies") - F.col("c") * step))))
    return out.select(
        F.col("id").alias(id),
        F.col("n").cast("long").alias("n_chars"),
        "edited_sha256",
        total_of(KEPT, GONE).alias("fingerprint"),
        total_of(KEPT, JOINED, TAKEN).alias("edited_fingerprint"),
        total_of(TAKEN, LEFT).alias("next_fingerprint"),
    )
