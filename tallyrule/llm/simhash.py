"""SimHash near-dedup by pigeonhole blocks.

A fingerprint's 64 bits are split into ``b`` blocks. Two fingerprints that
differ in at most ``k`` bits agree in at least ``b - k`` whole blocks, so
every close pair meets under one of the ``C(b, b - k)`` choices of blocks.
Distinct fingerprints are joined on those block keys and verified by Hamming
distance; of a bucket only links to the first member of each of its components
leave the task, never all pairs. Buckets over ``hot_bucket`` members are keyed
again by blocks of their remaining bits, which bounds what can share a key.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrule.llm.common import connected_components, fresh_name, ship, staged

SHINGLE, MAX_BITS, SEED = 4, 4, 42
HOT_BUCKET = 16_384
_BIT_TABLE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BYTE_BASE = np.arange(8, dtype=np.int64) * 256
_SLICE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a whole text: bit set if over half of the shingles' XXH64 have it."""
    # bytes: lower() and split() treat ASCII only, as the word rule asks
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    ends = [s - 1 for s in starts[min(shingle, len(words)) :]]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(2048, dtype=np.int64)
    for at in range(0, n, _SLICE):
        h = np.fromiter(
            (digest(line[s:e], SEED) for s, e in zip(starts[at : min(n, at + _SLICE)], ends[at : at + _SLICE])),
            dtype=np.uint64,
        )
        counts += np.bincount((h.view(np.uint8).reshape(-1, 8) + _BYTE_BASE).ravel(), minlength=2048)
    ones = np.einsum("ij,jk->ik", counts.reshape(8, 256), _BIT_TABLE).ravel()
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def block_masks(bits: list[int], blocks: int, equal: int) -> list[int]:
    """Every choice of ``equal`` of ``blocks`` runs of the given bit places, as signed 64-bit masks."""
    parts = [sum(1 << p for p in part) for part in np.array_split(np.array(bits, dtype=object), blocks)]
    masks = [sum(choice) for choice in combinations(parts, equal)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def blocks_for(n: int, max_bits: int) -> int:
    """Blocks such that a bucket of ``n`` spread fingerprints holds about one, within 4 equal blocks."""
    b = max_bits + 2
    while b < max_bits + 4 and n > 1 << (64 * (b - max_bits) // b):
        b += 1
    return b


def bucket_links(members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """``(member, first member of its component)`` for the links within one bucket."""
    left = np.sort(members.astype(np.int64)).view(np.uint64)
    out = []
    while left.size > 1:
        root, left = left[0], left[1:]
        frontier = [root]
        while frontier and left.size:
            near = np.bitwise_count(left ^ frontier.pop()) <= max_bits
            if near.any():
                found = left[near]
                frontier.extend(found)
                out += [(int(a), int(b)) for a, b in zip(found.view(np.int64), np.full(found.size, root).view(np.int64))]
                left = left[~near]
    return out


def link_fingerprints(
    prints: DataFrame, max_bits: int = MAX_BITS, hot_bucket: int = HOT_BUCKET, blocks: int | None = None
) -> DataFrame:
    """Links ``(a, b)`` that connect whatever is within ``max_bits``, from distinct ``fp`` rows."""
    ship(prints.sparkSession)
    b = blocks or blocks_for(prints.count(), max_bits)
    masks = block_masks(list(range(64)), b, b - max_bits)
    fp = F.col("fp")
    keyed = prints.select(fp, F.posexplode(F.array(*[fp.bitwiseAND(F.lit(m)) for m in masks])).alias("c", "key"))
    shared = staged(keyed.groupBy("c", "key").count().filter("count > 1"), "buckets")
    rows = keyed.join(shared, ["c", "key"])

    # Remaining bits of each choice, split into blocks of which as many must agree.
    sub = max_bits + 4
    finer = [block_masks([p for p in range(64) if not m >> p & 1], sub, sub - max_bits) for m in masks]
    table = F.array(*[F.array(*[F.lit(x) for x in row]) for row in finer])
    hot = (
        rows.filter(F.col("count") > hot_bucket)
        .select("c", "key", fp, F.posexplode(table[F.col("c")]).alias("d", "m"))
        .select("c", "key", "d", fp.bitwiseAND(F.col("m")).alias("sub"), fp)
    )
    groups = (
        rows.filter(F.col("count") <= hot_bucket)
        .groupBy("c", "key")
        .agg(F.collect_list("fp").alias("members"))
        .select("members")
    )
    if shared.filter(F.col("count") > hot_bucket).limit(1).count():
        groups = groups.unionByName(
            hot.groupBy("c", "key", "d", "sub")
            .agg(F.collect_list("fp").alias("members"))
            .filter(F.size("members") > 1)
            .select("members")
        )

    def links(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            found = {pair for m in pdf["members"] for pair in bucket_links(np.asarray(m), max_bits)}
            yield pd.DataFrame(list(found), columns=["a", "b"], dtype="int64")

    return groups.mapInPandas(links, "a long, b long").distinct()


def _rooted(firsts: DataFrame, max_bits: int, hot_bucket: int) -> DataFrame:
    """``(fp, first, root)`` from distinct ``fp`` rows; one ``root`` a component."""
    roots = connected_components(link_fingerprints(firsts.select("fp"), max_bits, hot_bucket))
    return firsts.join(roots, firsts["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    hot_bucket: int = HOT_BUCKET,
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``: one row per row of ``docs``.

    Words are runs without ASCII white space, A-Z lower-cased; shingles are
    ``shingle`` consecutive words joined by a space, repeats included. Fewer
    words make one shingle of the whole sequence; no words (null, empty or
    blank texts) the fingerprint zero, which links like any other.
    Fingerprints within ``max_bits`` bits link; ``component_id`` is the
    smallest id reachable over links, the row's own included. Null ids are
    passed over unless a component has no other. ``fingerprint`` is the
    64-bit value as a signed long.
    """
    ship(docs.sparkSession)
    simhash = F.pandas_udf(lambda s: pd.Series([fingerprint(t, shingle) for t in s], dtype="int64"), "long")
    ids = staged(docs.select(F.col(doc_id).alias("id"), simhash(F.col(text)).alias("fp")), "fingerprints")
    labelled = _rooted(ids.groupBy("fp").agg(F.min("id").alias("first")), max_bits, hot_bucket)
    smallest = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = staged(labelled.join(smallest, "root").select("fp", "component_id"), "classes")
    return ids.join(classes, "fp").select(F.col("id").alias(doc_id), F.col("fp").alias("fingerprint"), "component_id")


def drop_near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    hot_bucket: int = HOT_BUCKET,
) -> DataFrame:
    """One row of each component of :func:`near_duplicates`.

    It is the row with the smallest id, null ids last; of rows that share it,
    the one with the smallest hash over all columns but maps; of exact repeats,
    any one.
    """
    ship(docs.sparkSession)
    simhash = F.pandas_udf(lambda s: pd.Series([fingerprint(t, shingle) for t in s], dtype="int64"), "long")
    r, p = fresh_name(docs, "r"), fresh_name(docs, "p")
    # The row numbers are written, so they stay the same.
    rows = staged(
        docs.withColumn(p, simhash(F.col(text))).withColumn(r, F.monotonically_increasing_id()), "fingerprinted"
    )
    plain = [c.name for c in docs.schema if "map<" not in c.dataType.simpleString()]
    rank = F.struct(F.col(doc_id).isNull(), F.col(doc_id), F.xxhash64(*plain), F.col(r).alias("r"))
    firsts = staged(rows.groupBy(F.col(p).alias("fp")).agg(F.min(rank).alias("first")), "firsts")
    kept = _rooted(firsts, max_bits, hot_bucket).groupBy("root").agg(F.min("first").alias("first"))
    return rows.join(kept.select(F.col("first.r").alias(r)), r, "left_semi").select(*docs.columns)
