"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered 0..N-1 in key order. A Feistel network over a rectangle of
``a * b >= N`` cells, walked along its cycle until it falls below N, permutes
the numbers; the permuted number alone gives shard and slot. The same rows,
seed and shard count give the same answer on any cluster, and a row's place
can be computed without reading the others. DataFrame expressions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrule.llm.common import fresh_name, staged

ROUNDS = 6
MAX_WALK = 24  # a walk this long has odds below b**-24; it fails loudly


def _round_value(half: Column, k: Column, seed: int) -> Column:
    """52 bits of MD5 over seed, round and half."""
    text = F.concat_ws(":", F.lit(str(seed)), k.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def permuted(number: Column, n: int, seed: int = 0) -> Column:
    """The place of a row number below ``n`` after the permutation."""
    if n <= 1:
        return number.cast("long")
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)

    def once(x: Column) -> Column:
        start = F.struct(F.floor(x / F.lit(b)).cast("long").alias("l"), (x % b).cast("long").alias("r"))

        def step(s: Column, k: Column) -> Column:
            # odd rounds move the row of the cell, even rounds its column
            odd = k % 2 == 1
            v = _round_value(F.when(odd, s["r"]).otherwise(s["l"]), k, seed)
            return F.struct(
                F.when(odd, (s["l"] + v) % a).otherwise(s["l"]).alias("l"),
                F.when(odd, s["r"]).otherwise((s["r"] + v) % b).alias("r"),
            )

        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: s["l"] * b + s["r"])

    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(max(MAX_WALK, min(n, 64)))),
        F.struct(number.cast("long").alias("x"), F.lit(False).alias("done")),
        lambda s, _: F.when(s["done"], s).otherwise(_advance(once(s["x"]), n)),
    )
    return F.when(walk["done"], walk["x"]).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def _advance(y: Column, n: int) -> Column:
    # y is bound once through a one-element array, so the rounds are not evaluated twice
    return F.transform(F.array(y), lambda v: F.struct(v.alias("x"), (v < n).alias("done")))[0]


def numbered(rows: DataFrame, keys: list[str], name: str) -> tuple[DataFrame, int]:
    """``rows`` with a gapless number in the order of ``keys``, and their count.

    The rows are range-partitioned and sorted once and written with their
    place in their partition; the partitions' sizes, a table of a few rows,
    give each partition's first number. Rows equal in every column travel as
    one row with a count, so repeated rows cannot fill one task's memory.
    """
    spark = rows.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    local, step = 1 << 33, 4096
    n, copy, at, part, place = (fresh_name(rows, c) for c in ("n", "copy", "at", "part", "place"))
    columns = [F.col(f"`{c}`") for c in rows.columns]
    grouped = rows.groupBy(*columns).agg(F.count("*").alias(n))
    order = [F.col(f"`{k}`").asc_nulls_first() for k in keys]
    order += [F.col(f"`{c}`") for c in rows.columns if c not in keys]
    # Copies come back in two steps, so that no array is long.
    steps = F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / step))
    copies = F.sequence(F.lit(1).cast("long"), F.least(F.lit(step), F.col(n) - F.col(copy) * step))
    laid = staged(
        grouped.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn(copy, F.explode(steps))
        .withColumn(copy, F.explode(copies))
        .withColumn(at, F.monotonically_increasing_id())
        .select(
            *columns,
            F.floor(F.col(at) / F.lit(local)).cast("int").alias(part),
            (F.col(at) % local).alias(place),
        ),
        "numbered",
    )
    # One row per partition: bounded by the number of partitions, not rows.
    sizes = [tuple(r) for r in laid.groupBy(part).count().collect()]
    first, total = {}, 0
    for p, size in sorted(sizes):
        first[p], total = total, total + size
    if not first:
        return laid.drop(part, place).withColumn(name, F.lit(0).cast("long")), 0
    table = F.array(*[F.lit(first.get(p, 0)).cast("long") for p in range(max(first) + 1)])
    return laid.withColumn(name, table[F.col(part)] + F.col(place)).drop(part, place), total


def shard_rows(rows: DataFrame, keys: list[str], shards: int, seed: int = 0) -> DataFrame:
    """Add ``row_number``, ``shard`` and ``slot``: shards differ by at most one row.

    Slots count from 0 without gaps in every shard, and reading a shard in
    slot order is reading the permuted corpus. Rows are numbered by ``keys``
    (nulls first) and then by the other columns, so ties and repeated rows get
    distinct places; rows equal in all columns are interchangeable. An empty
    table gives an empty result. Input columns called ``row_number``,
    ``shard`` or ``slot`` are replaced.
    """
    rows = rows.drop("row_number", "shard", "slot")
    out, n = numbered(rows, keys, "row_number")
    place = fresh_name(out, "place")
    return (
        out.withColumn(place, permuted(F.col("row_number"), n, seed))
        .withColumn("shard", (F.col(place) % shards).cast("int"))
        .withColumn("slot", F.floor(F.col(place) / F.lit(shards)).cast("long"))
        .drop(place)
    )
