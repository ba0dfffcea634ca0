"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tallyrule
from tallyrule.scratch import scratch_path

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    The driver's file server hands the zipped sources to every executor, so
    workers need neither the driver's folders nor its ``PYTHONPATH``.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(tallyrule.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tallyrule-"), "tallyrule_sources.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("tallyrule", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(key: Column) -> Column:
    """CRC-32 of the key as text, modulo 4."""
    return F.crc32(key.cast("string").cast("binary")) % 4


def held_out(key: Column) -> Column:
    """Rows kept back from learning: fold 2. A null key is never held out."""
    return F.coalesce(fold(key) == 2, F.lit(False))


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that does not clash with ``df``'s, ignoring case."""
    taken = {c.lower() for c in df.columns}
    name, k = f"__{stem}", 0
    while name.lower() in taken:
        k += 1
        name = f"__{stem}_{k}"
    return name


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest node reachable from each node that has an edge: ``(node, root)``.

    Alternating large-star and small-star rounds: each round links every node's
    larger neighbours, then its smaller ones, to the smallest node seen, until
    nothing changes. All work is joins and partial aggregates, so a node with
    very many edges never meets in one task; rounds grow with the logarithm of
    the longest chain. Edges are checkpointed each round.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct().checkpoint()

    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = mark(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("p"))
            .select(F.col("p.v").alias("u"), F.col("p.m").alias("v"))
            .filter("u != v")
            .distinct()
        )
        e = small.checkpoint()
        after = mark(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
