"""Line dedup over levelled sorted runs of line hashes.

``LineRuns`` keeps what earlier batches held as runs: tables of 128-bit line
keys, bucketed and sorted by key, so a later batch is merge-joined with them
without moving them. The join parts a batch in two: keys that no run holds (the
anti-join) become a run of their own on level 0, and of keys that one does only
the number of documents and their largest id are noted beside it. So every key
has one row in one run. When a level has ``fanout`` runs, they are merged into
one run of the next level; the runs that a batch is joined with grow in number
with the logarithm of the batches. A line goes by the documents that hold it in
all batches: its run's row and the notes on it, together.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrule.llm.common import fresh_name, ship, staged
from tallyrule.scratch import remove, scratch_path

SPACE = " \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 20, 3


def line_key(line: str, min_chars: int) -> tuple[int, int] | None:
    """128-bit hash of the stripped, A-Z lower-cased line; none if it is too short."""
    line = line.strip(SPACE)
    if len(line) < min_chars:
        return None
    d = xxhash.xxh3_128_intdigest(line.encode().lower())
    return (d >> 64) - (1 << 63), (d & (1 << 64) - 1) - (1 << 63)


class LineRuns:
    """Levelled runs of ``(h1, h2, n_docs, max_doc)``, and notes of the same columns on their keys.

    A key is in one run; its documents are those of the run's row and of all its
    notes. ``drop`` removes the tables and their files.
    """

    def __init__(self, spark: SparkSession, fanout: int = 3, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.batches: list[str] = []
        self.paths: dict[str, str] = {}

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _write(self, df: DataFrame, *parts: str) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = scratch_path(self.spark, name)
        writer = df.repartition(self.buckets, "h1", "h2").write.format("parquet").option("path", self.paths[name])
        writer = writer.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
        (writer.partitionBy(*parts) if parts else writer).saveAsTable(name)
        return name

    def _remove(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self.spark, self.paths.pop(name))  # the table has a path of its own, which the drop leaves

    def _run(self, name: str) -> DataFrame:
        rows = self.spark.table(name)
        return (rows.filter("not held") if "held" in rows.columns else rows).select("h1", "h2", "n_docs", "max_doc")

    def add(self, batch: DataFrame) -> None:
        """Add a batch of ``(h1, h2, doc)`` rows; no other batch may hold the same documents."""
        keys = batch.distinct().groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc").alias("max_doc"))
        marks = []
        for k, name in enumerate(self.runs()):
            marks.append(f"in_{k}")
            keys = keys.join(self._run(name).select("h1", "h2", F.lit(True).alias(marks[-1])), ["h1", "h2"], "left")
        held = F.coalesce(*marks, F.lit(False)) if marks else F.lit(False)
        # One pass writes both parts: the new run, and what the batch adds to other runs' keys.
        name = self._write(keys.select("h1", "h2", "n_docs", "max_doc", held.alias("held")), "held")
        self.batches.append(name)
        self.levels[0].append(name)
        self.compact()

    def compact(self) -> None:
        """Merge every level that has ``fanout`` runs into one run of the next."""
        k = 0
        while k < len(self.levels):
            if len(self.levels[k]) >= self.fanout:
                if k + 1 == len(self.levels):
                    self.levels.append([])
                merged = self._write(self._merged(self.levels[k]))
                for name in self.levels[k]:
                    if name not in self.batches:  # a batch's table has its notes too
                        self._remove(name)
                self.levels[k + 1].append(merged)
                self.levels[k] = []
            k += 1

    def _merged(self, names: list[str]) -> DataFrame:
        # A merge join of the sorted runs, not a union and an aggregate: Spark 4.1 takes
        # a union of tables with equal buckets for bucketed but does not line the buckets
        # up, and the rows would not be written in order.
        rows = self._run(names[0])
        for name in names[1:]:
            more = self._run(name).toDF("h1", "h2", "n", "m")
            rows = rows.join(more, ["h1", "h2"], "full_outer").select(
                "h1", "h2", F.coalesce("n_docs", "n").alias("n_docs"), F.coalesce("max_doc", "m").alias("max_doc")
            )
        return rows

    def totals(self) -> DataFrame:
        """One row per key over all batches: its run's row with its notes."""
        # Read as plain files: equal buckets of several tables would pass for lined up in the union.
        schemas = {name: self.spark.table(name).schema for name in self.batches}
        notes = [self.spark.read.schema(schemas[n]).parquet(self.paths[n]).filter("held") for n in self.batches]
        noted = reduce(DataFrame.unionByName, [n.select("h1", "h2", "n_docs", "max_doc") for n in notes])
        noted = noted.groupBy(F.col("h1").alias("a"), F.col("h2").alias("b"))
        noted = noted.agg(F.sum("n_docs").alias("n"), F.max("max_doc").alias("m"))
        noted = staged(noted, "notes")
        each = []
        for name in self.runs():
            rows = self._run(name).join(noted, (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b")), "left")
            n_docs = F.col("n_docs") + F.coalesce("n", F.lit(0))
            each.append(rows.select("h1", "h2", n_docs.alias("n_docs"), F.greatest("max_doc", "m").alias("max_doc")))
        return reduce(DataFrame.unionByName, each)

    def drop(self) -> None:
        for name in list(self.paths):
            self._remove(name)
        self.levels, self.batches = [[]], []


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = 4,
    fanout: int = 3,
) -> DataFrame:
    """Replace ``text`` by its kept lines; add ``n_lines`` and ``n_dropped``.

    Lines are what ``\\n`` splits; a null or empty text is one empty line. A
    line's key is the line without ASCII white space at either end, A-Z
    lower-cased. Keys of at least ``min_chars`` code points that at least
    ``min_docs`` documents hold lose all their lines, except in the largest
    document id that holds the key. Kept lines stay in order, joined by
    ``\\n``; a text that lost nothing is unchanged, null included, and one that
    lost every line is empty.

    Rows that share an id are one document: they count once, and those of the
    largest id keep the line in each. Rows without an id are one document too,
    which ranks below all others. Other columns pass through; columns called
    ``n_lines`` or ``n_dropped`` are replaced. An empty table gives an empty
    result; a very long text is split in the task that holds its row.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.drop("n_lines", "n_dropped")

    def keys_of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for batch, doc, t in zip(pdf["b"], pdf["d"], pdf["t"], strict=True):
                found = {line_key(line, min_chars) for line in (t or "").split("\n")} - {None}
                rows += [(batch, h1, h2, doc) for h1, h2 in found]
            yield pd.DataFrame(rows, columns=["batch", "h1", "h2", "doc"])

    kind = docs.schema[doc_id].dataType.simpleString()
    # ids travel as text so that every type and null survive pandas
    keyed = (
        docs.select(
            F.pmod(F.xxhash64(doc_id), F.lit(batches)).cast("int").alias("b"),
            F.col(doc_id).cast("string").alias("d"),
            F.col(text).alias("t"),
        )
        .mapInPandas(keys_of, "batch int, h1 long, h2 long, doc string")
        .withColumn("doc", F.col("doc").cast(kind))
    )
    # A folder a batch, so that each reads its own lines only.
    path = scratch_path(spark, "lines")
    keyed.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(keyed.schema).parquet(path)

    runs = LineRuns(spark, fanout)
    try:
        for k in range(batches):
            runs.add(lines.filter(F.col("batch") == k).select("h1", "h2", "doc"))
        dropped = staged(runs.totals().filter(F.col("n_docs") >= min_docs).select("h1", "h2", "max_doc"), "dropped")
    finally:
        runs.drop()

    d, cut = fresh_name(docs, "d"), fresh_name(docs, "cut")
    lost = (
        lines.join(dropped, ["h1", "h2"])
        .filter(~F.col("doc").eqNullSafe(F.col("max_doc")))
        .groupBy(F.col("doc").alias(d))
        .agg(F.collect_set(F.struct("h1", "h2")).alias(cut))
    )
    joined = docs.join(lost, docs[doc_id].eqNullSafe(lost[d]), "left").drop(d)

    @F.pandas_udf("kept string, n_lines long, n_dropped long")
    def keep(texts: pd.Series, cuts: pd.Series) -> pd.DataFrame:
        out = []
        for t, c in zip(texts, cuts, strict=True):
            lines = (t or "").split("\n")
            if c is None:
                out.append((t, len(lines), 0))
                continue
            gone = {(k["h1"], k["h2"]) for k in c}
            kept = [line for line in lines if line_key(line, min_chars) not in gone]
            out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
        return pd.DataFrame(out, columns=["kept", "n_lines", "n_dropped"]).astype({"n_lines": "int64", "n_dropped": "int64"})

    kept = fresh_name(docs, "kept")
    out = joined.withColumn(kept, keep(F.col(text), F.col(cut)))
    return out.select(
        *[F.col(f"{kept}.kept").alias(c) if c == text else F.col(c) for c in docs.columns],
        F.col(f"{kept}.n_lines").alias("n_lines"),
        F.col(f"{kept}.n_dropped").alias("n_dropped"),
    )
