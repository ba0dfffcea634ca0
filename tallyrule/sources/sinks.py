"""Writers: a tree partitioned by label columns, and an unpartitioned table.

Output grouping is the writer's single shuffle. With adaptive execution on,
the frame is rebalanced by the partition columns: small labels end up in one
file each, and a label holding a large share of the rows is split across
several tasks (and files) instead of landing in one. Without adaptive
execution the labels are counted first, and each gets as many files as its rows
ask for. Which file a row goes to follows from its content alone and, for rows
equal in every column, from a number that a partial count gives each of them;
so a task that is run again deals its rows as before.

Overwriting never touches what is there until the new tree is complete:
it is written beside the target and then takes its place.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tallyrule.scratch import exists, remove, rename

#: Rows that a file of a label should hold when adaptive execution is off.
ROWS_PER_FILE = 1_000_000

#: At most so many labels can have more rows than a file should hold.
MAX_LARGE = 10_000


def _adaptive(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"


def _writer(
    df: DataFrame, format: str, mode: str, encoding: str, header: bool, sep: str, options: dict
) -> DataFrameWriter:
    w = df.write.format(format).mode(mode)
    if format == "csv":
        w = w.options(encoding=encoding, header=str(header).lower(), sep=sep)
    return w.options(**options)


def _numbered_copies(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a number from 0 for each of the rows that are equal in every column."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    step = 4096  # copies come back in two steps, so that no array is long
    steps = F.sequence(F.lit(0).cast("long"), F.floor((F.col(name) - 1) / step))
    first = F.col(name)["first"]
    last = F.least(first + step, F.col(name)["n"]) - 1
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))
    blocks = F.explode(F.transform(steps, lambda s: F.struct((s * step).alias("first"), F.col(name).alias("n"))))
    return counted.withColumn(name, blocks).withColumn(name, F.explode(F.sequence(first, last)))


def _salted(df: DataFrame, cols: list[str], salt: int | None, rows_per_file: int) -> DataFrame:
    """``df`` dealt out by label and, for labels with many rows, by content."""
    taken = {c.lower() for c in df.columns}
    copy, salts = (next(n for n in (f"__{s}{'_' * k}" for k in range(len(taken) + 1)) if n not in taken) for s in ("copy", "salts"))
    labels = [F.col(f"`{c}`") for c in cols]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _numbered_copies(df, copy)
    if salt is not None:
        rows = rows.withColumn(salts, F.lit(salt).cast("long"))
    else:
        counts = df.groupBy(*labels).agg(F.count(F.lit(1)).alias(salts))
        total = counts.agg(F.sum(salts)).first()[0] or 0
        # A file's worth of rows, or a task's fair share if that is less.
        most = max(min(rows_per_file, -(-total // parts)), -(-total // MAX_LARGE))
        # Fewer than MAX_LARGE labels can have more than that many rows each. Buckets meet
        # in partitions by chance, so there are two for each share.
        large = counts.filter(F.col(salts) > most).withColumn(salts, 2 * F.ceil(F.col(salts) / F.lit(most)))
        names = [f"{salts}{i}" for i in range(len(cols))]
        large = large.select(*[c.alias(n) for c, n in zip(labels, names)], F.col(salts))
        same = [c.eqNullSafe(F.col(n)) for c, n in zip(labels, names)]
        rows = rows.join(F.broadcast(large), same, "left").drop(*names)
    content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], copy)
    # a stated number of partitions, which adaptive execution does not merge
    return rows.repartition(parts, *labels, F.pmod(content, F.coalesce(F.col(salts), F.lit(1)))).drop(copy, salts)


def _replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a folder beside ``path``, then put it in its place.

    If the write fails, the old tree is as it was. Between the two renames
    there is a moment without a tree; where a rename fails the old one is put
    back.
    """
    stem, mark = path.rstrip("/"), uuid.uuid4().hex
    head, _, tail = stem.rpartition("/")
    fresh, old = (f"{head}/_{kind}-{mark}-{tail}" if head else f"_{kind}-{mark}-{tail}" for kind in ("new", "old"))
    try:
        write(fresh)
    except BaseException:
        remove(spark, fresh)
        raise
    moved = rename(spark, stem, old)
    if not rename(spark, fresh, stem):
        if moved:
            rename(spark, old, stem)
        remove(spark, fresh)
        raise OSError(f"could not put the new tree in place of {path}")
    if moved:
        remove(spark, old)


def _save(writer: DataFrameWriter, spark: SparkSession, path: str, mode: str, options: dict) -> None:
    setting = "partitionOverwriteMode"
    partly = options.get(setting, spark.conf.get(f"spark.sql.sources.{setting}", "static")).lower() == "dynamic"
    if mode == "overwrite" and not partly and exists(spark, path):
        _replace(spark, path, lambda fresh: writer.mode("errorifexists").save(fresh))
    else:
        writer.save(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    cols: Sequence[str],
    *,
    format: str = "csv",
    mode: str = "overwrite",
    encoding: str = "UTF-8",
    header: bool = True,
    sep: str = "\t",
    salt: int | None = None,
    rebalance: bool = True,
    rows_per_file: int = ROWS_PER_FILE,
    adaptive: bool | None = None,
    **options: str,
) -> None:
    """Write ``df`` under ``path`` with one directory per value of ``cols``.

    ``adaptive`` says whether adaptive execution deals out the rows, by default
    as the session has it; if not, a label with more than ``rows_per_file`` rows,
    or than its share of a task, is split into buckets, or into ``salt`` buckets
    where that is given. ``maxRecordsPerFile`` can be passed to bound files.
    ``rebalance=False`` skips the shuffle: each task writes straight into the
    directories of the labels it holds (no data movement, up to tasks × labels
    files).
    """
    cols = list(cols)
    if not cols:
        raise ValueError("write_partitioned needs at least one column; use write_unpartitioned")
    if not rebalance:
        grouped = df
    elif salt is None and (_adaptive(df) if adaptive is None else adaptive):
        grouped = df.hint("rebalance", *cols)
    else:
        grouped = _salted(df, cols, salt, rows_per_file)
    writer = _writer(grouped, format, mode, encoding, header, sep, options).partitionBy(*cols)
    _save(writer, df.sparkSession, path, mode, options)


def write_unpartitioned(
    df: DataFrame,
    path: str,
    *,
    format: str = "csv",
    mode: str = "overwrite",
    encoding: str = "UTF-8",
    header: bool = True,
    sep: str = "\t",
    **options: str,
) -> None:
    """Write ``df`` as one directory of files sized by adaptive execution.

    Small frames come out as a single file; large ones are never funnelled
    through one task.
    """
    out = df.hint("rebalance") if _adaptive(df) else df
    _save(_writer(out, format, mode, encoding, header, sep, options), df.sparkSession, path, mode, options)
