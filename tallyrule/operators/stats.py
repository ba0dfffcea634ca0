"""Group counts and per-column marginal totals.

``count_statistics`` never puts one key's tuples into a single window
partition: the joint counts are aggregated once (map-side partial aggregation
absorbs hot keys), and one more partial aggregation over them gives the
marginals of all columns together: each count is read once, spread to one row a
column, and summed by (column, value). Every column's join then looks its values
up in that one table, so the joint counts are read twice however many columns
there are. The table holds one row per column and distinct value; adaptive
execution broadcasts it (once, for all joins) when it is small and otherwise
runs sort-merge joins whose skewed partitions it splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: Private name of the joint count, so a data column called ``count`` is safe.
_N = "__tally_n"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def group_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct key tuples with their row count in a private column."""
    return df.groupBy(*[_c(c) for c in cols]).agg(F.count(F.lit(1)).alias(_N))


def coarser_counts(counts: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Counts over a subset of the keys of :func:`group_counts`, from the finer ones."""
    return counts.groupBy(*[_c(c) for c in cols]).agg(F.sum(_N).cast("bigint").alias(_N))


def groups_from_counts(counts: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A1 over precomputed :func:`group_counts`."""
    # Sorted before the rename: a key may itself be called ``count``.
    ordered = counts.orderBy(_c(_N).desc(), *[_c(c).asc() for c in cols])
    return ordered.select(*[_c(c) for c in cols], _c(_N).alias("count"))


def count_group_by(df: DataFrame, *cols: str) -> DataFrame:
    """Rows per key tuple, largest first; the key columns then ``count``. (A1, O1)

    Ties are ordered by the keys so the sort is total and range partitions
    stay balanced. With no columns the result is the total row count.
    """
    if not cols:
        return df.agg(F.count(F.lit(1)).alias("count"))
    return groups_from_counts(group_counts(df, cols), cols)


def statistics_from_counts(counts: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A2 over precomputed :func:`group_counts`."""
    if not cols:
        raise ValueError("count_statistics needs at least one column")
    if len(cols) == 1:
        # One key: its marginal is the joint count itself.
        (c,) = cols
        return counts.select(_c(c), _c(_N).alias(f"{c}_count")).orderBy(F.col(f"{c}_count").desc(), _c(c).asc())
    kinds = [counts.schema[c].dataType for c in cols]

    def key(i: int) -> Column:
        """The value of the column ``i``, marked with its place; nulls compare equal inside."""
        fields = [_c(c) if j == i else F.lit(None).cast(kinds[j]) for j, c in enumerate(cols)]
        return F.struct(F.lit(i).alias("i"), *[f.alias(f"k{j}") for j, f in enumerate(fields)])

    marginals = counts.select(_N, F.explode(F.array(*[key(i) for i in range(len(cols))])).alias("__tally_k"))
    marginals = marginals.groupBy("__tally_k").agg(F.sum(_N).cast("bigint").alias("__tally_m"))
    out = counts
    for i, c in enumerate(cols):
        side = marginals.select(F.col("__tally_k").alias(f"__tally_k{i}"), F.col("__tally_m").alias(f"{c}_count"))
        out = out.join(side, key(i) == F.col(f"__tally_k{i}"), "inner").drop(f"__tally_k{i}")
    # Ties on every marginal are broken by the joint count, then the keys:
    # the order is total (balanced range partitions), and because the sort
    # reads the joint count the base side stays the very aggregate that the
    # marginals sum, so the input is read once.
    return out.orderBy(
        *[_c(f"{c}_count").desc() for c in cols], F.col(_N).desc(), *[_c(c).asc() for c in cols]
    ).select(*[_c(c) for c in cols], *[_c(f"{c}_count") for c in cols])


def count_statistics(df: DataFrame, *cols: str) -> DataFrame:
    """For each key tuple, the total rows of each of its key values.

    Output: the key columns, then ``<col>_count`` for each, without the joint
    count; ordered by the marginals, largest first, in argument order. Null
    keys form one group.
    """
    return statistics_from_counts(group_counts(df, cols), cols)


def count_rows(df: DataFrame) -> int:
    """Total row count (one job). (A3)"""
    return df.count()


def observe_rows(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Count rows as a side effect of the next action on the returned frame. (A3)"""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def rows_per_partition(df: DataFrame) -> DataFrame:
    """Rows in each partition of ``df``: ``partition_id``, ``rows``."""
    return (
        df.select(F.spark_partition_id().alias("partition_id"))
        .groupBy("partition_id")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def peek(df: DataFrame, n: int = 20) -> DataFrame:
    """At most ``n`` rows for display. (L1)"""
    return df.limit(n)
