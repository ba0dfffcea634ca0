"""Column expressions: derived columns, labels and text clipping.

All of them are built-in Catalyst expressions, so they stay inside whole-stage
codegen and run wherever the frame is partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

#: Marker put between the two halves by :func:`elide_middle`.
ELISION = "\n...\n"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Characters with a meaning in a Java regular expression.
REGEX_META = frozenset("\\^$.|?*+()[]{}")


def find(c: ColumnOrName, pattern: str) -> Column:
    """Unanchored regex search of ``pattern`` in ``c`` (null for null).

    A pattern without regex metacharacters matches exactly where it occurs as
    a substring, so it is searched as one, which is cheaper on long texts.
    """
    col = _col(c)
    if REGEX_META.isdisjoint(pattern):
        return col.contains(pattern)
    return col.rlike(pattern)


def with_expr_column(df: DataFrame, name: str, sql: str) -> DataFrame:
    """Add or replace column ``name`` with the SQL expression ``sql``."""
    return df.withColumn(name, F.expr(sql))


def make_label(name: str, num: int) -> Column:
    """Label ``"<name>_<num>"`` as a (constant-folded) string column."""
    return F.concat_ws("_", F.lit(name), F.lit(num).cast("string"))


def clip_left(c: ColumnOrName, n: int) -> Column:
    """First ``n`` characters; ``n < 0`` gives ``""``, ``n`` past the end the whole text."""
    return F.left(_col(c), F.lit(max(n, 0)))


def clip_right(c: ColumnOrName, n: int) -> Column:
    """Last ``n`` characters, with the same clamps as :func:`clip_left`."""
    return F.right(_col(c), F.lit(max(n, 0)))


def elide_middle(c: ColumnOrName, n: int) -> Column:
    """Keep ``n // 2`` characters from each end joined by :data:`ELISION`. (P5)

    Applies only when ``0 <= n <= length``; otherwise the text is unchanged.
    The marker is inserted even when ``n`` equals the length.
    """
    col = _col(c)
    if n < 0:
        return col
    half = n // 2
    return F.when(F.length(col) >= n, F.concat(clip_left(col, half), F.lit(ELISION), clip_right(col, half))).otherwise(
        col
    )


def normalise(c: ColumnOrName) -> Column:
    """Lower-case the text and strip surrounding spaces."""
    return F.trim(F.lower(_col(c)))


def normalised_prefix(c: ColumnOrName, n: int) -> Column:
    """First ``n`` characters of the normalised text."""
    return F.substring(normalise(c), 1, n)


def pattern_extract(c: ColumnOrName, pattern: str, group: int = 0) -> Column:
    """Regex match in the normalised text; ``""`` when nothing matches, null for null."""
    return F.regexp_extract(normalise(c), pattern, group)


def put_first(df: DataFrame, name: str, col: Column) -> DataFrame:
    """Project ``col`` as ``name`` ahead of the existing columns."""
    return df.select(col.alias(name), *[F.col(f"`{c}`") for c in df.columns if c != name])
