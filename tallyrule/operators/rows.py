"""Raw lines → typed rows, and removal of a known row.

Splitting is a column expression (``split`` + ``size``), so the raw-line scan
keeps column pruning and codegen; no per-row Python is involved.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrule.functions.columns import REGEX_META


def _parts(line: Column, sep: str) -> Column:
    if len(sep) == 1 and sep not in REGEX_META:
        # A single literal character: trimming it is the same as stripping
        # the regex and about twice as fast.
        stripped = F.rtrim(line, F.lit(sep))
    else:
        stripped = F.regexp_replace(line, f"(?:{sep})+\\z", "")
    # A line of separators only has no parts at all (an empty line has one).
    return F.when((stripped == "") & (line != ""), F.array().cast("array<string>")).otherwise(F.split(stripped, sep, -1))


def _field_names(names: Sequence[str] | T.StructType | int) -> list[str]:
    if isinstance(names, int):
        return [f"_c{i}" for i in range(names)]
    return names.fieldNames() if isinstance(names, T.StructType) else list(names)


def split_lines(
    df: DataFrame,
    sep: str = "\t",
    names: Sequence[str] | T.StructType | int = 17,
    line_col: str | None = None,
) -> DataFrame:
    """Split one text column by the regex ``sep`` into exactly ``len(names)`` columns.

    Trailing empty parts are discarded before counting, so a line whose last
    field is empty falls short and is dropped, like every line with a
    different number of parts. Empty middle fields stay empty strings.
    :func:`split_outcomes` keeps what is dropped here, with the reason.
    """
    names = _field_names(names)
    return (
        df.select(_parts(F.col(f"`{line_col or df.columns[0]}`"), sep).alias("__parts"))
        .filter(F.size("__parts") == len(names))
        .select(*[F.col("__parts")[i].alias(name) for i, name in enumerate(names)])
    )


#: What becomes of a line, in the column that :func:`split_outcomes` adds.
KEPT, TOO_FEW, TOO_MANY, MALFORMED = "kept", "too_few", "too_many", "malformed"
OUTCOMES = (KEPT, TOO_FEW, TOO_MANY, MALFORMED)


def split_outcomes(
    df: DataFrame,
    sep: str = "\t",
    names: Sequence[str] | T.StructType | int = 17,
    line_col: str | None = None,
    outcome: str = "outcome",
    rejected: str = "rejected",
) -> DataFrame:
    """:func:`split_lines` without dropping: the fields, ``outcome`` and ``rejected``, one row a line.

    ``outcome`` is ``kept``, ``too_few`` or ``too_many`` (parts), or
    ``malformed`` for a null line. A line that is not kept has null fields and
    its text in ``rejected``, which is null for the others. Written partitioned
    by ``outcome``, one pass gives the rows and a table of rejects.
    """
    names = _field_names(names)
    line, parts = F.col("__line"), F.col("__parts")
    split = df.select(F.col(f"`{line_col or df.columns[0]}`").alias("__line")).withColumn("__parts", _parts(line, sep))
    size = F.size(parts)
    kept = line.isNotNull() & (size == len(names))
    reason = F.when(line.isNull(), MALFORMED).when(size < len(names), TOO_FEW).when(size > len(names), TOO_MANY)
    return split.select(
        *[F.when(kept, F.get(parts, F.lit(i))).alias(name) for i, name in enumerate(names)],
        reason.otherwise(KEPT).alias(outcome),
        F.when(~kept, line).alias(rejected),
    )


def observe_outcomes(df: DataFrame, outcome: str = "outcome", name: str = "outcomes") -> tuple[DataFrame, Observation]:
    """Count the rows of each outcome as a side effect of the next action on the returned frame.

    The observation holds ``lines`` and one number for each of :data:`OUTCOMES`;
    ``lines`` is their sum. Filter for what is kept after it, not before.
    """
    seen = Observation(name)
    each = [F.count_if(F.col(f"`{outcome}`") == o).alias(o) for o in OUTCOMES]
    return df.observe(seen, F.count(F.lit(1)).alias("lines"), *each), seen


def with_schema(df: DataFrame, schema: T.StructType, cast: bool = True, tolerant: bool = False) -> DataFrame:
    """Attach ``schema`` to the columns of ``df`` by position. (R2)

    A field that does not fit its type is an error; with ``tolerant`` it
    becomes null, and :func:`cast_failures` counts such fields.
    """
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"frame has {len(df.columns)} columns, schema {len(schema.fields)}")
    cols = []
    for c, f in zip(df.columns, schema.fields):
        col = F.col(f"`{c}`")
        if cast:
            col = col.try_cast(f.dataType) if tolerant else col.cast(f.dataType)
        elif df.schema[c].dataType != f.dataType:
            raise TypeError(f"column {c} is {df.schema[c].dataType}, schema says {f.dataType}")
        cols.append(col.alias(f.name))
    return df.select(*cols)


def cast_failures(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: for each field of ``schema``, the values of ``df`` that a tolerant cast makes null."""
    pairs = list(zip(df.columns, schema.fields))
    return df.agg(
        *[
            F.count(F.when(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(f.dataType).isNull(), 1)).alias(f.name)
            for c, f in pairs
        ]
    )


def relabel(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rename the columns of ``df`` by position; types must already agree."""
    return with_schema(df, schema, cast=False)


def first_row(df: DataFrame, *order_by: Any) -> Row | None:
    """The first row, or ``None`` for an empty frame. (F1)

    Without ``order_by``, a frame that is read from files (and at most filtered
    or projected since) gives its first row in the order of their paths: files
    without rows are passed over, and within a file the place in it decides. So
    the answer does not depend on how Spark packs files into tasks. Any other
    frame gives whatever row Spark reads first; pass an ordering when the choice
    must be stable.
    """
    if order_by:
        return df.orderBy(*order_by).first()
    path, start, place = "__first_path", "__first_start", "__first_place"

    def least(rows: DataFrame) -> Row | None:
        """Of these rows, the one whose file, block in it and place in that come first."""
        placed = rows.select(
            "*",
            F.col("_metadata.file_path").alias(path),
            F.col("_metadata.file_block_start").alias(start),
            F.monotonically_increasing_id().alias(place),
        )
        return placed.orderBy(path, start, place).drop(path, start, place).first()

    try:
        df.select("_metadata.file_path")
    except AnalysisException:
        return df.first()
    # A filter on the path skips the other files, so as a rule one file is read;
    # after files without rows more are tried at once.
    names, at, many = sorted(df.inputFiles()), 0, 1
    while at < len(names):
        tried = names[at : at + many]
        tried += [n.replace(":///", ":/", 1) for n in tried]  # either spelling of a local path
        found = least(df.filter(F.col("_metadata.file_path").isin(tried)))
        if found is not None:
            return found
        at, many = at + many, 8 * many
    return least(df)  # no rows, or a file system that spells its paths in another way


def drop_equal_rows(df: DataFrame, row: Row | Mapping[str, Any] | Sequence[Any] | None) -> DataFrame:
    """Drop every row equal to ``row`` (null-safe, all columns); ``None`` keeps all. (F2)"""
    if row is None:
        return df
    if isinstance(row, Row):
        values = list(row)
    elif isinstance(row, Mapping):
        values = [row[c] for c in df.columns]
    else:
        values = list(row)
    if len(values) != len(df.columns):
        raise ValueError(f"row has {len(values)} values, frame {len(df.columns)} columns")
    same = reduce(
        lambda a, b: a & b,
        (F.col(f"`{c}`").eqNullSafe(F.lit(v)) for c, v in zip(df.columns, values)),
    )
    return df.filter(~same)
