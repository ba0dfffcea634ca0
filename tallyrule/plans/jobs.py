"""The three jobs: cluster raw lines, check a written result, find unbranded rows.

Each job is lazy except where it must act: the cluster job stages its labelled
rows, writes its result and counts from the stage (so no report replays the raw
input), and the brand job collects its bounded rule set once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyrule.functions.columns import normalised_prefix, pattern_extract
from tallyrule.operators.classify import Spec, classify
from tallyrule.operators.filters import filter_eq_or_null, unlabelled
from tallyrule.operators.rows import drop_equal_rows, first_row, split_lines, with_schema
from tallyrule.operators.rules import MAX_RULES, compile_rules, label_by_rules
from tallyrule.operators.stats import (
    coarser_counts,
    group_counts,
    groups_from_counts,
    observe_rows,
    statistics_from_counts,
)
from tallyrule.plans.merchant_spec import BRAND_PATTERN, BRAND_SUPERCAT, MERCHANT_SPEC, PREFIX_LEN
from tallyrule.plans.schemas import LABEL_COL, MERCHANT_SCHEMA
from tallyrule.scratch import checkpoint_dir, scratch_path
from tallyrule.sources.delimited import read_lines, read_partitioned
from tallyrule.sources.sinks import write_partitioned

#: Marker for "take the first row of the input", as the cluster job does by default.
FIRST = object()

#: Options of a write that a read does not have.
_WRITE_ONLY = {"mode", "rebalance", "rows_per_file", "adaptive", "maxRecordsPerFile", "compression"}


@dataclass
class Reports:
    """Marginal statistics and plain group counts over the same keys.

    ``labelled`` (brand job only) counts every labelled row; it is filled by
    the first action that reads the input.
    """

    statistics: DataFrame
    groups: DataFrame
    labelled: Any = None


def reports(df: DataFrame, keys: Sequence[str], reuse: bool | None = None) -> Reports:
    """Both count reports from one grouping.

    With ``reuse`` the joint counts are checkpointed to the session's shared
    checkpoint folder, so evaluating both reports reads the input once. The
    default (``None``) reuses whenever that folder is set; pass ``False`` when
    only one report will be evaluated.
    """
    counts = group_counts(df, keys)
    if reuse is None:
        reuse = checkpoint_dir(df.sparkSession) is not None
    if reuse:
        counts = counts.checkpoint(eager=True)
    return Reports(statistics_from_counts(counts, keys), groups_from_counts(counts, keys))


@dataclass
class ClusterRun:
    input_statistics: DataFrame
    label_statistics: DataFrame
    written: DataFrame
    rows_written: int
    lines_read: int
    header_row: Any


def create_clusters(
    spark: SparkSession,
    source: str | list[str],
    target: str,
    *,
    spec: Spec = MERCHANT_SPEC,
    schema: T.StructType = MERCHANT_SCHEMA,
    sep: str = "\t",
    drop_row: Any = FIRST,
    label: str = LABEL_COL,
    salt: int | None = None,
    format: str = "csv",
    reuse: bool | None = None,
    read_options: Mapping[str, str] | None = None,
    **write_options: str,
) -> ClusterRun:
    """Raw tab lines → typed rows → labels → tree partitioned by label.

    Each file's header line is consumed; then ``drop_row`` (by default the
    first remaining row) and every line equal to it are removed. Lines that do
    not split into exactly ``len(schema)`` fields are dropped. The tree is
    written in ``format``: delimited text by default, or e.g. ``"parquet"``.
    Both reports and ``rows_written`` come from the labelled rows, staged under
    ``spark.checkpoint.dir``, not from the tree; ``written`` reads the tree with
    the options it was written with. The stage goes when the caller's
    :func:`tallyrule.scratch.scratch_scope` ends; a tree that is overwritten
    stays readable until the new one is complete. ``read_options`` go to :func:`read_lines`
    (another ``sep`` or ``quote`` keeps text that the defaults cut). On several
    files the first row is that of the first path (:func:`first_row`). ``reuse``
    works as in :func:`reports`.
    """
    text = read_lines(spark, source, **(read_options or {}))
    header_row = first_row(text) if drop_row is FIRST else drop_row
    # Counted in flight by the one pass over the raw lines.
    observed_text, lines_obs = observe_rows(text, "lines")
    data = with_schema(split_lines(drop_equal_rows(observed_text, header_row), sep, schema), schema)
    labelled = classify(data, spec, label)
    # The labelled rows are staged columnar: the tree is written from the stage,
    # and the reports count its two columns. So the reports hold what was
    # labelled, whatever the tree's format makes of blanks and empty text, and
    # the raw lines are parsed once.
    stage = scratch_path(spark, "labelled")
    labelled.write.parquet(stage)
    labelled = spark.read.schema(labelled.schema).parquet(stage)
    write_partitioned(labelled, target, [label], sep=sep, salt=salt, format=format, **write_options)
    written = read_partitioned(
        spark,
        target,
        schema,
        label,
        sep=sep,
        format=format,
        **{k: v for k, v in write_options.items() if k not in _WRITE_ONLY},
    )
    keys = [spec.outer, label]
    counts = group_counts(labelled, keys)
    if reuse is None:
        reuse = checkpoint_dir(spark) is not None
    if reuse:
        counts = counts.checkpoint(eager=True)
    return ClusterRun(
        input_statistics=statistics_from_counts(coarser_counts(counts, [spec.outer]), [spec.outer]),
        label_statistics=statistics_from_counts(counts, keys),
        written=written,
        rows_written=labelled.count(),
        # An input without a line observes nothing.
        lines_read=0 if text.isEmpty() else lines_obs.get["rows"],
        header_row=header_row,
    )


def check_result(
    spark: SparkSession,
    path: str,
    *,
    schema: T.StructType = MERCHANT_SCHEMA,
    keys: Sequence[str] = ("mcc_supercat", LABEL_COL, "mcc_cat"),
    label: str = LABEL_COL,
    reuse: bool | None = None,
    **read_options: str,
) -> Reports:
    """Statistics and group counts over a tree written by :func:`create_clusters`."""
    return reports(read_partitioned(spark, path, schema, label, **read_options), keys, reuse)


def unbranded(
    data: DataFrame,
    rules: DataFrame,
    *,
    supercat: str | None = BRAND_SUPERCAT,
    name_col: str = "merchant_nm",
    brand: str = "brand",
    pattern: str = BRAND_PATTERN,
    prefix_len: int = PREFIX_LEN,
    max_rules: int = MAX_RULES,
    observation: list | None = None,
) -> DataFrame:
    """Rows of ``data`` no rule of ``supercat`` labels, with the derived name columns.

    Adds ``brand`` (always null here), ``merchant_clr`` (normalised name
    prefix) and ``test_reg_exp`` (``pattern`` found in the normalised name).
    If ``observation`` is a list, the Observation counting all labelled rows
    is appended to it; it is filled by the first action on the result.
    """
    compiled = compile_rules(
        filter_eq_or_null(rules, "mcc_supercat", supercat), max_rules=max_rules, schema=data.schema
    )
    # Labelled rows are counted in flight. The filter on the label stays above
    # that count, so the rules run once per row, in the labelling projection,
    # and the label stays a data column (a literal null would turn the
    # statistics' joins on it into joins without keys).
    labelled, counted = observe_rows(label_by_rules(data, brand, compiled), "labelled")
    out = (
        unlabelled(labelled, brand)
        .withColumn("merchant_clr", normalised_prefix(name_col, prefix_len))
        .withColumn("test_reg_exp", pattern_extract(name_col, pattern))
    )
    if observation is not None:
        observation.append(counted)
    return out


def create_brands(
    data: DataFrame,
    rules: DataFrame,
    *,
    keys: Sequence[str] = (
        "mcc_supercat",
        LABEL_COL,
        "mcc_name",
        "mcc_code",
        "brand",
        "test_reg_exp",
        "merchant_clr",
    ),
    reuse: bool | None = None,
    **kwargs: Any,
) -> Reports:
    """Label ``data`` with one super-category's rules and report on what stays unbranded."""
    counted: list = []
    out = reports(unbranded(data, rules, observation=counted, **kwargs), keys, reuse)
    out.labelled = counted[0]
    return out
