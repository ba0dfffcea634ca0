"""Readers: delimited rows under a declared schema, raw lines, result trees, rule tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrule.operators.rows import KEPT, MALFORMED
from tallyrule.plans.schemas import LABEL_COL, RULE_SCHEMA, with_label_field


def _csv_options(mode: str | None, encoding: str, header: bool, sep: str, infer_schema: bool) -> dict[str, str]:
    opts = {"encoding": encoding, "header": str(header).lower(), "sep": sep, "inferSchema": str(infer_schema).lower()}
    if mode is not None:
        opts["mode"] = mode
        if mode.upper() == "DROPMALFORMED":
            # Keep "malformed" a property of the whole line: with pruning on,
            # a count or a narrow select would keep rows a full read drops.
            opts["columnPruning"] = "false"
    return opts


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    *,
    format: str = "csv",
    mode: str | None = "DROPMALFORMED",
    encoding: str = "UTF-8",
    header: bool = True,
    sep: str = "\t",
    infer_schema: bool = False,
    **options: str,
) -> DataFrame:
    """Read rows under ``schema``; defaults are tab-separated UTF-8 with a header.

    ``\\N`` and other null markers stay text unless ``nullValue`` is passed.
    Any Spark format works; the delimited options apply to ``csv`` only.
    """
    reader = spark.read.format(format).schema(schema)
    if format == "csv":
        reader = reader.options(**_csv_options(mode, encoding, header, sep, infer_schema))
    return reader.options(**options).load(path)


def read_delimited_outcomes(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    *,
    encoding: str = "UTF-8",
    header: bool = True,
    sep: str = "\t",
    outcome: str = "outcome",
    rejected: str = "rejected",
    **options: str,
) -> DataFrame:
    """:func:`read_delimited` of text without dropping malformed lines.

    Every line of the files (headers and blank lines aside) is a row. Where the
    default read of all columns would drop it (another number of fields, a field
    that is not of its type), ``outcome`` is ``malformed`` and ``rejected``
    holds the line; else they are ``kept`` and null. That does not depend on
    which columns are used afterwards: a line is parsed as a whole.
    """
    lines = read_lines(spark, path, encoding=encoding, header=header, sep="\u0001", quote="")
    parsed = T.StructType([*schema.fields, T.StructField("__malformed", T.StringType())])
    settings = {"mode": "PERMISSIVE", "sep": sep, "columnNameOfCorruptRecord": "__malformed", **options}
    line = F.col(f"`{lines.columns[0]}`")
    rows = lines.select(F.from_csv(line, F.lit(parsed.toDDL()), settings).alias("__row"))
    bad = F.col("__row.__malformed").isNotNull()
    fields = [F.when(~bad, F.col(f"__row.`{f.name}`")).alias(f.name) for f in schema.fields]
    return rows.select(*fields, F.when(bad, MALFORMED).otherwise(KEPT).alias(outcome), F.col("__row.__malformed").alias(rejected))


def read_partitioned(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    label: str = LABEL_COL,
    mode: str | None = "PERMISSIVE",
    **kwargs,
) -> DataFrame:
    """Read a tree written by :func:`write_partitioned` (or the stream) from its root.

    The label comes back from the directory names as a string column after the
    data columns. Trees written by this library hold well-formed rows only, so
    the default mode is ``PERMISSIVE``: over a streaming sink's committed-file
    index, ``DROPMALFORMED`` without column pruning counts the label as a data
    field and drops every row.
    """
    return read_delimited(spark, path, with_label_field(schema, label), mode=mode, **kwargs)


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    *,
    encoding: str = "UTF-8",
    header: bool = True,
    sep: str = "$",
    quote: str = '"',
    **options: str,
) -> DataFrame:
    """Whole lines as one string column named by the header line.

    The lines go through the delimited reader with a separator that should not
    occur, so a tab-separated line lands in one column. Consequences of the
    defaults: blank lines vanish, text after a ``$`` is cut, a leading ``"``
    opens a quoted field and each file's first line is its header. Pass
    ``sep="\\u0001", quote=""`` to keep lines verbatim.
    """
    return (
        spark.read.options(
            encoding=encoding, header=str(header).lower(), sep=sep, quote=quote, inferSchema="false", **options
        ).csv(path)
    )


def read_rules(
    spark: SparkSession,
    path: str | list[str],
    *,
    format: str = "csv",
    header: bool = True,
    sep: str = ",",
    schema: T.StructType = RULE_SCHEMA,
    **options: str,
) -> DataFrame:
    """Read a rule table under ``schema``; empty text cells become null. (S3)

    Every rule is kept; :func:`tallyrule.operators.rules.compile_rules` sets the
    bound, loudly, on what may reach the driver.
    """
    reader = spark.read.format(format).schema(schema)
    if format == "csv":
        reader = reader.options(header=str(header).lower(), sep=sep, mode="PERMISSIVE")
    df = reader.options(**options).load(path)
    df = df.select(
        *[
            F.when(F.col(f.name) == "", None).otherwise(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in schema.fields
        ]
    )
    return df
