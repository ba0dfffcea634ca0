"""The cluster job as a stream: new line files are labelled and appended.

Structured Streaming tracks which files were processed in a checkpoint under
the session's shared checkpoint folder, so a restarted (or
executor-crashed) run neither loses nor repeats files. The plan per
micro-batch is the batch job's: split, type, classify — a pure projection, so
no shuffle and no state; each task writes its rows into the label directories
it touches.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyrule.operators.classify import Spec, classify
from tallyrule.operators.rows import drop_equal_rows, split_lines, with_schema
from tallyrule.plans.merchant_spec import MERCHANT_SPEC
from tallyrule.plans.schemas import LABEL_COL, MERCHANT_SCHEMA

LINE_SCHEMA = T.StructType([T.StructField("line", T.StringType())])


def stream_clusters(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    spec: Spec = MERCHANT_SPEC,
    schema: T.StructType = MERCHANT_SCHEMA,
    sep: str = "\t",
    drop_row: Any = None,
    label: str = LABEL_COL,
    checkpoint: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start labelling every line file that lands in ``source``.

    Each file's first line is a header. ``drop_row`` (a one-value row) and
    its copies are removed, as the batch job removes its first row; a stream
    has no "first row", so it must be given. With ``available_now`` the query
    processes what is there and stops; otherwise it keeps running.
    The checkpoint lies with the target (``_checkpoint``, which readers pass
    over) unless ``checkpoint`` names another place, so a later run with the
    same target continues where the last one stopped.
    """
    reader = spark.readStream.schema(LINE_SCHEMA).options(header="true", sep="$", encoding="UTF-8")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    text = reader.csv(source)
    labelled = classify(with_schema(split_lines(drop_equal_rows(text, drop_row), sep, schema), schema), spec, label)
    writer = (
        labelled.writeStream.format("csv")
        .options(header="true", sep=sep, encoding="UTF-8")
        .partitionBy(label)
        .option("checkpointLocation", checkpoint or f"{target.rstrip('/')}/_checkpoint")
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start(target)
