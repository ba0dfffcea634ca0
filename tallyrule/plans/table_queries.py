"""Every operator as a query over the driver's tables, with its DuckDB oracle.

Each query takes ``(spark, sf_dir)`` and reads whole tables. Queries that
exercise a writer write under the session's checkpoint folder (a fresh path
per call) and return a frame over what they wrote. Oracle SQL names every
computed column exactly as the Spark query does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrule.functions.columns import (
    clip_left,
    clip_right,
    elide_middle,
    normalised_prefix,
    pattern_extract,
    with_expr_column,
)
from tallyrule.operators.classify import Expr, Group, IsIn, Matches, Rule, Spec, Tree, classify
from tallyrule.operators.filters import filter_eq_or_null, filter_none_rlike, filter_rlike_or_null
from tallyrule.operators.rows import drop_equal_rows, first_row, relabel, split_lines, with_schema
from tallyrule.operators.rules import compile_rules, label_by_rules
from tallyrule.operators.stats import (
    count_group_by,
    count_rows,
    count_statistics,
    observe_rows,
    peek,
    rows_per_partition,
)
from tallyrule.plans.jobs import check_result, create_brands, create_clusters
from tallyrule.plans.merchant_spec import SUPERCAT_PATTERNS
from tallyrule.plans.schemas import RULE_SCHEMA
from tallyrule.scratch import scratch_path
from tallyrule.sources.delimited import read_delimited, read_lines, read_partitioned, read_rules
from tallyrule.sources.sinks import write_partitioned, write_unpartitioned
from tallyrule.streaming.clusters import stream_clusters

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)


# --- parameters of the queries over `part` --------------------------------------

PART_SCHEMA = T.StructType(
    [
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("p_brand", T.StringType()),
        T.StructField("p_type", T.StringType()),
        T.StructField("p_size", T.IntegerType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ]
)

CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)

#: The part-line fields the cluster job splits into (all text).
PART_LINE_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("p_partkey", "p_name", "p_brand", "p_type", "p_size")]
)

PART_SPEC = Spec(
    outer="p_type",
    groups=(
        Group("PROMO", "promo", Tree((Rule(IsIn("p_brand", ("Brand#1", "Brand#2")), 1),), default=2)),
        Group("LARGE", "large", Tree((Rule(Matches("p_name", ("widget",)), 1),), default=2)),
    ),
    fallback="0",
)

PART_SPEC_SQL = (
    "CASE WHEN p_type IS NOT DISTINCT FROM 'PROMO' THEN "
    "CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'promo_1' ELSE 'promo_2' END "
    "WHEN p_type IS NOT DISTINCT FROM 'LARGE' THEN "
    "CASE WHEN regexp_matches(p_name, 'widget') THEN 'large_1' ELSE 'large_2' END "
    "ELSE '0' END"
)

LINEITEM_SPEC = Spec(
    outer="l_returnflag",
    groups=(
        Group("R", "returned", Tree((Rule(IsIn("l_linestatus", ("F",)), 1),), default=2)),
        Group("A", "accepted", Tree((Rule(Expr("l_discount >= 0.05"), 1), Rule(Expr("l_quantity > 25"), 2)), default=3)),
    ),
)

LINEITEM_SPEC_SQL = (
    "CASE WHEN l_returnflag IS NOT DISTINCT FROM 'R' THEN "
    "CASE WHEN l_linestatus IN ('F') THEN 'returned_1' ELSE 'returned_2' END "
    "WHEN l_returnflag IS NOT DISTINCT FROM 'A' THEN "
    "CASE WHEN l_discount >= 0.05 THEN 'accepted_1' WHEN l_quantity > 25 THEN 'accepted_2' ELSE 'accepted_3' END "
    "ELSE '0' END"
)

CUSTOMER_SPEC = Spec(
    outer="c_mktsegment",
    groups=(
        Group("AUTOMOBILE", "auto", Tree((Rule(Expr("c_acctbal < 0"), 1), Rule(Expr("c_acctbal >= 5000"), 2)), default=3)),
        Group("BUILDING", "build", Tree((Rule(Expr("c_nationkey < 10"), 1),), default=2)),
    ),
)

CUSTOMER_SPEC_SQL = (
    "CASE WHEN c_mktsegment IS NOT DISTINCT FROM 'AUTOMOBILE' THEN "
    "CASE WHEN c_acctbal < 0 THEN 'auto_1' WHEN c_acctbal >= 5000 THEN 'auto_2' ELSE 'auto_3' END "
    "WHEN c_mktsegment IS NOT DISTINCT FROM 'BUILDING' THEN "
    "CASE WHEN c_nationkey < 10 THEN 'build_1' ELSE 'build_2' END "
    "ELSE '0' END"
)

EVENT_RULES = [
    (1, "event_type = 'purchase' and value >= 100", "big_purchase", "E", None),
    (2, "event_type = 'error'", "error", "E", None),
    (3, "props rlike '\"k\": 9[0-9]'", "k9x", "E", None),
]

DOCUMENT_RULES = [
    (1, "lang = 'en' and n_chars > 20000", "long_en", "D", None),
    (2, "source in ('src0', 'src1')", "early_source", "D", None),
    (3, "text rlike '@'", "has_at", "D", None),
]

ARTICLE_PATTERN = r"(le|la|the|el|der)\W+\w+"

PART_RULES = [
    (1, "p_name rlike 'red'", "R's", "A", "apostrophe in the label"),
    (2, "p_name rlike 'bolt|ring'", "M", "A", None),
    (3, "p_size <= 10", "S", "A", None),
    (4, "p_type = 'PROMO'", "P", "B", "other group"),
]

NAME_PATTERN = r"(red|blue|small)*\W*(widget|gizmo)"



def _part_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PART_RULES, RULE_SCHEMA)


def _brand_rules(part: DataFrame) -> DataFrame:
    """One rule per brand found in ``part``: brands 1 to 12 in group A."""
    num = F.regexp_extract("p_brand", r"#(\d+)", 1).cast("int")
    return (
        part.groupBy("p_brand")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            num.alias("num"),
            F.concat(F.lit("p_brand = '"), F.col("p_brand"), F.lit("'")).alias("reg_exp"),
            F.lower(F.regexp_replace("p_brand", "#", "_")).alias("brand"),
            F.when(num <= 12, F.lit("A")).otherwise(F.lit("B")).alias("mcc_supercat"),
            F.when(num >= 20, F.lit("")).otherwise(F.concat(F.lit("parts "), F.col("n").cast("string"))).alias(
                "comment"
            ),
        )
    )


BRAND_RULES_SQL = """
SELECT CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS INTEGER) AS num,
       'p_brand = ''' || p_brand || '''' AS reg_exp,
       lower(replace(p_brand, '#', '_')) AS brand,
       CASE WHEN CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS INTEGER) <= 12 THEN 'A' ELSE 'B' END AS mcc_supercat,
       CASE WHEN CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS INTEGER) >= 20 THEN NULL
            ELSE 'parts ' || CAST(count(*) AS VARCHAR) END AS comment
FROM part GROUP BY p_brand
"""


def _written_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "rules")
    write_unpartitioned(_brand_rules(_t(spark, sf_dir, "part")), path, sep=",")
    return read_rules(spark, path)


def _classified_tree(spark: SparkSession, sf_dir: str) -> str:
    path = _scratch(spark, "classified")
    write_partitioned(classify(_t(spark, sf_dir, "part"), PART_SPEC), path, ["brands_part"])
    return path


def _marginals_sql(source: str, keys: list[str]) -> str:
    """Oracle for count_statistics over the rows of ``source``."""
    k = ", ".join(keys)
    margs = ", ".join(f"CAST(sum(n) OVER (PARTITION BY {c}) AS BIGINT) AS {c}_count" for c in keys)
    return f"SELECT {k}, {margs} FROM (SELECT {k}, count(*) AS n FROM ({source}) GROUP BY {k})"


# --- queries ------------------------------------------------------------------------


def q_count_group_by(spark, sf_dir):
    return count_group_by(_t(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


def q_count_statistics(spark, sf_dir):
    return count_statistics(_t(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


def q_label_by_rules(spark, sf_dir):
    rules = filter_eq_or_null(_part_rules(spark), "mcc_supercat", "A")
    return count_group_by(label_by_rules(_t(spark, sf_dir, "part"), "brand", rules), "brand")


def q_label_by_rules_sql(spark, sf_dir):
    # The rule set applied through its SQL text, as a derived column.
    compiled = compile_rules(filter_eq_or_null(_part_rules(spark), "mcc_supercat", "A"))
    return count_group_by(with_expr_column(_t(spark, sf_dir, "part"), "brand", compiled.sql), "brand")


def q_classify(spark, sf_dir):
    return classify(_t(spark, sf_dir, "part"), PART_SPEC)


def q_classify_lineitem(spark, sf_dir):
    labelled = classify(_t(spark, sf_dir, "lineitem"), LINEITEM_SPEC)
    return count_statistics(labelled, "l_returnflag", "l_linestatus", "brands_part")


def q_classify_customer(spark, sf_dir):
    labelled = classify(_t(spark, sf_dir, "customer"), CUSTOMER_SPEC)
    return count_statistics(labelled, "c_mktsegment", "brands_part", "c_nationkey")


def q_label_events(spark, sf_dir):
    rules = spark.createDataFrame(EVENT_RULES, RULE_SCHEMA)
    return count_group_by(label_by_rules(_t(spark, sf_dir, "events"), "brand", rules), "event_type", "brand")


def q_filter_eq_or_null(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return filter_eq_or_null(docs.join(_t(spark, sf_dir, "labels"), "doc_id", "left"), "toxic")


def q_filter_eq_value(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return filter_eq_or_null(orders, "o_orderstatus", "F")


def q_filter_rlike_or_null(spark, sf_dir):
    return filter_rlike_or_null(_t(spark, sf_dir, "part"), "p_name", r"^(red|blue)\W")


def q_filter_none_rlike(spark, sf_dir):
    return filter_none_rlike(_t(spark, sf_dir, "part"), "p_name", ["red", "bolt"])


def q_filter_none_rlike_default(spark, sf_dir):
    # The twelve default super-category patterns, over whole texts.
    docs = _t(spark, sf_dir, "documents")
    return filter_none_rlike(docs, "text").select("doc_id", "lang", "source")


def q_normalised_prefix(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents")
    return docs.select("doc_id", normalised_prefix("text", 10).alias("prefix"))


def q_pattern_extract(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages")
    return pages.select(
        "page_id", pattern_extract("url", r"(m|www|m\W*www)*\W*example\W*(com|org)*").alias("test_reg_exp")
    )


def q_elide_middle(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        clip_left("text", 20).alias("head"),
        clip_right("text", 20).alias("tail"),
        elide_middle("text", 40).alias("elided"),
    )


def _part_lines(part: DataFrame, empty_last_over: int | None = None) -> DataFrame:
    size = F.col("p_size").cast("string")
    if empty_last_over is not None:
        size = F.when(F.col("p_size") > empty_last_over, F.lit("")).otherwise(size)
    return part.select(
        F.concat_ws("\t", F.col("p_partkey").cast("string"), "p_name", "p_brand", "p_type", size).alias("line"),
        "p_partkey",
    )


def q_split_lines(spark, sf_dir):
    lines = _part_lines(_t(spark, sf_dir, "part"), empty_last_over=25).select("line")
    return with_schema(split_lines(lines, "\t", PART_LINE_SCHEMA), PART_LINE_SCHEMA)


def q_drop_equal_rows(spark, sf_dir):
    pairs = _t(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority")
    return drop_equal_rows(pairs, first_row(pairs, "o_orderstatus", "o_orderpriority"))


def q_partition_roundtrip(spark, sf_dir):
    return read_partitioned(spark, _classified_tree(spark, sf_dir), PART_SCHEMA)


def q_unpartitioned_roundtrip(spark, sf_dir):
    path = _scratch(spark, "customer")
    write_unpartitioned(_t(spark, sf_dir, "customer"), path)
    return read_delimited(spark, path, CUSTOMER_SCHEMA)


def _write_lines(lines: DataFrame, path: str) -> None:
    # Raw lines under a header "line": no quoting, no trimming.
    write_unpartitioned(
        lines,
        path,
        sep="\u0001",
        quote="",
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
    )


def q_lines_roundtrip(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    path = _scratch(spark, "lines")
    _write_lines(
        part.select(F.concat_ws("\t", F.col("p_partkey").cast("string"), "p_name", "p_type").alias("line")), path
    )
    return read_lines(spark, path)


def q_read_rules(spark, sf_dir):
    return _written_rules(spark, sf_dir)


def q_rows_per_partition(spark, sf_dir):
    # Dealt out evenly over seven partitions: no partition is left empty, none is large.
    layout = rows_per_partition(_t(spark, sf_dir, "orders").select("o_orderkey").repartition(7))
    return layout.agg(
        F.count("*").alias("partitions"),
        F.sum("rows").cast("bigint").alias("rows"),
        (F.max("rows") < 2 * F.min("rows")).alias("even"),
    )


def q_row_counts(spark, sf_dir):
    # The same rows counted in flight by a write, and plainly.
    orders, seen = observe_rows(_t(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select("o_orderkey"))
    orders.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get["rows"], count_rows(orders))], "observed bigint, counted bigint")


def q_filter_rlike_null(spark, sf_dir):
    # Without a pattern the null rows stay; every fifth type is made null.
    part = _t(spark, sf_dir, "part").select("p_partkey", F.expr("if(p_partkey % 5 = 0, null, p_type)").alias("p_type"))
    return filter_rlike_or_null(part, "p_type", None)


def q_relabel(spark, sf_dir):
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("kind", T.StringType())])
    return relabel(_t(spark, sf_dir, "part").select("p_partkey", "p_type"), schema)


def q_peek(spark, sf_dir):
    # More rows than there are: all of them.
    return peek(_t(spark, sf_dir, "nation"), 1_000)


def q_normalised_prefix_trim(spark, sf_dir):
    part = _t(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("p_name"))
    return part.withColumn("prefix", normalised_prefix("p_name", 6))


def q_create_clusters(spark, sf_dir):
    lines = _part_lines(_t(spark, sf_dir, "part"))
    source = _scratch(spark, "part-lines")
    _write_lines(lines.select("line"), source)
    # The cluster job drops the first data row and its copies; pick it
    # explicitly (the lowest key) so the result does not depend on file order.
    drop = first_row(lines, "p_partkey")
    run = create_clusters(
        spark,
        source,
        _scratch(spark, "clusters"),
        spec=PART_SPEC,
        schema=PART_LINE_SCHEMA,
        drop_row=(drop["line"],),
        reuse=False,  # the query evaluates one report
    )
    return run.label_statistics


def q_stream_clusters(spark, sf_dir):
    # The cluster job as a stream over the same line files, run to completion.
    lines = _part_lines(_t(spark, sf_dir, "part"))
    source, target = _scratch(spark, "stream-lines"), _scratch(spark, "stream-clusters")
    _write_lines(lines.select("line"), source)
    drop = first_row(lines, "p_partkey")
    query = stream_clusters(
        spark,
        source,
        target,
        spec=PART_SPEC,
        schema=PART_LINE_SCHEMA,
        drop_row=(drop["line"],),
        checkpoint=_scratch(spark, "stream-checkpoint"),
    )
    query.awaitTermination()  # an available-now stream stops by itself, however long it takes
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    return read_partitioned(spark, target, PART_LINE_SCHEMA)


def q_check_result(spark, sf_dir):
    return check_result(
        spark, _classified_tree(spark, sf_dir), schema=PART_SCHEMA, keys=("p_type", "brands_part", "p_brand"), reuse=False
    ).statistics


def q_check_result_groups(spark, sf_dir):
    return check_result(
        spark, _classified_tree(spark, sf_dir), schema=PART_SCHEMA, keys=("p_type", "brands_part", "p_brand"), reuse=False
    ).groups


_BRAND_KEYS = ("p_type", "p_brand", "brand", "test_reg_exp", "merchant_clr")


def _brands(spark, sf_dir):
    return create_brands(
        _t(spark, sf_dir, "part"),
        _written_rules(spark, sf_dir),
        keys=_BRAND_KEYS,
        reuse=False,  # each query evaluates one report
        supercat="A",
        name_col="p_name",
        pattern=NAME_PATTERN,
        prefix_len=4,
    )


_DOCUMENT_KEYS = ("lang", "source", "brand", "test_reg_exp", "merchant_clr")


def q_create_brands_documents(spark, sf_dir):
    # The brand job over whole documents: rules, then prefix and pattern of
    # the normalised text.
    return create_brands(
        _t(spark, sf_dir, "documents"),
        spark.createDataFrame(DOCUMENT_RULES, RULE_SCHEMA),
        keys=_DOCUMENT_KEYS,
        reuse=False,
        supercat="D",
        name_col="text",
        pattern=ARTICLE_PATTERN,
        prefix_len=10,
    ).statistics


def q_create_brands(spark, sf_dir):
    return _brands(spark, sf_dir).statistics


def q_create_brands_groups(spark, sf_dir):
    return _brands(spark, sf_dir).groups


QUERIES: dict[str, Query] = {
    "count_group_by": q_count_group_by,
    "count_statistics": q_count_statistics,
    "label_by_rules": q_label_by_rules,
    "label_by_rules_sql": q_label_by_rules_sql,
    "classify": q_classify,
    "classify_lineitem": q_classify_lineitem,
    "classify_customer": q_classify_customer,
    "label_events": q_label_events,
    "filter_eq_or_null": q_filter_eq_or_null,
    "filter_eq_value": q_filter_eq_value,
    "filter_rlike_or_null": q_filter_rlike_or_null,
    "filter_none_rlike": q_filter_none_rlike,
    "filter_none_rlike_default": q_filter_none_rlike_default,
    "normalised_prefix": q_normalised_prefix,
    "pattern_extract": q_pattern_extract,
    "elide_middle": q_elide_middle,
    "split_lines": q_split_lines,
    "drop_equal_rows": q_drop_equal_rows,
    "partition_roundtrip": q_partition_roundtrip,
    "unpartitioned_roundtrip": q_unpartitioned_roundtrip,
    "lines_roundtrip": q_lines_roundtrip,
    "read_rules": q_read_rules,
    "rows_per_partition": q_rows_per_partition,
    "row_counts": q_row_counts,
    "filter_rlike_null": q_filter_rlike_null,
    "relabel": q_relabel,
    "peek": q_peek,
    "normalised_prefix_trim": q_normalised_prefix_trim,
    "create_clusters": q_create_clusters,
    "stream_clusters": q_stream_clusters,
    "check_result": q_check_result,
    "check_result_groups": q_check_result_groups,
    "create_brands": q_create_brands,
    "create_brands_groups": q_create_brands_groups,
    "create_brands_documents": q_create_brands_documents,
}

# --- oracle SQL (DuckDB) ----------------------------------------------------------

_PART_LINE_SPLIT = (
    "SELECT parts[1] AS p_partkey, parts[2] AS p_name, parts[3] AS p_brand, parts[4] AS p_type, parts[5] AS p_size "
    "FROM (SELECT string_split(rtrim(line, chr(9)), chr(9)) AS parts FROM ({lines})) WHERE len(parts) = 5"
)

_UNBRANDED = f"""
SELECT p_type, p_brand, CAST(NULL AS VARCHAR) AS brand,
       regexp_extract(trim(lower(p_name), ' '), '{NAME_PATTERN}', 0) AS test_reg_exp,
       substring(trim(lower(p_name), ' '), 1, 4) AS merchant_clr
FROM part
WHERE CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS INTEGER) > 12
"""

_BRAND_KEYS_SQL = ", ".join(_BRAND_KEYS)

_UNBRANDED_DOCUMENTS = f"""
SELECT lang, source, CAST(NULL AS VARCHAR) AS brand,
       regexp_extract(trim(lower(text), ' '), '{ARTICLE_PATTERN}', 0) AS test_reg_exp,
       substring(trim(lower(text), ' '), 1, 10) AS merchant_clr
FROM documents
WHERE NOT (lang = 'en' AND n_chars > 20000)
  AND NOT (source IN ('src0', 'src1'))
  AND NOT regexp_matches(text, '@')
"""

ORACLE: dict[str, str] = {
    "rows_per_partition": "SELECT CAST(7 AS BIGINT) AS partitions, count(*) AS rows, true AS even FROM orders",
    "row_counts": "SELECT count(*) AS observed, count(*) AS counted FROM orders WHERE o_orderstatus = 'F'",
    "filter_rlike_null": "SELECT p_partkey, CAST(NULL AS VARCHAR) AS p_type FROM part WHERE p_partkey % 5 = 0",
    "relabel": "SELECT p_partkey AS key, p_type AS kind FROM part",
    "peek": "SELECT * FROM nation",
    "normalised_prefix_trim": (
        "SELECT p_partkey, '  ' || p_name || ' ' AS p_name, substring(lower(p_name), 1, 6) AS prefix FROM part"
    ),
    "count_group_by": (
        "SELECT o_orderstatus, o_orderpriority, count(*) AS count FROM orders "
        "GROUP BY o_orderstatus, o_orderpriority ORDER BY count DESC"
    ),
    "count_statistics": _marginals_sql("SELECT * FROM orders", ["o_orderstatus", "o_orderpriority"]),
    "label_by_rules": (
        "SELECT brand, count(*) AS count FROM (SELECT CASE "
        "WHEN regexp_matches(p_name, 'red') THEN 'R`s' "
        "WHEN regexp_matches(p_name, 'bolt|ring') THEN 'M' "
        "WHEN p_size <= 10 THEN 'S' END AS brand FROM part) GROUP BY brand"
    ),
    "label_by_rules_sql": (
        "SELECT brand, count(*) AS count FROM (SELECT CASE "
        "WHEN regexp_matches(p_name, 'red') THEN 'R`s' "
        "WHEN regexp_matches(p_name, 'bolt|ring') THEN 'M' "
        "WHEN p_size <= 10 THEN 'S' END AS brand FROM part) GROUP BY brand"
    ),
    "classify": f"SELECT {PART_SPEC_SQL} AS brands_part, * FROM part",
    "classify_lineitem": _marginals_sql(
        f"SELECT l_returnflag, l_linestatus, {LINEITEM_SPEC_SQL} AS brands_part FROM lineitem",
        ["l_returnflag", "l_linestatus", "brands_part"],
    ),
    "classify_customer": _marginals_sql(
        f"SELECT c_mktsegment, {CUSTOMER_SPEC_SQL} AS brands_part, c_nationkey FROM customer",
        ["c_mktsegment", "brands_part", "c_nationkey"],
    ),
    "label_events": (
        "SELECT event_type, brand, count(*) AS count FROM (SELECT event_type, CASE "
        "WHEN event_type = 'purchase' AND value >= 100 THEN 'big_purchase' "
        "WHEN event_type = 'error' THEN 'error' "
        "WHEN regexp_matches(props, '\"k\": 9[0-9]') THEN 'k9x' END AS brand FROM events) "
        "GROUP BY event_type, brand"
    ),
    "filter_eq_or_null": (
        "SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic "
        "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.toxic IS NULL"
    ),
    "filter_eq_value": (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders "
        "WHERE o_orderstatus IS NOT DISTINCT FROM 'F'"
    ),
    "filter_rlike_or_null": "SELECT * FROM part WHERE regexp_matches(p_name, '^(red|blue)\\W')",
    "filter_none_rlike": (
        "SELECT * FROM part WHERE NOT regexp_matches(p_name, 'red') AND NOT regexp_matches(p_name, 'bolt')"
    ),
    "filter_none_rlike_default": (
        "SELECT doc_id, lang, source FROM documents WHERE "
        + " AND ".join(f"NOT regexp_matches(text, '{p}')" for p in SUPERCAT_PATTERNS)
    ),
    "normalised_prefix": "SELECT doc_id, substring(trim(lower(text), ' '), 1, 10) AS prefix FROM documents",
    "pattern_extract": (
        "SELECT page_id, regexp_extract(trim(lower(url), ' '), "
        "'(m|www|m\\W*www)*\\W*example\\W*(com|org)*', 0) AS test_reg_exp FROM pages"
    ),
    "elide_middle": (
        "SELECT doc_id, left(text, 20) AS head, right(text, 20) AS tail, "
        "CASE WHEN length(text) >= 40 THEN left(text, 20) || chr(10) || '...' || chr(10) || right(text, 20) "
        "ELSE text END AS elided FROM documents"
    ),
    "split_lines": _PART_LINE_SPLIT.format(
        lines="SELECT concat_ws(chr(9), CAST(p_partkey AS VARCHAR), p_name, p_brand, p_type, "
        "CASE WHEN p_size > 25 THEN '' ELSE CAST(p_size AS VARCHAR) END) AS line FROM part"
    ),
    "drop_equal_rows": (
        "WITH f AS (SELECT o_orderstatus, o_orderpriority FROM orders "
        "ORDER BY o_orderstatus, o_orderpriority LIMIT 1) "
        "SELECT o.o_orderstatus, o.o_orderpriority FROM orders o WHERE NOT EXISTS ("
        "SELECT 1 FROM f WHERE o.o_orderstatus IS NOT DISTINCT FROM f.o_orderstatus "
        "AND o.o_orderpriority IS NOT DISTINCT FROM f.o_orderpriority)"
    ),
    "partition_roundtrip": (
        f"SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, {PART_SPEC_SQL} AS brands_part FROM part"
    ),
    "unpartitioned_roundtrip": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "lines_roundtrip": "SELECT concat_ws(chr(9), CAST(p_partkey AS VARCHAR), p_name, p_type) AS line FROM part",
    "read_rules": BRAND_RULES_SQL,
    "create_clusters": _marginals_sql(
        f"SELECT p_type, {PART_SPEC_SQL} AS brands_part FROM part "
        "WHERE p_partkey <> (SELECT min(p_partkey) FROM part)",
        ["p_type", "brands_part"],
    ),
    "stream_clusters": (
        "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size, "
        f"{PART_SPEC_SQL} AS brands_part FROM part WHERE p_partkey <> (SELECT min(p_partkey) FROM part)"
    ),
    "check_result": _marginals_sql(
        f"SELECT p_type, {PART_SPEC_SQL} AS brands_part, p_brand FROM part", ["p_type", "brands_part", "p_brand"]
    ),
    "check_result_groups": (
        f"SELECT p_type, brands_part, p_brand, count(*) AS count FROM "
        f"(SELECT p_type, {PART_SPEC_SQL} AS brands_part, p_brand FROM part) "
        "GROUP BY p_type, brands_part, p_brand ORDER BY count DESC"
    ),
    "create_brands": _marginals_sql(_UNBRANDED, list(_BRAND_KEYS)),
    "create_brands_groups": (
        f"SELECT {_BRAND_KEYS_SQL}, count(*) AS count FROM ({_UNBRANDED}) GROUP BY {_BRAND_KEYS_SQL} ORDER BY count DESC"
    ),
    "create_brands_documents": _marginals_sql(_UNBRANDED_DOCUMENTS, list(_DOCUMENT_KEYS)),
}
