"""Queries for rule tables of any size, rejected lines, first rows of files and replaced trees.

They read the driver's tables like :mod:`tallyrule.plans.table_queries` and
have DuckDB oracles too.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyrule.operators.classify import classify
from tallyrule.operators.rows import OUTCOMES, drop_equal_rows, first_row, observe_outcomes, split_outcomes
from tallyrule.operators.rules import label_by_rule_table
from tallyrule.operators.stats import count_statistics, peek
from tallyrule.plans.jobs import create_clusters
from tallyrule.plans.table_queries import (
    ORACLE as TABLE_ORACLE,
)
from tallyrule.plans.table_queries import (
    PART_LINE_SCHEMA,
    PART_SCHEMA,
    PART_SPEC,
    _part_lines,
    _scratch,
    _t,
    _write_lines,
)
from tallyrule.scratch import scratch_scope
from tallyrule.sources.delimited import read_delimited, read_delimited_outcomes, read_lines, read_partitioned
from tallyrule.sources.sinks import write_partitioned


def _customer_rules(spark, sf_dir):
    """Equality rules for customers in credit, prefix rules for tens of them, lists of two, one of another form."""
    c = _t(spark, sf_dir, "customer")
    key, quoted = F.col("c_custkey"), F.concat(F.lit("'"), "c_name", F.lit("'"))
    columns = lambda num, e, b: (num.cast("int").alias("num"), e.alias("reg_exp"), b.alias("brand"))
    equal = c.filter("c_acctbal > 0").select(
        *columns(4 * key + 1, F.concat(F.lit("name = "), quoted), F.lower("c_mktsegment"))
    )
    stem = F.expr("left(c_name, length(c_name) - 1)")
    prefix = c.filter("c_custkey % 10 = 3").select(
        *columns(4 * key, F.concat(F.lit("name like '"), stem, F.lit("%'")), F.concat(F.lit("nation "), "c_nationkey"))
    )
    status = F.concat(F.lit("name in ('', "), quoted, F.lit(")"))
    lists = c.filter("c_custkey % 7 = 0").select(*columns(4 * key + 2, status, F.lit("seventh")))
    large = c.select(*columns(F.lit(503), F.lit("o_totalprice > 400000"), F.lit("large"))).distinct()
    return equal.union(prefix).union(lists).union(large)


def q_label_by_rule_table(spark, sf_dir):
    # A rule or two for each customer: the table grows with the data and stays on the executors.
    name = F.format_string("Customer#%09d", F.col("o_custkey")).alias("name")
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", name, "o_totalprice")
    labelled = label_by_rule_table(orders, "brand", _customer_rules(spark, sf_dir))
    return labelled.select("o_orderkey", "brand")


def q_count_statistics_keys(spark, sf_dir):
    # Four keys, one of them mostly null: every marginal comes from one pass over the counts.
    lines = _t(spark, sf_dir, "lineitem").withColumn("l_large", F.expr("if(l_quantity > 48, l_quantity, null)"))
    return count_statistics(lines, "l_returnflag", "l_linestatus", "l_large", "l_suppkey")


def q_drop_first_line(spark, sf_dir):
    # Several files, each with a header: the first row is that of the first path.
    lines = _part_lines(_t(spark, sf_dir, "part")).repartitionByRange(3, "p_partkey").sortWithinPartitions("p_partkey")
    path = _scratch(spark, "ordered-lines")
    lines.select("line").write.options(header="true", quote="", sep="\u0001").csv(path)
    text = read_lines(spark, path)
    return drop_equal_rows(text, first_row(text))


def q_lines_special(spark, sf_dir):
    # Text after "$" is cut, a leading quote opens a field, blank lines vanish.
    key = F.col("p_partkey") % 4
    line = (
        F.when(key == 0, F.concat("p_name", F.lit("$"), "p_type"))
        .when(key == 1, F.concat(F.lit('"'), "p_name"))
        .when(key == 2, F.lit(""))
        .otherwise(F.col("p_name"))
    )
    path = _scratch(spark, "special-lines")
    raw = {"header": "true", "quote": "", "sep": "\u0001", "emptyValue": ""}  # as they are, blank lines too
    _t(spark, sf_dir, "part").select(line.alias("line")).write.options(**raw).csv(path)
    return read_lines(spark, path)


def _uneven_lines(spark, sf_dir):
    """Part lines, of which some end in an empty field or have one too many."""
    part = _t(spark, sf_dir, "part")
    lines = _part_lines(part, empty_last_over=25)
    more = F.when(F.col("p_partkey") % 7 == 0, F.concat("line", F.lit("\tmore"))).otherwise(F.col("line"))
    path = _scratch(spark, "uneven-lines")
    _write_lines(lines.select(more.alias("line")), path)
    return read_lines(spark, path, sep="\u0001", quote="")


def q_line_rejects(spark, sf_dir):
    # One pass writes rows and rejects and counts both; the count in flight equals the table.
    outcomes, seen = observe_outcomes(split_outcomes(_uneven_lines(spark, sf_dir), "\t", PART_LINE_SCHEMA))
    path = _scratch(spark, "outcomes")
    outcomes.write.partitionBy("outcome").parquet(path)
    counted = spark.createDataFrame([(o, seen.get[o], seen.get["lines"]) for o in OUTCOMES], "outcome string, counted long, lines long")
    stored = spark.read.parquet(path).groupBy("outcome").agg(F.count("*").alias("stored"), F.max("rejected").alias("last"))
    return counted.join(stored, "outcome", "left").na.fill(0, ["stored"])


def q_split_kept(spark, sf_dir):
    outcomes = split_outcomes(_uneven_lines(spark, sf_dir), "\t", PART_LINE_SCHEMA)
    return outcomes.filter("outcome = 'kept'").drop("outcome", "rejected")


def q_delimited_rejects(spark, sf_dir):
    # Keys that are no numbers make a line malformed; the other rows are those of the plain read.
    key = F.when(F.col("p_partkey") % 9 == 0, F.concat(F.lit("no"), "p_partkey")).otherwise(F.col("p_partkey").cast("string"))
    path = _scratch(spark, "delimited")
    part = _t(spark, sf_dir, "part").withColumn("p_partkey", key)
    part.write.options(header="true", sep="\t").csv(path)
    every = read_delimited_outcomes(spark, path, PART_SCHEMA)
    content = F.sum(F.xxhash64(*PART_SCHEMA.fieldNames()).cast("decimal(38,0)"))  # reads every column
    plain = read_delimited(spark, path, PART_SCHEMA).agg(F.count("*").alias("plain"), content.alias("h"))
    kept = every.filter("outcome = 'kept'").agg(F.count("*").alias("kept"), content.alias("hk"))
    counts = every.agg(F.count("*").alias("lines"), F.count("rejected").alias("rejected"))
    # one row each
    return counts.crossJoin(kept).crossJoin(plain).select(
        "lines", "rejected", "kept", (F.col("h") == F.col("hk")).alias("same_rows")
    )


def q_partition_roundtrip_counted(spark, sf_dir):
    # Dealt out by counted labels and content, as without adaptive execution.
    path = _scratch(spark, "counted")
    write_partitioned(
        classify(_t(spark, sf_dir, "part"), PART_SPEC), path, ["brands_part"], adaptive=False, rows_per_file=100
    )
    return read_partitioned(spark, path, PART_SCHEMA)


def q_recreate_clusters(spark, sf_dir):
    # The job twice over one target; its stages go with the scope, the tree stays.
    lines = _part_lines(_t(spark, sf_dir, "part"))
    target = _scratch(spark, "recreated")
    drop = first_row(lines, "p_partkey")
    with scratch_scope(spark):
        source = _scratch(spark, "part-lines")
        _write_lines(lines.select("line"), source)
        for _ in range(2):
            create_clusters(
                spark, source, target, spec=PART_SPEC, schema=PART_LINE_SCHEMA, drop_row=(drop["line"],), reuse=False
            )
    return read_partitioned(spark, target, PART_LINE_SCHEMA)


def q_peek_ordered(spark, sf_dir):
    return peek(_t(spark, sf_dir, "part").orderBy("p_name", "p_partkey"), 40)


QUERIES = {
    "label_by_rule_table": q_label_by_rule_table,
    "count_statistics_keys": q_count_statistics_keys,
    "drop_first_line": q_drop_first_line,
    "lines_special": q_lines_special,
    "line_rejects": q_line_rejects,
    "split_kept": q_split_kept,
    "delimited_rejects": q_delimited_rejects,
    "partition_roundtrip_counted": q_partition_roundtrip_counted,
    "recreate_clusters": q_recreate_clusters,
    "peek_ordered": q_peek_ordered,
}

_UNEVEN = """
SELECT p_partkey,
       concat_ws(chr(9), CAST(p_partkey AS VARCHAR), p_name, p_brand, p_type,
                 CASE WHEN p_size > 25 THEN '' ELSE CAST(p_size AS VARCHAR) END)
       || CASE WHEN p_partkey % 7 = 0 THEN chr(9) || 'more' ELSE '' END AS line,
       CASE WHEN p_partkey % 7 = 0 THEN 'too_many' WHEN p_size > 25 THEN 'too_few' ELSE 'kept' END AS outcome,
       CAST(p_partkey AS VARCHAR) AS k, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS s
FROM part
"""

_L_KEYS = ("l_returnflag", "l_linestatus", "l_large", "l_suppkey")

ORACLE = {
    "label_by_rule_table": """
WITH r AS (
  SELECT 4 * c_custkey + 1 AS num, c_name AS key, false AS prefix, lower(c_mktsegment) AS brand
  FROM customer WHERE c_acctbal > 0
  UNION ALL
  SELECT 4 * c_custkey, left(c_name, length(c_name) - 1), true, 'nation ' || c_nationkey
  FROM customer WHERE c_custkey % 10 = 3
  UNION ALL
  SELECT 4 * c_custkey + 2, c_name, false, 'seventh' FROM customer WHERE c_custkey % 7 = 0
), d AS (
  SELECT o_orderkey, 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS name, o_totalprice FROM orders
), m AS (
  SELECT o_orderkey, num, brand FROM d JOIN r ON NOT prefix AND name = key
  UNION ALL
  SELECT o_orderkey, num, brand FROM d JOIN r ON prefix AND left(name, length(name) - 1) = key
  UNION ALL
  SELECT o_orderkey, 503, 'large' FROM d WHERE o_totalprice > 400000
), b AS (
  SELECT o_orderkey, arg_min(brand, num) AS brand FROM m GROUP BY o_orderkey
)
SELECT d.o_orderkey, brand FROM d LEFT JOIN b USING (o_orderkey)
""",
    "count_statistics_keys": (
        f"SELECT {', '.join(_L_KEYS)}, "
        + ", ".join(f"CAST(sum(n) OVER (PARTITION BY {c}) AS BIGINT) AS {c}_count" for c in _L_KEYS)
        + f" FROM (SELECT {', '.join(_L_KEYS)}, count(*) AS n FROM (SELECT *, CASE WHEN l_quantity > 48 "
        "THEN l_quantity END AS l_large FROM lineitem) GROUP BY ALL)"
    ),
    "drop_first_line": (
        "SELECT concat_ws(chr(9), CAST(p_partkey AS VARCHAR), p_name, p_brand, p_type, CAST(p_size AS VARCHAR)) AS line "
        "FROM part WHERE p_partkey > (SELECT min(p_partkey) FROM part)"
    ),
    "lines_special": "SELECT p_name AS line FROM part WHERE p_partkey % 4 <> 2",
    "line_rejects": f"""
WITH u AS ({_UNEVEN}), c AS (
  SELECT outcome, count(*) AS n, max(CASE WHEN outcome <> 'kept' THEN rtrim(line, chr(9)) END) AS last,
         max(CASE WHEN outcome <> 'kept' THEN line END) AS whole FROM u GROUP BY outcome
)
SELECT o.outcome, coalesce(n, 0) AS counted, (SELECT count(*) FROM u) AS lines, coalesce(n, 0) AS stored, whole AS last
FROM (VALUES ('kept'), ('too_few'), ('too_many'), ('malformed')) o(outcome) LEFT JOIN c USING (outcome)
""",
    "split_kept": (
        "SELECT k AS p_partkey, p_name, p_brand, p_type, s AS p_size "
        f"FROM ({_UNEVEN.replace('p_partkey,', 'p_partkey AS pk,', 1)}) WHERE outcome = 'kept'"
    ),
    "delimited_rejects": (
        "SELECT count(*) AS lines, count(*) FILTER (WHERE p_partkey % 9 = 0) AS rejected, "
        "count(*) FILTER (WHERE p_partkey % 9 <> 0) AS kept, true AS same_rows FROM part"
    ),
    "partition_roundtrip_counted": TABLE_ORACLE["partition_roundtrip"],
    "recreate_clusters": TABLE_ORACLE["stream_clusters"],
    "peek_ordered": "SELECT * FROM part ORDER BY p_name, p_partkey LIMIT 40",
}
