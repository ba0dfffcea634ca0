"""Cases where a report, a writer or a label once went wrong."""

from __future__ import annotations

import pytest
from conftest import write_text
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrule.operators.classify import Group, Spec, Tree, classify
from tallyrule.operators.rows import cast_failures, with_schema
from tallyrule.operators.rules import compile_rules, label_by_rules
from tallyrule.operators.stats import count_group_by
from tallyrule.plans import merchant_queries
from tallyrule.plans.jobs import create_clusters
from tallyrule.plans.schemas import MERCHANT_SCHEMA, RULE_SCHEMA
from tallyrule.sources import read_rules, write_partitioned
from tallyrule.streaming import stream_clusters

N = len(MERCHANT_SCHEMA.fields)
AT = MERCHANT_SCHEMA.fieldNames().index("mcc_supercat")


def line(supercat: str) -> str:
    fields = ["x"] * N
    fields[AT] = supercat
    return "\t".join(fields)


def run(spark, scratch, lines, **options):
    src = scratch("src")
    write_text(src, "a.txt", ["header", *lines])
    out = options.pop("target", None) or scratch("out")
    return create_clusters(spark, src, out, drop_row=None, **options), out


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_reports_do_not_depend_on_the_format(spark, scratch):
    lines = [line(x) for x in ("A", " A", "A ", "", "A")]
    csv, _ = run(spark, scratch, lines)
    parquet, _ = run(spark, scratch, lines, format="parquet")
    assert rows(csv.input_statistics) == rows(parquet.input_statistics)
    assert rows(csv.label_statistics) == rows(parquet.label_statistics)
    assert dict(rows(csv.input_statistics)) == {"A": 2, " A": 1, "A ": 1, "": 1}
    assert csv.rows_written == parquet.rows_written == 5


def test_reports_and_tree_without_header_and_appended(spark, scratch):
    first, out = run(spark, scratch, [line("A"), line("B")], header="false")
    assert first.rows_written == first.written.count() == 2
    second, _ = run(spark, scratch, [line("A")], header="false", mode="append", target=out)
    assert second.rows_written == 1 and second.written.count() == 3
    assert dict(rows(second.input_statistics)) == {"A": 1}


def test_header_only_input_gives_empty_reports(spark, scratch):
    got, _ = run(spark, scratch, [])
    assert (got.rows_written, got.lines_read) == (0, 0)
    assert got.input_statistics.count() == got.label_statistics.count() == 0


def test_stream_continues_with_default_arguments(spark, scratch):
    src, out = scratch("in"), scratch("tree")
    for name, n in (("a.txt", 3), ("b.txt", 2)):
        write_text(src, name, ["header"] + [line("A")] * n)
        q = stream_clusters(spark, src, out)
        q.awaitTermination()
        assert q.exception() is None
    assert spark.read.option("header", "true").csv(out).count() == 5


def test_no_rule_is_lost_between_file_and_label(spark, scratch):
    d = scratch("rules")
    n = 1200
    write_text(d, "r.csv", ["num,reg_exp,brand,mcc_supercat,comment"] + [f"{i},x = {i},b{i},,c" for i in range(n)])
    rules = read_rules(spark, d)
    with pytest.raises(ValueError, match="999"):
        compile_rules(rules)
    got = label_by_rules(spark.range(n + 1).toDF("x"), "brand", rules, max_rules=2000).collect()
    assert {r["x"]: r["brand"] for r in got} == {i: f"b{i}" if i < n else None for i in range(n + 1)}


def test_equal_rows_spread_without_adaptive_execution(spark, scratch):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = scratch("hot")
        write_partitioned(spark.range(0, 40_000, 1, 8).select(F.lit("a").alias("lab"), F.lit("v").alias("v")), out, ["lab"])
        got = spark.read.option("header", "true").option("sep", "\t").csv(out)
        files = got.groupBy(F.input_file_name()).count().collect()
        assert len(files) > 4 and sum(r["count"] for r in files) == 40_000
        assert max(r["count"] for r in files) < 20_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_group_count_of_a_key_called_count(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",)], "count string")
    assert [tuple(r) for r in count_group_by(df, "count").collect()] == [("a", 2), ("b", 1)]


def test_both_forms_of_a_label_with_a_backslash_agree(spark):
    rules = spark.createDataFrame([(1, "x = 1", "a\\b'c", None, None)], RULE_SCHEMA)
    compiled = compile_rules(rules)
    got = spark.range(1, 2).toDF("x").select(compiled.column.alias("c"), F.expr(compiled.sql).alias("s")).first()
    assert got["c"] == got["s"] == "a\\b`c"


def test_tolerant_cast_counts_what_it_drops(spark):
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("t", T.StringType())])
    df = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c")], "a string, b string")
    assert [r["n"] for r in with_schema(df, schema, tolerant=True).collect()] == [1, None, None]
    assert tuple(cast_failures(df, schema).first()) == (1, 0)


def test_spec_columns_resolve_as_spark_does(spark):
    spec = Spec(outer="kind", groups=(Group(value="A", name="a", tree=Tree(rules=(), default=1)),))
    df = spark.createDataFrame([("A",), ("B",)], "KIND string")
    assert [r[0] for r in classify(df, spec).collect()] == ["a_1", "0"]


def test_merchant_rows_reach_every_label(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["brands_part"] for r in merchant_queries.q_classify_merchants(spark, sf).collect()}
    assert len(labels) == 39 and "0" in labels
    found = merchant_queries.q_create_brands_merchants_groups(spark, sf)
    assert {r[0] for r in found.select("test_reg_exp").distinct().collect()} >= {"", "www paypal.ru", "md*www paypal", None}
    kept = merchant_queries.q_filter_none_rlike_merchants(spark, sf)
    assert not kept.filter("mcc_cat = 'Общепит' or mcc_cat is null").count() and kept.filter("mcc_cat = 'Обувь'").count()
