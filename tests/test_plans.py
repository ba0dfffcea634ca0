"""Plan shapes the design relies on at scale."""

from __future__ import annotations

from tallyrule.operators.classify import classify
from tallyrule.operators.rules import label_by_rules
from tallyrule.operators.stats import count_statistics
from tallyrule.plans.schemas import RULE_SCHEMA
from tallyrule.plans.table_queries import PART_SPEC

PART = "/root/testdata/sf0.01/part.parquet"


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_statistics_read_the_input_once(spark):
    df = count_statistics(classify(spark.read.parquet(PART), PART_SPEC), "p_type", "brands_part", "p_brand")
    plan = final_plan(df)
    assert plan.count("FileScan parquet") == 1
    assert plan.count("ReusedExchange") == 3
    assert "Window" not in plan


def test_labelling_prunes_columns_and_keeps_codegen(spark):
    rules = spark.createDataFrame([(1, "p_size <= 10", "S", "A", None)], RULE_SCHEMA)
    df = label_by_rules(spark.read.parquet(PART), "brand", rules).select("p_partkey", "brand")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in plan
    assert "Exchange" not in plan
    assert "WholeStageCodegen" in plan or "*(" in plan


def test_filters_reach_the_parquet_scan(spark):
    from tallyrule.operators.filters import filter_eq_or_null

    df = filter_eq_or_null(spark.read.parquet(PART), "p_type", "PROMO").select("p_partkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [EqualNullSafe(p_type,PROMO)]" in plan


FORBIDDEN = (
    "CartesianProduct",  # all pairs
    "BroadcastNestedLoopJoin",  # all pairs
    "Window",  # one key's rows in one task
    "BatchEvalPython",  # row-at-a-time Python
    "ArrowEvalPython",
    "FlatMapGroupsInPandas",
    "MapInPandas",
)


def test_no_registered_query_uses_a_forbidden_operator(spark):
    from tallyrule.plans import merchant_queries, table_queries

    for name, q in {**table_queries.QUERIES, **merchant_queries.QUERIES}.items():
        df = q(spark, "/root/testdata/sf0.001")
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        found = [op for op in FORBIDDEN if op in plan]
        assert not found, (name, found)
        # Nothing funnels through one partition but the partial sums of a total,
        # and no query keeps only its first rows.
        if name != "rows_per_partition":
            assert "SinglePartition" not in plan, name
        assert "TakeOrdered" not in plan, name


def test_label_filter_prunes_result_directories(spark, scratch):
    from pyspark.sql import functions as F

    from tallyrule.plans.table_queries import PART_SCHEMA
    from tallyrule.sources import read_partitioned, write_partitioned

    out = scratch("tree")
    write_partitioned(classify(spark.read.parquet(PART), PART_SPEC), out, ["brands_part"])
    df = read_partitioned(spark, out, PART_SCHEMA).filter(F.col("brands_part") == "promo_1")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(brands_part" in plan and "(brands_part#" in plan
    assert df.count() == spark.read.parquet(PART).filter(
        "p_type = 'PROMO' and p_brand in ('Brand#1', 'Brand#2')"
    ).count()


def test_reused_reports_read_the_checkpoint_not_the_tree(spark, scratch):
    from tallyrule.plans.jobs import check_result
    from tallyrule.plans.table_queries import PART_SCHEMA
    from tallyrule.sources import write_partitioned

    out = scratch("tree")
    write_partitioned(classify(spark.read.parquet(PART), PART_SPEC), out, ["brands_part"])
    rep = check_result(spark, out, schema=PART_SCHEMA, keys=("p_type", "brands_part", "p_brand"), reuse=True)
    for df in (rep.statistics, rep.groups):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in plan, plan
        assert df.count() > 0


def test_cluster_job_reports_read_the_checkpoint(spark, scratch):
    from tallyrule.plans.jobs import create_clusters
    from tallyrule.plans.table_queries import PART_LINE_SCHEMA, _part_lines, _write_lines

    src = scratch("lines")
    _write_lines(_part_lines(spark.read.parquet(PART)).select("line"), src)
    run = create_clusters(spark, src, scratch("out"), spec=PART_SPEC, schema=PART_LINE_SCHEMA, drop_row=None)
    for df in (run.input_statistics, run.label_statistics):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in plan, plan
    assert sum(r[1] for r in run.input_statistics.collect()) == run.rows_written == 2000
