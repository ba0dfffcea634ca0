from __future__ import annotations

import glob
import os
from collections import Counter
from contextlib import contextmanager

import pytest
from conftest import local_path, write_text
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from tallyrule.operators.classify import Group, Spec, Tree, classify
from tallyrule.plans.schemas import LABEL_COL, MERCHANT_FIELDS, MERCHANT_SCHEMA, RULE_SCHEMA
from tallyrule.sources import (
    read_delimited,
    read_lines,
    read_partitioned,
    read_rules,
    write_partitioned,
    write_unpartitioned,
)

AB = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


def test_dropmalformed_is_consistent(spark, scratch):
    d = scratch("csv")
    write_text(d, "x.csv", ["a\tb", "1\t2", "3", "4\t5\t6", "7\t8"])
    df = read_delimited(spark, d, AB)
    assert df.count() == df.select("a").count() == len(df.collect()) == 2


def test_null_marker_stays_text(spark, scratch):
    d = scratch("csv")
    write_text(d, "x.csv", ["a\tb", "\\N\t"])
    rows = read_delimited(spark, d, AB).collect()
    assert rows[0]["a"] == "\\N" and rows[0]["b"] is None


def test_partitioned_roundtrip(spark, scratch):
    rows = [tuple(f"{f}{i}" if f != "mcc_cat" else ("" if i == 0 else "c") for f in MERCHANT_FIELDS) for i in range(30)]
    df = spark.createDataFrame(rows, MERCHANT_SCHEMA)
    spec = Spec("mcc_cat", (Group("c", "cat", Tree((), default=1)),))
    out = scratch("tree")
    write_partitioned(classify(df, spec), out, [LABEL_COL])
    back = read_partitioned(spark, out, MERCHANT_SCHEMA)
    assert back.columns == [*MERCHANT_FIELDS, LABEL_COL]
    # empties come back as null
    want = Counter(tuple(None if v == "" else v for v in r) + ("cat_1" if r[5] == "c" else "0",) for r in rows)
    assert Counter(map(tuple, back.collect())) == want
    assert sorted(os.path.basename(p) for p in glob.glob(local_path(out) + "/brands_part=*")) == [
        "brands_part=0",
        "brands_part=cat_1",
    ]


def test_tree_with_only_zero_keeps_string_label(spark, scratch):
    df = spark.createDataFrame([("x", "y")], "a string, b string")
    out = scratch("zero")
    write_partitioned(classify(df, Spec("a", ())), out, [LABEL_COL])
    back = read_partitioned(spark, out, AB)
    assert dict(back.dtypes)[LABEL_COL] == "string"
    assert back.first()[LABEL_COL] == "0"
    # Reading a leaf directory loses the label column: read the root.
    leaf = read_delimited(spark, out + "/brands_part=0", AB)
    assert LABEL_COL not in leaf.columns


@contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


VL = T.StructType([T.StructField("v", T.StringType()), T.StructField("lab", T.StringType())])


def hot_frame(spark):
    # One label holds 95% of the rows.
    return spark.range(0, 20000, numPartitions=4).selectExpr(
        "cast(id as string) as v", "if(id % 20 = 0, 'cold', 'hot') as lab"
    )


def test_hot_label_is_split_by_adaptive_rebalance(spark, scratch):
    out = scratch("hot")
    with conf(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}):
        write_partitioned(hot_frame(spark), out, ["lab"])
    assert len(glob.glob(local_path(out) + "/lab=hot/*.csv")) > 1
    assert len(glob.glob(local_path(out) + "/lab=cold/*.csv")) == 1
    assert read_delimited(spark, out, VL).count() == 20000


def test_salted_write_without_adaptive_execution(spark, scratch):
    out = scratch("salt")
    with conf(spark, **{"spark.sql.adaptive.enabled": "false"}):
        write_partitioned(hot_frame(spark), out, ["lab"], salt=4)
    # salted keys hash into the shuffle partitions; collisions may merge some
    assert len(glob.glob(local_path(out) + "/lab=hot/*.csv")) > 1
    back = read_delimited(spark, out, VL)
    assert back.count() == 20000 and back.select("v").distinct().count() == 20000


def test_partition_by_every_column_is_refused(spark, scratch):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(AnalysisException):
        write_partitioned(df, scratch("all"), ["a"])


def test_unpartitioned_small_frame_is_one_file(spark, scratch):
    out = scratch("one")
    write_unpartitioned(spark.range(50, numPartitions=5).selectExpr("cast(id as string) as a", "'b' as b"), out)
    assert len(glob.glob(local_path(out) + "/*.csv")) == 1
    assert read_delimited(spark, out, AB).count() == 50


def test_read_lines_semantics(spark, scratch):
    d = scratch("lines")
    write_text(d, "1.txt", ["head", "a\tb", "", "c$d", '"q', "a\tb"])
    write_text(d, "2.txt", ["other header", "e\tf"])
    df = read_lines(spark, d)
    assert df.columns == ["head"]
    got = Counter(r[0] for r in df.collect())
    # blank line gone, text after $ cut, leading quote opens a field, one header per file
    assert got == Counter({"a\tb": 2, "c": 1, "q": 1, "e\tf": 1})
    verbatim = read_lines(spark, d, sep="\u0001", quote="")
    assert Counter(r[0] for r in verbatim.collect())['"q'] == 1


def test_read_rules_blanks_and_no_cap(spark, scratch):
    d = scratch("rules")
    write_text(d, "r.csv", ["num,reg_exp,brand,mcc_supercat,comment"] + [f"{i},x = {i},b{i},,{'' if i % 2 else 'c'}" for i in range(5, 0, -1)] + ["6,y,b6, ,c"])
    df = read_rules(spark, d)
    assert df.schema == RULE_SCHEMA
    rows = df.collect()
    rows = sorted(rows, key=lambda r: r["num"])
    assert [r["num"] for r in rows] == [1, 2, 3, 4, 5, 6]
    assert [r["mcc_supercat"] for r in rows] == [None] * 5 + [" "]
    assert [r["comment"] for r in rows] == [None, "c", None, "c", None, "c"]
    many = scratch("many")
    write_text(many, "r.csv", ["num,reg_exp,brand,mcc_supercat,comment"] + [f"{i},x = {i},b{i},," for i in range(5000)])
    assert read_rules(spark, many).count() == 5000


def test_write_without_shuffle(spark, scratch):
    out = scratch("noshuffle")
    df = hot_frame(spark)
    write_partitioned(df, out, ["lab"], rebalance=False)
    assert read_delimited(spark, out, VL).count() == 20000


def test_rule_table_and_unpartitioned_write_in_parquet(spark, scratch):
    rules = spark.createDataFrame(
        [(2, "b = 1", "B", "", None), (1, "a = 1", "A", "x", "")], RULE_SCHEMA
    )
    path = scratch("rules-parquet")
    write_unpartitioned(rules, path, format="parquet")
    back = read_rules(spark, path, format="parquet").orderBy("num").collect()
    # empty text cells read as null in any format
    assert [(r["num"], r["mcc_supercat"], r["comment"]) for r in back] == [(1, "x", None), (2, None, None)]
