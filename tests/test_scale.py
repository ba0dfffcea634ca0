"""Rule tables, marginals, first rows, counted writes, scratch scopes, replaced trees and rejects."""

from __future__ import annotations

import os
import random
import re

import pytest
from conftest import local_path, write_text
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyrule.operators.rows import first_row, observe_outcomes, split_lines, split_outcomes
from tallyrule.operators.rules import RuleTableError, compile_rules, equality_of, label_by_rule_table, label_by_rules
from tallyrule.operators.stats import count_statistics
from tallyrule.plans.jobs import create_clusters
from tallyrule.plans.table_queries import PART_LINE_SCHEMA, PART_SPEC
from tallyrule.scratch import checkpoint_dir, exists, scratch_path, scratch_scope
from tallyrule.sources.delimited import read_delimited, read_delimited_outcomes, read_lines
from tallyrule.sources.sinks import write_partitioned

RULES = "num int, reg_exp string, brand string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- rules ------------------------------------------------------------------------------


def mixed_rules(r, n):
    for i in range(n):
        k, v = r.random(), r.randint(0, 900)
        e = f"b rlike '{i % 10}$' and n = {i % 13}"
        if k < 0.6:
            e = r.choice(["a = 'v{}'", "A == 'v{}'", " `a` <=> 'v{}' ", "b = 'v{}'"]).format(v)
        elif k < 0.8:
            e = f"a in ('v{v}', 'it', 'v{r.randint(0, 900)}')"
        elif k < 0.95:
            e = r.choice(["a like 'v{}%'", "b LIKE 'v{}%'"]).format(v)
        yield (r.choice([None, r.randint(1, 400)]), e, f"L'{i % 50}")


def first_match(rules, row):
    """The label of the first rule that holds, by number (null last), then text, then label."""

    def holds(e):
        c = row["b"] if re.match(r"\s*`?b`?\s", e) else row["a"]
        if "rlike" in e:
            end, n = re.findall(r"'(\d)\$'.*= (\d+)", e)[0]
            return row["b"] is not None and row["b"].endswith(end) and row["n"] == int(n)
        if " in (" in e:
            return c in re.findall(r"'([^']*)'", e)
        text = re.search(r"'([^']*)'", e)[1]
        return c is not None and (c.startswith(text[:-1]) if "like" in e.lower() else c == text)

    for num, e, b in sorted(rules, key=lambda x: (x[0] is None, x[0] or 0, x[1], x[2])):
        if holds(e):
            return b.replace("'", "`")
    return None


def test_rule_index_and_rule_table_equal_brute_force(spark):
    r = random.Random(11)
    rules = list(mixed_rules(r, 600))
    rows = [(i, r.choice([f"v{r.randint(0, 900)}", None, "it", "V1"]), r.choice([f"v{r.randint(0, 99)}", None]), r.randint(0, 20)) for i in range(400)]
    data = spark.createDataFrame(rows, "i int, a string, b string, n int").repartition(3)
    table = spark.createDataFrame(rules, RULES).repartition(5)
    want = {i: first_match(rules, {"a": a, "b": b, "n": n}) for i, a, b, n in rows}
    assert 100 < sum(v is not None for v in want.values()) < 400
    compiled = compile_rules(table, schema=data.schema)
    assert 400 < compiled.indexed < 600
    for labelled in (label_by_rules(data, "brand", compiled), label_by_rule_table(data, "brand", table)):
        assert labelled.columns == ["i", "a", "b", "n", "brand"]
        assert {x["i"]: x["brand"] for x in labelled.collect()} == want


def test_equality_forms(spark):
    schema = spark.createDataFrame([], "a string, `x y` string, n int, `A` string, b string").schema
    assert equality_of("b = 'v'", schema) == ("b", ["v"])
    assert equality_of("`X Y` in ('p','q r')", schema) == ("x y", ["p", "q r"])
    for other in ("a = 'v'", "n = '5'", "b = 'it''s'", "b = 'x\\\\y'", "b = 'v' or true", "b like 'v'", "upper(b) = 'V'", "b = c"):
        assert equality_of(other, schema) is None, other


def test_index_is_a_constant_of_the_plan(spark):
    data = spark.createDataFrame([("v3",), ("v1999",), (None,), ("x",)], "a string")
    rules = spark.createDataFrame([(i, f"a = 'v{i}'", f"L{i}") for i in range(2000)], RULES)
    compiled = compile_rules(rules, max_rules=2000, schema=data.schema)
    labelled = label_by_rules(data, "brand", compiled)
    assert compiled.indexed == 2000
    assert "from_json" not in plan_of(labelled) and "CASE WHEN" not in plan_of(labelled)
    assert [r["brand"] for r in labelled.collect()] == ["L3", "L1999", None, None]


def test_two_hundred_thousand_rules(spark):
    n = 200_000
    rules = spark.range(n).select(
        F.col("id").cast("int").alias("num"), F.expr("concat(\"a = 'v\", id, \"'\")").alias("reg_exp"), F.expr("concat('L', id)").alias("brand")
    )
    data = spark.range(0, 2 * n, 7).select("id", F.expr("concat('v', id)").alias("a"))
    labelled = label_by_rule_table(data, "brand", rules)
    wrong = labelled.filter(~F.col("brand").eqNullSafe(F.expr("if(id < 200000, concat('L', id), null)")))
    assert wrong.count() == 0 and labelled.count() == data.count()


def test_rule_table_of_odd_rules(spark):
    data = spark.createDataFrame([(1, "x"), (2, None)], "__rule_0 int, a string")
    none = spark.createDataFrame([], RULES)
    assert [r["brand"] for r in label_by_rule_table(data, "brand", none).collect()] == [None, None]
    bad = spark.createDataFrame([(7, "a = 'x'", None)], RULES)
    with pytest.raises(PySparkException, match="num 7"):
        label_by_rule_table(data, "brand", bad).collect()
    many = spark.createDataFrame([(i, f"length(a) = {i}", "l") for i in range(5)], RULES)
    with pytest.raises(RuleTableError, match="more than 4"):
        label_by_rule_table(data, "brand", many, max_rules=4)
    empty_prefix = spark.createDataFrame([(2, "a like '%'", "any"), (3, "a = 'x'", "x")], RULES)
    assert [r["brand"] for r in label_by_rule_table(data, "brand", empty_prefix).orderBy("__rule_0").collect()] == ["any", None]


# --- marginals --------------------------------------------------------------------------


def test_marginals_read_the_counts_twice(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).selectExpr("id % 3 as a", "id % 5 as b", "cast(null as string) as c", "id % 7 as d")
        few, many = (plan_of(count_statistics(df, *cols)) for cols in ("ab", "abcd"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the range is read by the base and by the one expansion, per join of it
    assert "Generate explode" in many and "BroadcastNestedLoopJoin" not in many and "Window" not in many
    exchanges = [p.count("Exchange hashpartitioning(__tally_k") for p in (few, many)]
    rows = {tuple(r) for r in count_statistics(df, "a", "b", "c", "d").collect()}
    assert len(rows) == 105 and all(r[6] == 1000 for r in rows)
    assert exchanges[1] - exchanges[0] <= 4


def test_marginals_of_a_literal_key_and_of_doubles(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), None), (float("nan"), "x"), (-0.0, None), (0.0, "y")], "a double, b string")
    got = sorted(repr(tuple(r)) for r in count_statistics(df.withColumn("z", F.lit(None).cast("string")), "a", "b", "z").collect())
    want = [(1.0, "x", None, 1, 2, 5), (float("nan"), None, None, 2, 2, 5), (float("nan"), "x", None, 2, 2, 5), (0.0, None, None, 2, 2, 5), (0.0, "y", None, 2, 1, 5)]
    assert got == sorted(map(repr, want))


# --- first row --------------------------------------------------------------------------


@pytest.mark.parametrize("sizes", [(3, 20_000), (20_000, 3)])
def test_first_row_is_that_of_the_first_path(spark, scratch, sizes):
    d = scratch("first")
    for name, n in zip("bc", sizes):
        write_text(d, f"{name}.txt", ["h", *(f"{name}{i}" for i in range(n))])
    write_text(d, "a.txt", ["h"])
    text = read_lines(spark, d)
    assert first_row(text)["h"] == "b0"
    assert first_row(text.filter("h like 'c%'"))["h"] == "c0"
    assert first_row(text.filter("h = 'none'")) is None
    assert first_row(text, F.col("h").desc())["h"].startswith("c")


# --- writes without adaptive execution, and in place of a tree ---------------------------------


def test_counted_write(spark, scratch):
    out = scratch("counted")
    rows = [("hot", 1)] * 4000 + [("hot", i) for i in range(2000)] + [("cold", i) for i in range(50)] + [(None, 1)] * 3
    df = spark.createDataFrame(rows, "lab string, v int").repartition(4)
    write_partitioned(df, out, ["lab"], adaptive=False, rows_per_file=500)
    files = lambda lab: [f for f in os.listdir(f"{local_path(out)}/lab={lab}") if f.startswith("part")]
    assert len(files("cold")) == 1 and len(files("hot")) > 1
    back = read_delimited(spark, out, df.select("v", "lab").schema, mode="PERMISSIVE")
    count = lambda d: {tuple(r): r["count"] for r in d.groupBy("lab", "v").count().collect()}
    assert {k[:2] for k in count(back)} == {k[:2] for k in count(df)} and back.count() == len(rows)
    # equal rows are spread over the files of their label
    each = spark.read.schema("v int").options(sep="\t", header="true").csv(f"{out}/lab=hot").filter("v = 1")
    assert each.select(F.input_file_name()).distinct().count() > 1


def test_failed_write_leaves_the_old_tree(spark, scratch):
    out = scratch("swap")
    df = spark.createDataFrame([("a", "1"), ("b", "2")], "lab string, v string")
    write_partitioned(df, out, ["lab"], format="parquet")
    with pytest.raises(PySparkException):
        write_partitioned(df.withColumn("v", F.raise_error(F.lit("stop")).cast("string")), out, ["lab"], format="parquet")
    assert spark.read.parquet(out).count() == 2
    write_partitioned(df.filter("lab = 'a'"), out, ["lab"], format="parquet")
    assert [r["v"] for r in spark.read.parquet(out).collect()] == ["1"]
    # a tree may be read while it is replaced
    write_partitioned(spark.read.parquet(out).withColumn("lab", F.lit("c")), out, ["lab"], format="parquet")
    assert [tuple(r) for r in spark.read.parquet(out).select("lab", "v").collect()] == [("c", "1")]
    beside = os.path.dirname(local_path(out))
    assert not [f for f in os.listdir(beside) if f.startswith(("_new-", "_old-"))]


# --- scratch ------------------------------------------------------------------------------


def test_scope_removes_what_it_owns(spark, scratch):
    out, lines = scratch("tree"), scratch("lines")
    write_text(lines, "a.txt", ["line", *(f"{i}\tred widget\tBrand#1\tPROMO\t{i % 50}" for i in range(30))])
    root = f"{local_path(checkpoint_dir(spark))}/tallyrule"
    os.makedirs(root, exist_ok=True)
    before = set(os.listdir(root))
    with scratch_scope(spark) as owned:
        run = create_clusters(spark, lines, out, spec=PART_SPEC, schema=PART_LINE_SCHEMA, reuse=False)
        assert run.rows_written == 29 and len(owned) == 1 and exists(spark, owned[0])
    assert {f for f in os.listdir(root) if f not in before and "tree" not in f} == set()
    assert run.written.count() == 29
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        spark.range(3).write.parquet(kept := scratch_path(spark, "failed"))
        1 / 0  # noqa: B018
    assert not exists(spark, kept)


# --- rejects --------------------------------------------------------------------------------


def test_outcomes_of_lines(spark):
    lines = ["a\tb\tc", "a\t\tc", "a\tb\t", "a\tb", "", "\t\t\t", "a\tb\tc\td", None, "a\tb\tc\t\t"]
    df = spark.createDataFrame([(x,) for x in lines], "line string").repartition(2)
    rows, seen = observe_outcomes(split_outcomes(df, "\t", ["x", "y", "z"]))
    got = {r["rejected"]: r["outcome"] for r in rows.collect() if r["outcome"] != "kept"}
    assert got == {"a\tb\t": "too_few", "a\tb": "too_few", "": "too_few", "\t\t\t": "too_few", "a\tb\tc\td": "too_many", None: "malformed"}
    assert seen.get == {"lines": 9, "kept": 3, "too_few": 4, "too_many": 1, "malformed": 1}
    kept = sorted(tuple(r)[:3] for r in rows.filter("outcome = 'kept'").collect())
    assert kept == sorted(tuple(r) for r in split_lines(df, "\t", ["x", "y", "z"]).collect())


def test_outcomes_of_delimited_files(spark, scratch):
    d = scratch("delim")
    write_text(d, "a.tsv", ["k\tv", "1\tx", "no\ty", "2", "", "3\tz\tmore", '4\t"q"', "\t"])
    schema = spark.createDataFrame([], "k int, v string").schema
    every = read_delimited_outcomes(spark, d, schema)
    kept = sorted((tuple(r)[:2] for r in every.filter("outcome = 'kept'").collect()), key=repr)
    assert kept == sorted((tuple(r) for r in read_delimited(spark, d, schema).collect()), key=repr)
    assert sorted(r["rejected"] for r in every.filter("outcome = 'malformed'").select("rejected").collect()) == ["2", "3\tz\tmore", "no\ty"]
    assert every.count() == 5  # blank lines, also those of blanks, are no rows
