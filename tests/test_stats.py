from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyrule.operators.stats import (
    count_group_by,
    count_statistics,
    observe_rows,
    peek,
    rows_per_partition,
)

ROWS = [("a", "x"), ("a", "x"), ("a", "y"), ("b", "x"), (None, "y"), (None, None)]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "k string, v string")


def test_count_group_by(spark):
    out = count_group_by(frame(spark), "k", "v")
    assert out.columns == ["k", "v", "count"]
    got = [tuple(r) for r in out.collect()]
    assert got[0] == ("a", "x", 2)
    assert Counter({(k, v): n for k, v, n in got}) == Counter(ROWS)
    assert count_group_by(frame(spark)).collect()[0]["count"] == len(ROWS)


def test_count_statistics_marginals(spark):
    out = count_statistics(frame(spark), "k", "v")
    assert out.columns == ["k", "v", "k_count", "v_count"]
    got = [tuple(r) for r in out.collect()]
    kc = Counter(k for k, _ in ROWS)
    vc = Counter(v for _, v in ROWS)
    assert sorted(got, key=repr) == sorted({(k, v, kc[k], vc[v]) for k, v in ROWS}, key=repr)
    # ordered by the marginals, largest first
    assert [r[2:] for r in got] == sorted([r[2:] for r in got], reverse=True)


def test_column_named_count_and_empty_columns(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "count string")
    assert sorted(map(tuple, count_statistics(df, "count").collect())) == [("a", 2), ("b", 1)]
    with pytest.raises(ValueError):
        count_statistics(df)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["p", "q", None]), st.integers(0, 3)), min_size=1, max_size=40))
def test_marginal_properties(spark, rows):
    df = spark.createDataFrame(rows, "k string, n int")
    stats = count_statistics(df, "k", "n").collect()
    kc, nc = Counter(k for k, _ in rows), Counter(n for _, n in rows)
    want = sorted({(k, n, kc[k], nc[n]) for k, n in rows}, key=repr)
    assert sorted(map(tuple, stats), key=repr) == want
    # Each marginal, taken once per distinct value, sums to the row count.
    assert sum(dict((r["k"], r["k_count"]) for r in stats).values()) == len(rows)
    assert sum(dict((r["n"], r["n_count"]) for r in stats).values()) == len(rows)
    assert sum(r["count"] for r in count_group_by(df, "k", "n").collect()) == len(rows)


def test_row_metrics(spark):
    df = frame(spark).repartition(3)
    assert sum(r["rows"] for r in rows_per_partition(df).collect()) == len(ROWS)
    observed, obs = observe_rows(frame(spark))
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == len(ROWS)
    assert peek(frame(spark), 2).count() == 2


def test_hot_key_stays_out_of_single_window(spark):
    # One key holds most tuples; the plan must not use a window partitioned by it.
    df = spark.range(2000).selectExpr("'hot' as k", "cast(id as string) as v")
    plan = count_statistics(df, "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_marginals_without_broadcast_use_sort_merge_joins(spark):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    rows = [(k if k != "z" else None, str(i % 7)) for i, k in enumerate("aaaabbbcz" * 30)]
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = count_statistics(spark.createDataFrame(rows, "k string, v string"), "k", "v")
        got = sorted(map(tuple, df.collect()), key=repr)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    kc, vc = Counter(k for k, _ in rows), Counter(v for _, v in rows)
    assert got == sorted({(k, v, kc[k], vc[v]) for k, v in rows}, key=repr)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
