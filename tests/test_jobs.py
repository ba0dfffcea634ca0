from __future__ import annotations

from collections import Counter

from conftest import write_text
from merchants import GOLDEN, merchant
from pyspark.sql import functions as F

from tallyrule.plans.jobs import check_result, create_brands, create_clusters, unbranded
from tallyrule.plans.merchant_spec import MERCHANT_SPEC
from tallyrule.plans.schemas import MERCHANT_FIELDS, MERCHANT_SCHEMA, RULE_SCHEMA


def as_line(row):
    return "\t".join("" if v is None else v for v in row)


def test_create_clusters_end_to_end(spark, scratch):
    src = scratch("src")
    # Rows with no null field survive the split; the first data row and its
    # copies are dropped like a second header.
    rows = [r for r, lab in GOLDEN if None not in r]
    first = merchant("Общепит", "Общепит", mcc_name="Фастфуд", name="FIRST")
    write_text(src, "a.tsv", ["HEADER", as_line(first), *map(as_line, rows), as_line(first), "short\tline"])
    run = create_clusters(spark, src, scratch("out"))
    assert tuple(run.header_row) == (as_line(first),)
    assert run.rows_written == len(rows)
    # header excluded; first row, its copy, every data row and the short line
    assert run.lines_read == len(rows) + 3
    labels = Counter(r["brands_part"] for r in run.written.collect())
    assert labels == Counter(lab for r, lab in GOLDEN if None not in r)
    stats = {(r[0], r[1]): r for r in run.label_statistics.collect()}
    assert sum(r["mcc_supercat_count"] for r in {k[0]: v for k, v in stats.items()}.values()) == len(rows)
    assert run.input_statistics.columns == ["mcc_supercat", "mcc_supercat_count"]
    per_supercat = {r[0]: r[1] for r in run.input_statistics.collect()}
    assert per_supercat == dict(Counter(r[4] for r in rows))


def test_check_result_reports(spark, scratch):
    src, out = scratch("src"), scratch("out")
    rows = [r for r, _ in GOLDEN if None not in r]
    write_text(src, "a.tsv", ["H", "drop\tme", *map(as_line, rows)])
    create_clusters(spark, src, out)
    rep = check_result(spark, out, reuse=True)
    assert rep.statistics.columns == ["mcc_supercat", "brands_part", "mcc_cat",
                                      "mcc_supercat_count", "brands_part_count", "mcc_cat_count"]
    assert sum(r["count"] for r in rep.groups.collect()) == len(rows)


def test_create_brands_reports_unbranded_rows(spark):
    data = spark.createDataFrame(
        [
            merchant("Интернет-магазины", "x", name="  WWW.PAYPAL.RU  "),
            merchant("Интернет-магазины", "x", name="OZON"),
            merchant("Интернет-магазины", "x", name="Fix Price 12"),
        ],
        MERCHANT_SCHEMA,
    ).withColumn("brands_part", F.lit("internet_market_2"))
    rules = spark.createDataFrame(
        [
            (1, "merchant_nm rlike 'OZON'", "ozon", "Интернет-магазины", None),
            (2, "merchant_nm rlike 'Fix'", "fix", "Другое", None),
        ],
        RULE_SCHEMA,
    )
    rows = unbranded(data, rules).collect()
    assert sorted((r["merchant_clr"], r["test_reg_exp"], r["brand"]) for r in rows) == [
        ("fix price ", "", None),
        ("www.paypal", "www.paypal.ru", None),
    ]
    rep = create_brands(data, rules, reuse=False)
    stats = rep.statistics.collect()
    assert rep.labelled.get["rows"] == 3
    assert len(stats) == 2 and all(r["brand_count"] == 2 for r in stats)
    assert rep.statistics.columns[:7] == ["mcc_supercat", "brands_part", "mcc_name", "mcc_code", "brand",
                                          "test_reg_exp", "merchant_clr"]
    assert sorted(r["count"] for r in rep.groups.collect()) == [1, 1]


def test_merchant_fields_cover_the_spec():
    used = {MERCHANT_SPEC.outer}
    for g in MERCHANT_SPEC.groups:
        stack = list(g.tree.rules)
        while stack:
            r = stack.pop()
            used.add(r.when.column)
            if hasattr(r.then, "rules"):
                stack.extend(r.then.rules)
    assert used <= set(MERCHANT_FIELDS)


def test_create_clusters_columnar_result(spark, scratch):
    src, out = scratch("src"), scratch("out")
    rows = [r for r, _ in GOLDEN if None not in r]
    write_text(src, "a.tsv", ["H", "drop\tme", *map(as_line, rows)])
    run = create_clusters(spark, src, out, format="parquet")
    assert run.rows_written == len(rows)
    assert Counter(r["brands_part"] for r in run.written.collect()) == Counter(
        lab for r, lab in GOLDEN if None not in r
    )
    assert "parquet" in run.written._jdf.queryExecution().executedPlan().toString().lower()


def test_sample_shaped_file_keeps_lines_three_to_five(spark, scratch):
    # Five tab lines, no header line of their own: the first is consumed as
    # the header and the second dropped as the first row.
    sample = [
        merchant("Всё для дома", "Всё для домw", mcc_name="Универсальные магазинw"),
        merchant("Личный транспорт", "Автозаправкw", mcc_name="Продажа топливw"),
        merchant("Супермаркеты и продуктовые магазины", "Супермаркеты и продуктw"),
        merchant("Интернет-магазины", "Интернет-покупки разных товаров"),
        merchant("Всё остальное", "Страхованиw"),
    ]
    src = scratch("sample")
    write_text(src, "sample.csv", [as_line(r) for r in sample])
    run = create_clusters(spark, src, scratch("out"))
    assert sorted(r["brands_part"] for r in run.written.collect()) == [
        "internet_market_1",
        "other_4",
        "super_market_4",
    ]


def test_sample_shaped_file_through_the_row_reader(spark, scratch):
    from tallyrule.operators.classify import classify
    from tallyrule.sources import read_delimited

    sample = [
        merchant("Всё для дома", "Всё для домw", house_mt="\\N"),
        merchant("Личный транспорт", "Автозаправкw", street_mt="\\N"),
        merchant("Супермаркеты и продуктовые магазины", "Супермаркеты и продуктw"),
        merchant("Интернет-магазины", "Интернет-покупки разных товаров"),
        merchant("Всё остальное", "Страхованиw"),
    ]
    src = scratch("sample")
    write_text(src, "sample.csv", [as_line(r) for r in sample])
    rows = classify(read_delimited(spark, src, MERCHANT_SCHEMA), MERCHANT_SPEC).collect()
    # The reader consumes line 1 as the header; "\N" stays text.
    assert [r["brands_part"] for r in rows] == ["car_3", "super_market_4", "internet_market_1", "other_4"]
    assert rows[0]["street_mt"] == "\\N"
