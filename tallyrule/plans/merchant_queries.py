"""The merchant tree and the brand job on merchant rows made from ``lineitem``, with DuckDB oracles.

Every line item becomes one merchant row: its keys choose a super-category,
one of the categories to try under it, a merchant name and a category name.
Nulls and values that no rule knows are among them, so every label occurs.
The oracle's CASE is written out by hand, not made from the spec.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrule.operators.classify import classify
from tallyrule.operators.filters import filter_none_rlike
from tallyrule.operators.stats import count_group_by
from tallyrule.plans.jobs import create_brands
from tallyrule.plans.merchant_spec import BRAND_SUPERCAT, MERCHANT_SPEC, SUPERCAT_PATTERNS
from tallyrule.plans.schemas import MERCHANT_FIELDS, RULE_SCHEMA

STRAY = "Прочее"

# --- fixed values: each super-category with the categories to try under it ---
CATEGORIES: list[tuple[str | None, list[str | None]]] = [
    ("Поездки, доставка, хранение", ["Авиакомпании", "Перевозки, доставка, хранение", "Автобусные перевозки"]),
    ("Супермаркеты и продуктовые магазины", ["Супермаркеты и продукты", "Разные продуктовые магазины", "Магазины алкоголя"]),
    ("Телефония и интернет", ["Связь - оплата мобильных телефонов", "Связь - продажа телефонов и оборудования",
                              "Связь - доступ в интернет"]),
    ("Всё остальное", ["Разные услуги", "Книги, канцтовары, фото", "Часы, мех, ювелирные изделия, искусство",
                       "Магазины цветов", "Парикмахерские и салоны красоты", "Всё для спорта", "Разные развлечения",
                       "Образовательные услуги", "Ломбарды и подержанные товары"]),
    ("Интернет-магазины", ["Интернет-покупки разных товаров"]),
    ("Всё для дома", ["Всё для дома", "Строительство и ремонт"]),
    ("Общепит", ["Общепит"]),
    ("Одежда, обувь и аксессуары", ["Одежда и аксессуары", "Обувь"]),
    ("Медицина и косметика", ["Аптеки"]),
    ("Личный транспорт", ["Продажа и обслуживание личного транспорта", "Автозаправки"]),
    ("Оплата счетов", ["Оплата счетов", "Коммунальные услуги"]),
    ("Дети и животные", ["Всё для детей", "Всё для домашних животных"]),
    (None, []),
    (STRAY, ["Аптеки"]),
]
MCC_NAMES = ["Авиакомпании – не имеющие своих кодов", "Фастфуд", "Магазины мужской и женской одежды",
             "Магазины женской одежды", "Магазины одежды для всей семьи", STRAY, None]
# --- end of fixed values ---------------------------------------------------------

NAMES = ["MEGAFON", "PAY MTS 7", "beeline", "BEELINE 24", "TELE2 KASSA", "pay mts", "SHOP 24", "WWW PayPal.RU",
         " md*www paypal ", "Ozon", None]
_BY_SUPERCAT = [[*cats, STRAY, None] for _, cats in CATEGORIES]

MERCHANT_RULES = [
    (1, "merchant_nm rlike '^SHOP'", "shop", BRAND_SUPERCAT, None),
    (2, "mcc_cat = 'Аптеки' and merchant_nm like 'PAY%'", "pay", BRAND_SUPERCAT, None),
    (3, "merchant_nm = 'Ozon'", "elsewhere", "Общепит", "another group's rule"),
]
BRAND_KEYS = ("mcc_supercat", "brands_part", "mcc_name", "mcc_code", "brand", "test_reg_exp", "merchant_clr")
DECIDING = ("mcc_supercat", "mcc_cat", "mcc_name", "merchant_nm")


def _texts(values):
    return F.array(*[F.lit(v).cast("string") for v in values])


def merchant_rows(lineitem: DataFrame) -> DataFrame:
    """One merchant row of 17 text fields for every line item."""
    cats = F.element_at(F.array(*[_texts(c) for c in _BY_SUPERCAT]), (F.col("l_partkey") % len(CATEGORIES) + 1).cast("int"))

    def pick(values, n):
        return F.element_at(_texts(values), (n % len(values) + 1).cast("int"))

    made = {
        "merchant_nm": pick(NAMES, F.col("l_suppkey") + F.col("l_linenumber")),
        "mcc_supercat": pick([s for s, _ in CATEGORIES], F.col("l_partkey")),
        "mcc_cat": F.element_at(cats, (F.col("l_orderkey") % F.size(cats) + 1).cast("int")),
        "mcc_code": (F.col("l_partkey") % len(CATEGORIES) + 5000).cast("string"),
        "mcc_name": pick(MCC_NAMES, F.col("l_linenumber") + F.col("l_suppkey") * 3),
    }
    return lineitem.select(
        *[made.get(f, F.concat(F.lit(f), (F.col("l_suppkey") % 7).cast("string"))).alias(f) for f in MERCHANT_FIELDS]
    )


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(merchant_rows(spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")), MERCHANT_SPEC)


def q_classify_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_group_by(_labelled(spark, sf_dir), *DECIDING, "brands_part")


def _brands(spark: SparkSession, sf_dir: str):
    return create_brands(_labelled(spark, sf_dir), spark.createDataFrame(MERCHANT_RULES, RULE_SCHEMA), reuse=False)


def q_create_brands_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _brands(spark, sf_dir).statistics


def q_create_brands_merchants_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _brands(spark, sf_dir).groups


def q_filter_none_rlike_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The twelve default patterns on categories of which some hold one.
    return count_group_by(filter_none_rlike(_labelled(spark, sf_dir), "mcc_cat"), "mcc_supercat", "mcc_cat")


def _list_sql(values) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


_CATS_SQL = f"([{', '.join(_list_sql(c) for c in _BY_SUPERCAT)}])[1 + l_partkey % {len(CATEGORIES)}]"
_ROWS_SQL = f"""SELECT
    ({_list_sql(NAMES)})[1 + (l_suppkey + l_linenumber) % {len(NAMES)}] AS merchant_nm,
    ({_list_sql(s for s, _ in CATEGORIES)})[1 + l_partkey % {len(CATEGORIES)}] AS mcc_supercat,
    ({_CATS_SQL})[1 + l_orderkey % len({_CATS_SQL})] AS mcc_cat,
    CAST(5000 + l_partkey % {len(CATEGORIES)} AS VARCHAR) AS mcc_code,
    ({_list_sql(MCC_NAMES)})[1 + (l_linenumber + l_suppkey * 3) % {len(MCC_NAMES)}] AS mcc_name
  FROM lineitem"""

_LABEL_SQL = """CASE
  WHEN mcc_supercat = 'Поездки, доставка, хранение' THEN CASE
    WHEN mcc_cat = 'Авиакомпании' AND mcc_name = 'Авиакомпании – не имеющие своих кодов' THEN 'travel_1'
    WHEN mcc_cat = 'Авиакомпании' THEN 'travel_2'
    WHEN mcc_cat IN ('Перевозки, доставка, хранение', 'Автобусные перевозки') THEN 'travel_3'
    ELSE 'travel_4' END
  WHEN mcc_supercat = 'Супермаркеты и продуктовые магазины' THEN CASE mcc_cat
    WHEN 'Супермаркеты и продукты' THEN 'super_market_1'
    WHEN 'Разные продуктовые магазины' THEN 'super_market_2'
    WHEN 'Магазины алкоголя' THEN 'super_market_3'
    ELSE 'super_market_4' END
  WHEN mcc_supercat = 'Телефония и интернет' THEN CASE
    WHEN mcc_cat = 'Связь - оплата мобильных телефонов' AND (contains(merchant_nm, 'MEGAFON')
      OR contains(merchant_nm, 'MTS') OR contains(merchant_nm, 'BEELINE') OR contains(merchant_nm, 'TELE2'))
      THEN 'phone_internet_1'
    WHEN mcc_cat = 'Связь - оплата мобильных телефонов' THEN 'phone_internet_2'
    WHEN mcc_cat IN ('Связь - продажа телефонов и оборудования', 'Связь - доступ в интернет') THEN 'phone_internet_3'
    ELSE 'phone_internet_4' END
  WHEN mcc_supercat = 'Всё остальное' THEN CASE
    WHEN mcc_cat = 'Разные услуги' THEN 'other_1'
    WHEN mcc_cat IN ('Книги, канцтовары, фото', 'Часы, мех, ювелирные изделия, искусство', 'Магазины цветов')
      THEN 'other_2'
    WHEN mcc_cat IN ('Парикмахерские и салоны красоты', 'Всё для спорта', 'Разные развлечения',
      'Образовательные услуги', 'Ломбарды и подержанные товары') THEN 'other_3'
    ELSE 'other_4' END
  WHEN mcc_supercat = 'Интернет-магазины' THEN
    CASE mcc_cat WHEN 'Интернет-покупки разных товаров' THEN 'internet_market_1' ELSE 'internet_market_2' END
  WHEN mcc_supercat = 'Всё для дома' THEN
    CASE mcc_cat WHEN 'Всё для дома' THEN 'home_1' WHEN 'Строительство и ремонт' THEN 'home_2' ELSE 'home_3' END
  WHEN mcc_supercat = 'Общепит' THEN CASE
    WHEN mcc_cat = 'Общепит' AND mcc_name = 'Фастфуд' THEN 'burger_1'
    WHEN mcc_cat = 'Общепит' THEN 'burger_2'
    ELSE 'burger_3' END
  WHEN mcc_supercat = 'Одежда, обувь и аксессуары' THEN CASE
    WHEN mcc_cat IN ('Одежда и аксессуары', 'Обувь') AND mcc_name IN ('Магазины мужской и женской одежды',
      'Магазины женской одежды', 'Магазины одежды для всей семьи') THEN 'clothes_1'
    WHEN mcc_cat IN ('Одежда и аксессуары', 'Обувь') THEN 'clothes_2'
    ELSE 'clothes_3' END
  WHEN mcc_supercat = 'Медицина и косметика' THEN CASE mcc_cat WHEN 'Аптеки' THEN 'medicine_1' ELSE 'medicine_2' END
  WHEN mcc_supercat = 'Личный транспорт' THEN CASE mcc_cat
    WHEN 'Продажа и обслуживание личного транспорта' THEN 'car_1' WHEN 'Автозаправки' THEN 'car_2' ELSE 'car_3' END
  WHEN mcc_supercat = 'Оплата счетов' THEN
    CASE WHEN mcc_cat IN ('Оплата счетов', 'Коммунальные услуги') THEN 'bill_1' ELSE 'bill_2' END
  WHEN mcc_supercat = 'Дети и животные' THEN
    CASE WHEN mcc_cat IN ('Всё для детей', 'Всё для домашних животных') THEN 'children_animal_1'
         ELSE 'children_animal_2' END
  WHEN mcc_supercat IS NULL THEN CASE WHEN mcc_cat IS NULL THEN 'none_1' ELSE 'none_2' END
  ELSE '0' END"""

_LABELLED_SQL = f"SELECT *, {_LABEL_SQL} AS brands_part FROM ({_ROWS_SQL})"
_UNBRANDED_SQL = f"""SELECT *, CAST(NULL AS VARCHAR) AS brand,
    substring(trim(lower(merchant_nm)), 1, 10) AS merchant_clr,
    regexp_extract(trim(lower(merchant_nm)), '(md|www|md\\W*www)*\\W*paypal\\W*(ru)*') AS test_reg_exp
  FROM ({_LABELLED_SQL})
  WHERE NOT coalesce(merchant_nm LIKE 'SHOP%', false)
    AND NOT coalesce(mcc_cat = 'Аптеки' AND merchant_nm LIKE 'PAY%', false)"""


def _counted_sql(source: str, keys) -> str:
    k = ", ".join(keys)
    return f"SELECT {k}, count(*) AS count FROM ({source}) GROUP BY {k}"


def _marginals_sql(source: str, keys) -> str:
    k = ", ".join(keys)
    sums = ", ".join(f"CAST(sum(count) OVER (PARTITION BY {c}) AS BIGINT) AS {c}_count" for c in keys)
    return f"SELECT {k}, {sums} FROM ({_counted_sql(source, keys)})"


QUERIES = {
    "classify_merchants": q_classify_merchants,
    "create_brands_merchants": q_create_brands_merchants,
    "create_brands_merchants_groups": q_create_brands_merchants_groups,
    "filter_none_rlike_merchants": q_filter_none_rlike_merchants,
}
ORACLE = {
    "classify_merchants": _counted_sql(_LABELLED_SQL, [*DECIDING, "brands_part"]),
    "create_brands_merchants": _marginals_sql(_UNBRANDED_SQL, BRAND_KEYS),
    "create_brands_merchants_groups": _counted_sql(_UNBRANDED_SQL, BRAND_KEYS),
    "filter_none_rlike_merchants": _counted_sql(
        f"SELECT * FROM ({_ROWS_SQL}) WHERE " + " AND ".join(f"NOT contains(mcc_cat, '{p}')" for p in SUPERCAT_PATTERNS),
        ("mcc_supercat", "mcc_cat"),
    ),
}
