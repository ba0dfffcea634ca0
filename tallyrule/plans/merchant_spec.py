"""The merchant category tree as data, for :func:`tallyrule.operators.classify.classify`.

Each group is tested by ``mcc_supercat <=> value`` in the order below; inside a
group the rules are tried in order and the group's default number is the
``otherwise``. A row that matches no group gets the fallback label ``"0"``.
"""

from __future__ import annotations

from tallyrule.operators.classify import Group, IsIn, IsNull, Matches, Rule, Spec, Tree

# --- fixed values: category names, labels and patterns of the merchant tree ---
# (decision order as evaluated; labels are "<name>_<number>")
MERCHANT_SPEC = Spec(
    outer="mcc_supercat",
    groups=(
        Group("Поездки, доставка, хранение", "travel", Tree(
            (
                Rule(IsIn("mcc_cat", ("Авиакомпании",)), Tree(
                    (Rule(IsIn("mcc_name", ("Авиакомпании – не имеющие своих кодов",)), 1),),
                    default=2,
                )),
                Rule(IsIn("mcc_cat", ("Перевозки, доставка, хранение", "Автобусные перевозки")), 3),
            ),
            default=4,
        )),
        Group("Супермаркеты и продуктовые магазины", "super_market", Tree(
            (
                Rule(IsIn("mcc_cat", ("Супермаркеты и продукты",)), 1),
                Rule(IsIn("mcc_cat", ("Разные продуктовые магазины",)), 2),
                Rule(IsIn("mcc_cat", ("Магазины алкоголя",)), 3),
            ),
            default=4,
        )),
        Group("Телефония и интернет", "phone_internet", Tree(
            (
                Rule(IsIn("mcc_cat", ("Связь - оплата мобильных телефонов",)), Tree(
                    (Rule(Matches("merchant_nm", ("MEGAFON", "MTS", "BEELINE", "TELE2")), 1),),
                    default=2,
                )),
                Rule(IsIn("mcc_cat", ("Связь - продажа телефонов и оборудования",
                                      "Связь - доступ в интернет")), 3),
            ),
            default=4,
        )),
        Group("Всё остальное", "other", Tree(
            (
                Rule(IsIn("mcc_cat", ("Разные услуги",)), 1),
                Rule(IsIn("mcc_cat", ("Книги, канцтовары, фото",
                                      "Часы, мех, ювелирные изделия, искусство",
                                      "Магазины цветов")), 2),
                Rule(IsIn("mcc_cat", ("Парикмахерские и салоны красоты",
                                      "Всё для спорта",
                                      "Разные развлечения",
                                      "Образовательные услуги",
                                      "Ломбарды и подержанные товары")), 3),
            ),
            default=4,
        )),
        Group("Интернет-магазины", "internet_market", Tree(
            (Rule(IsIn("mcc_cat", ("Интернет-покупки разных товаров",)), 1),),
            default=2,
        )),
        Group("Всё для дома", "home", Tree(
            (
                Rule(IsIn("mcc_cat", ("Всё для дома",)), 1),
                Rule(IsIn("mcc_cat", ("Строительство и ремонт",)), 2),
            ),
            default=3,
        )),
        Group("Общепит", "burger", Tree(
            (
                Rule(IsIn("mcc_cat", ("Общепит",)), Tree(
                    (Rule(IsIn("mcc_name", ("Фастфуд",)), 1),),
                    default=2,
                )),
            ),
            default=3,
        )),
        Group("Одежда, обувь и аксессуары", "clothes", Tree(
            (
                Rule(IsIn("mcc_cat", ("Одежда и аксессуары", "Обувь")), Tree(
                    (Rule(IsIn("mcc_name", ("Магазины мужской и женской одежды",
                                            "Магазины женской одежды",
                                            "Магазины одежды для всей семьи")), 1),),
                    default=2,
                )),
            ),
            default=3,
        )),
        Group("Медицина и косметика", "medicine", Tree(
            (Rule(IsIn("mcc_cat", ("Аптеки",)), 1),),
            default=2,
        )),
        Group("Личный транспорт", "car", Tree(
            (
                Rule(IsIn("mcc_cat", ("Продажа и обслуживание личного транспорта",)), 1),
                Rule(IsIn("mcc_cat", ("Автозаправки",)), 2),
            ),
            default=3,
        )),
        Group("Оплата счетов", "bill", Tree(
            (Rule(IsIn("mcc_cat", ("Оплата счетов", "Коммунальные услуги")), 1),),
            default=2,
        )),
        Group("Дети и животные", "children_animal", Tree(
            (Rule(IsIn("mcc_cat", ("Всё для детей", "Всё для домашних животных")), 1),),
            default=2,
        )),
        Group(None, "none", Tree(
            (Rule(IsNull("mcc_cat"), 1),),
            default=2,
        )),
    ),
    fallback="0",
)

#: Super-categories whose absence :func:`filter_none_rlike` checks by default.
SUPERCAT_PATTERNS = (
    "Поездки, доставка, хранение",
    "Супермаркеты и продуктовые магазины",
    "Телефония и интернет",
    "Всё остальное",
    "Интернет-магазины",
    "Всё для дома",
    "Общепит",
    "Одежда, обувь и аксессуары",
    "Медицина и косметика",
    "Личный транспорт",
    "Оплата счетов",
    "Дети и животные",
)

#: Super-category whose rules the brand job applies.
BRAND_SUPERCAT = "Интернет-магазины"

#: Site-name pattern the brand job extracts from the normalised merchant name.
BRAND_PATTERN = r"(md|www|md\W*www)*\W*paypal\W*(ru)*"

#: Length of the normalised merchant-name prefix in the brand job.
PREFIX_LEN = 10
# --- end of fixed values ---------------------------------------------------------
