"""Hand-made merchant rows for the category tree (17 fields each)."""

from __future__ import annotations

from tallyrule.plans.schemas import MERCHANT_FIELDS


def merchant(supercat, cat, name="SHOP", mcc_name="Магазин", code="5999", **extra):
    row = {f: f"{f}-v" for f in MERCHANT_FIELDS}
    row.update(merchant_nm=name, mcc_supercat=supercat, mcc_cat=cat, mcc_name=mcc_name, mcc_code=code)
    row.update(extra)
    return tuple(row[f] for f in MERCHANT_FIELDS)


# (row, expected label): one per label of the tree, plus the fallback.
GOLDEN = [
    (merchant("Поездки, доставка, хранение", "Авиакомпании", mcc_name="Авиакомпании – не имеющие своих кодов"), "travel_1"),
    (merchant("Поездки, доставка, хранение", "Авиакомпании", mcc_name="Аэрофлот"), "travel_2"),
    (merchant("Поездки, доставка, хранение", "Автобусные перевозки"), "travel_3"),
    (merchant("Поездки, доставка, хранение", "Такси"), "travel_4"),
    (merchant("Супермаркеты и продуктовые магазины", "Супермаркеты и продукты"), "super_market_1"),
    (merchant("Супермаркеты и продуктовые магазины", "Разные продуктовые магазины"), "super_market_2"),
    (merchant("Супермаркеты и продуктовые магазины", "Магазины алкоголя"), "super_market_3"),
    (merchant("Супермаркеты и продуктовые магазины", "Супермаркеты и продуктw"), "super_market_4"),
    (merchant("Телефония и интернет", "Связь - оплата мобильных телефонов", name="PAY BEELINE 24"), "phone_internet_1"),
    (merchant("Телефония и интернет", "Связь - оплата мобильных телефонов", name="pay mts"), "phone_internet_2"),
    (merchant("Телефония и интернет", "Связь - доступ в интернет"), "phone_internet_3"),
    (merchant("Телефония и интернет", "Связь - прочее"), "phone_internet_4"),
    (merchant("Всё остальное", "Разные услуги"), "other_1"),
    (merchant("Всё остальное", "Магазины цветов"), "other_2"),
    (merchant("Всё остальное", "Образовательные услуги"), "other_3"),
    (merchant("Всё остальное", "Страхованиw"), "other_4"),
    (merchant("Интернет-магазины", "Интернет-покупки разных товаров"), "internet_market_1"),
    (merchant("Интернет-магазины", "Подписки"), "internet_market_2"),
    (merchant("Всё для дома", "Всё для дома"), "home_1"),
    (merchant("Всё для дома", "Строительство и ремонт"), "home_2"),
    (merchant("Всё для дома", "Всё для домw"), "home_3"),
    (merchant("Общепит", "Общепит", mcc_name="Фастфуд"), "burger_1"),
    (merchant("Общепит", "Общепит", mcc_name="Рестораны"), "burger_2"),
    (merchant("Общепит", "Кафе"), "burger_3"),
    (merchant("Одежда, обувь и аксессуары", "Обувь", mcc_name="Магазины женской одежды"), "clothes_1"),
    (merchant("Одежда, обувь и аксессуары", "Одежда и аксессуары", mcc_name="Ателье"), "clothes_2"),
    (merchant("Одежда, обувь и аксессуары", "Сумки"), "clothes_3"),
    (merchant("Медицина и косметика", "Аптеки"), "medicine_1"),
    (merchant("Медицина и косметика", "Клиники"), "medicine_2"),
    (merchant("Личный транспорт", "Продажа и обслуживание личного транспорта"), "car_1"),
    (merchant("Личный транспорт", "Автозаправки"), "car_2"),
    (merchant("Личный транспорт", "Автозаправкw"), "car_3"),
    (merchant("Оплата счетов", "Коммунальные услуги"), "bill_1"),
    (merchant("Оплата счетов", "Штрафы"), "bill_2"),
    (merchant("Дети и животные", "Всё для домашних животных"), "children_animal_1"),
    (merchant("Дети и животные", "Игрушки"), "children_animal_2"),
    (merchant(None, None), "none_1"),
    (merchant(None, "Без категории"), "none_2"),
    (merchant("Неизвестно", "Прочее"), "0"),
]
