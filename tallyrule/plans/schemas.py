"""Declared schemas of the merchant rows and of the rule table.

Both are fixed: every reader takes a schema, nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: field names and order of the merchant rows -------------
MERCHANT_FIELDS = (
    "merchant_nm",
    "merchant_id",
    "inn_mt",
    "terminal_id",
    "mcc_supercat",
    "mcc_cat",
    "mcc_code",
    "mcc_name",
    "merchant_city_nm",
    "province_stl",
    "province_mt",
    "area_mt",
    "locality_mt",
    "street_mt",
    "house_mt",
    "longitude_mt",
    "latitude_mt",
)
# --- end of fixed values ---------------------------------------------------

#: 17 nullable strings; longitude and latitude stay text.
MERCHANT_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n in MERCHANT_FIELDS])

#: ``num`` orders the rules, ``reg_exp`` is a SQL predicate, ``brand`` the label.
RULE_SCHEMA = T.StructType(
    [
        T.StructField("num", T.IntegerType(), True),
        T.StructField("reg_exp", T.StringType(), True),
        T.StructField("brand", T.StringType(), True),
        T.StructField("mcc_supercat", T.StringType(), True),
        T.StructField("comment", T.StringType(), True),
    ]
)

#: Name of the label column written by :func:`tallyrule.operators.classify.classify`.
LABEL_COL = "brands_part"


def with_label_field(schema: T.StructType, label: str = LABEL_COL) -> T.StructType:
    """Schema of a result tree read back with partition discovery.

    The label is declared as a string so a tree holding only ``"0"`` does not
    come back as an integer column.
    """
    return T.StructType(list(schema.fields) + [T.StructField(label, T.StringType(), True)])
