"""Ordered rule table → first-match label column.

A rule table has one SQL predicate and one label per row (schema
:data:`tallyrule.plans.schemas.RULE_SCHEMA`). The first rule, by ``num``,
whose predicate holds gives the label; when none holds the label is null.

Two forms of a predicate are known by their text, as long as the column they
name is a string column of the data: equality (``col = 'text'``,
``col in ('a', 'b')``) and prefix (``col like 'text%'``). They need not be tried
one by one:

* :func:`label_by_rules` compiles a rule set of at most ``max_rules`` (999 by
  default) into one projection. Its equality rules become a hash table in the
  plan, value to first rule, so a row looks its value up however many there
  are; the other rules are tried in order. No join, no shuffle. The size of the
  set is checked before it comes to the driver.
* :func:`label_by_rule_table` keeps equality and prefix rules a table of any
  size. The distinct values of the data and their prefixes are joined to it and
  the least rule wins in a partial aggregate. Only the other rules, at most
  ``max_rules``, come to the driver.
"""

from __future__ import annotations

import json
import re
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rule-set ceiling: one header row and 999 rules.
MAX_RULES = 999

#: Rules per CASE expression; longer rule sets become a coalesce of chunks.
CHUNK_SIZE = 16

_NAME = r"([A-Za-z_][A-Za-z_0-9]*|`[^`]+`)"
_TEXT = r"'([^'\\]*)'"
#: Java and Python read these alike; the quantifiers cannot run into each other.
EQUAL_FORM = rf"^\s*{_NAME}\s*(?:=|==|<=>)\s*{_TEXT}\s*$"
IN_FORM = rf"(?i)^\s*{_NAME}\s+in\s*\(\s*('[^'\\]*'(?:\s*,\s*'[^'\\]*')*)\s*\)\s*$"
PREFIX_FORM = rf"(?i)^\s*{_NAME}\s+like\s+'([^'\\%_]*)%'\s*$"


class RuleTableError(ValueError):
    """The rule table cannot be compiled."""


@dataclass(frozen=True)
class CompiledRules:
    """A rule set as a column (the form to apply) and as SQL text.

    The text is one ``case`` expression, as the rule set reads in SQL; applied
    through ``with_expr_column`` it gives the same labels, but past a few
    hundred rules it no longer compiles to code and runs interpreted.
    ``indexed`` counts the rules that a row looks up instead of trying them.
    """

    column: Column
    sql: str
    rules: tuple[tuple[int | None, str, str], ...]
    indexed: int = 0

    def __len__(self) -> int:
        return len(self.rules)

    def preview(self, n: int = 1000) -> str:
        """The SQL text cut to its first and last ``n // 2`` characters."""
        if not 0 <= n <= len(self.sql):
            return self.sql
        return self.sql[: n // 2] + "\n...\n" + self.sql[len(self.sql) - n // 2 :]


def _safe_label(brand: str) -> str:
    # Apostrophes become backticks, so the label also fits in SQL text.
    return brand.replace("'", "`")


def _in_sql(label: str) -> str:
    # A backslash in SQL text would escape what follows it.
    return label.replace("\\", "\\\\")


def _text_columns(schema: T.StructType | None) -> dict[str, str]:
    """String columns by lower-case name; names that differ in case only are left out."""
    names = [f.name.lower() for f in schema.fields] if schema else []
    return {
        f.name.lower(): f.name
        for f in (schema.fields if schema else [])
        if f.dataType == T.StringType() and names.count(f.name.lower()) == 1
    }


def equality_of(predicate: str, schema: T.StructType | None) -> tuple[str, list[str]] | None:
    """``(column, values)`` if the predicate is an equality on a string column of ``schema``, else ``None``."""
    columns = _text_columns(schema)
    if m := re.match(EQUAL_FORM, predicate):
        name, values = m[1], [m[2]]
    elif m := re.match(IN_FORM, predicate):
        name, values = m[1], re.findall(_TEXT, m[2])
    else:
        return None
    column = columns.get(name.strip("`").lower())
    return None if column is None else (column, values)


def _lookup(column: str, first: dict[str, int]) -> Column:
    """The number that ``first`` has for the column's value, or null.

    A hash table as a constant of the plan: an array of small maps, of which the
    CRC-32 of the value picks one.
    """
    size = 1 << max(0, (len(first) - 1).bit_length())
    buckets: list[dict[str, int]] = [{} for _ in range(size)]
    for value, number in first.items():
        buckets[zlib.crc32(value.encode()) % size][value] = number
    table = F.from_json(F.lit(json.dumps(buckets)), T.ArrayType(T.MapType(T.StringType(), T.IntegerType())))
    value = F.col(f"`{column}`")
    return F.get(table, (F.crc32(value.cast("binary")) % size).cast("int"))[value]


def _ordered_rules(
    rules: DataFrame, brand_col: str, expr_col: str, order_col: str | None, max_rules: int
) -> tuple[tuple[int | None, str, str], ...]:
    cols = [F.col(expr_col).alias("e"), F.col(brand_col).alias("b")]
    order = [F.col(expr_col).asc_nulls_last(), F.col(brand_col).asc_nulls_last()]
    if order_col is not None:
        cols.append(F.col(order_col).alias("n"))
        order.insert(0, F.col(order_col).asc_nulls_last())
    else:
        cols.append(F.lit(None).cast("int").alias("n"))
    rows = rules.orderBy(*order).select(*cols).limit(max_rules + 1).collect()
    if len(rows) > max_rules:
        raise RuleTableError(f"rule table has more than {max_rules} rules")
    bad = [r["n"] for r in rows if r["e"] is None or r["b"] is None]
    if bad:
        raise RuleTableError(f"rules with a null predicate or label: num {bad}")
    return tuple((r["n"], r["e"], _safe_label(r["b"])) for r in rows)


def compile_rules(
    rules: DataFrame,
    brand_col: str = "brand",
    expr_col: str = "reg_exp",
    order_col: str | None = "num",
    max_rules: int = MAX_RULES,
    chunk_size: int = CHUNK_SIZE,
    schema: T.StructType | None = None,
) -> CompiledRules:
    """Compile ``rules`` into a first-match column and its SQL text.

    Rules are ordered by ``order_col`` (nulls last), then by predicate text, so
    the result never depends on how the table is partitioned. A rule with a
    null predicate or null label is rejected, as is a table with more than
    ``max_rules`` rows. With the ``schema`` of the data, equality rules on its
    string columns are looked up by value; the labels are the same without it.
    """
    compiled = _ordered_rules(rules, brand_col, expr_col, order_col, max_rules)
    if not compiled:
        return CompiledRules(F.lit(None).cast("string"), "cast(null as string)", ())
    sql = "case " + "\n".join(f"when {e} then '{_in_sql(b)}'" for _, e, b in compiled) + " end"
    first: dict[str, dict[str, int]] = {}
    rest = []
    for at, (_, e, b) in enumerate(compiled):
        equality = equality_of(e, schema)
        if equality is None:
            rest.append((e, at, b))
            continue
        for value in equality[1]:
            first.setdefault(equality[0], {}).setdefault(value, at)
    if not first:
        # Labels are never null, so the first non-null chunk holds the first
        # matching rule: coalesce over ordered chunks equals one long CASE, but
        # each chunk compiles to its own method instead of one oversized one.
        return CompiledRules(_chunks([(e, b) for e, _, b in rest], chunk_size), sql, compiled)
    # Numbers of rules instead of labels: the least one names the label.
    found = [_lookup(c, values) for c, values in first.items()]
    if rest:
        found.append(_chunks([(e, at) for e, at, _ in rest], chunk_size))
    number = found[0] if len(found) == 1 else F.least(*found)
    labels = F.from_json(F.lit(json.dumps([b for _, _, b in compiled])), T.ArrayType(T.StringType()))
    return CompiledRules(F.get(labels, number), sql, compiled, len(compiled) - len(rest))


def _chunks(cases: list[tuple[str, str | int]], chunk_size: int) -> Column:
    chunks = [_case(cases[i : i + chunk_size]) for i in range(0, len(cases), chunk_size)]
    return chunks[0] if len(chunks) == 1 else F.coalesce(*chunks)


def _case(cases: list[tuple[str, str | int]]) -> Column:
    column = None
    for e, value in cases:
        column = F.when(F.expr(e), F.lit(value)) if column is None else column.when(F.expr(e), F.lit(value))
    return column


def label_by_rules(
    df: DataFrame,
    name: str,
    rules: DataFrame | CompiledRules,
    brand_col: str = "brand",
    expr_col: str = "reg_exp",
    max_rules: int = MAX_RULES,
) -> DataFrame:
    """Add or replace column ``name`` with the first matching rule's label."""
    if isinstance(rules, CompiledRules):
        compiled = rules
    else:
        compiled = compile_rules(rules, brand_col, expr_col, max_rules=max_rules, schema=df.schema)
    return df.withColumn(name, compiled.column)


# rule tables of any size


def _rank(num: Column, predicate: Column, label: Column) -> Column:
    """What orders rules: number (null last), predicate text, label."""
    return F.struct(
        num.isNull().alias("none"), num.cast("long").alias("num"), predicate.alias("predicate"), label.alias("label")
    )


def keyed_rules(rules: DataFrame, schema: T.StructType, brand_col: str, expr_col: str, order_col: str) -> DataFrame:
    """Every rule with the keys it can be found by: ``column, kind, key, rank``.

    ``kind`` is ``equal`` or ``prefix``; an ``in`` rule has one row a value. Rules
    of another form have one row with a null ``column``. A null predicate or
    label ends the query with an error that names the rule.
    """
    num, e, b = F.col(order_col), F.col(expr_col), F.col(brand_col)
    # Evaluated with the rank, so no rule passes by unchecked.
    missing = F.raise_error(
        F.concat(F.lit("rules with a null predicate or label: num "), F.coalesce(num.cast("string"), F.lit("null")))
    )
    label = F.when(e.isNull() | b.isNull(), missing.cast("string")).otherwise(F.translate(b, "'", "`"))
    columns = F.from_json(F.lit(json.dumps(_text_columns(schema))), T.MapType(T.StringType(), T.StringType()))

    def form(pattern: str, kind: str, keys: Column) -> Column:
        name = F.lower(F.translate(F.regexp_extract(e, pattern, 1), "`", ""))
        return F.when(
            e.rlike(pattern) & columns[name].isNotNull(),
            F.transform(keys, lambda k: F.struct(columns[name].alias("column"), F.lit(kind).alias("kind"), k.alias("key"))),
        )

    found = F.coalesce(
        form(EQUAL_FORM, "equal", F.array(F.regexp_extract(e, EQUAL_FORM, 2))),
        form(PREFIX_FORM, "prefix", F.array(F.regexp_extract(e, PREFIX_FORM, 2))),
        form(IN_FORM, "equal", F.regexp_extract_all(F.regexp_extract(e, IN_FORM, 2), F.lit(_TEXT), 1)),
        F.array(F.struct(*[F.lit(None).cast("string").alias(c) for c in ("column", "kind", "key")])),
    )
    return rules.select(F.explode(found).alias("k"), _rank(num, e, label).alias("rank")).select("k.*", "rank")


def _best_of_values(df: DataFrame, keyed: DataFrame, column: str) -> DataFrame:
    """``(value, rank)``: the least rule of each distinct value of a column that any rule fits."""
    rules = keyed.filter(F.col("column") == column).groupBy("kind", "key").agg(F.min("rank").alias("rank"))
    # One number for each length that a prefix has, not the prefixes.
    lengths = sorted(r[0] for r in rules.filter("kind = 'prefix'").select(F.length("key")).distinct().collect())
    values = df.select(F.col(f"`{column}`").alias("value")).filter("value is not null").distinct()
    keys = [F.struct(F.lit("equal").alias("kind"), F.col("value").alias("key"))]
    for n in lengths:
        prefix = F.struct(F.lit("prefix").alias("kind"), F.left("value", F.lit(n)).alias("key"))
        keys.append(F.when(F.length("value") >= n, prefix))
    tried = values.select("value", F.explode(F.array(*keys)).alias("k")).filter("k is not null").select("value", "k.*")
    return tried.join(rules, ["kind", "key"]).groupBy("value").agg(F.min("rank").alias("rank"))


def label_by_rule_table(
    df: DataFrame,
    name: str,
    rules: DataFrame,
    brand_col: str = "brand",
    expr_col: str = "reg_exp",
    order_col: str = "num",
    max_rules: int = MAX_RULES,
) -> DataFrame:
    """:func:`label_by_rules` for a rule table of any size: same labels.

    Equality and prefix rules stay a table. Each string column that they name
    is reduced to its distinct values (a value that most rows share is one row
    before anything is shuffled), values and their prefixes are joined to the
    rules, and the least rule of each value is joined back to the rows; one side
    of every join has one row a key, so adaptive execution can split the other.
    What reaches the driver: the names of those columns, the lengths of the
    prefixes and the rules of other forms, of which there may be ``max_rules``.
    """
    keyed = keyed_rules(rules, df.schema, brand_col, expr_col, order_col)
    found = keyed.select("column").distinct().collect()
    columns = sorted(r[0] for r in found if r[0] is not None)
    taken = {c.lower() for c in df.columns}
    fresh = [n for n in (f"__rule_{i}" for i in range(2 * len(columns) + len(taken) + 1)) if n not in taken]
    out, ranks = df, []
    for column, value, rank in zip(columns, fresh[::2], fresh[1::2]):
        best = _best_of_values(df, keyed, column).select(F.col("value").alias(value), F.col("rank").alias(rank))
        out = out.join(best, F.col(f"`{column}`") == F.col(value), "left").drop(value)
        ranks.append(rank)
    least = [F.col(r) for r in ranks]
    if len(columns) < len(found):
        other = keyed.filter(F.col("column").isNull()).orderBy("rank").limit(max_rules + 1).collect()
        if len(other) > max_rules:
            raise RuleTableError(f"rule table has more than {max_rules} rules that are no equality or prefix")
        ranks_of = [r["rank"].asDict() for r in other]
        table = F.from_json(F.lit(json.dumps(ranks_of)), T.ArrayType(keyed.schema["rank"].dataType))
        number = _chunks([(r["predicate"], at) for at, r in enumerate(ranks_of)], CHUNK_SIZE)
        least.append(F.get(table, number))
    if not least:
        return df.withColumn(name, F.lit(None).cast("string"))
    rank = least[0] if len(least) == 1 else F.least(*least)
    return out.withColumn(name, rank["label"]).drop(*ranks)
