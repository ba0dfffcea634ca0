"""Two-level decision spec → one label column (a single projection, no shuffle).

A :class:`Spec` names an outer column and an ordered list of :class:`Group`
entries. A row enters the first group whose value equals the outer column
null-safely (``None`` selects rows where it is null) and is then labelled by
the group's :class:`Tree`: ordered rules, each leading to a number or a nested
tree, and a default number. Labels are ``"<group name>_<number>"``; rows that
enter no group get ``Spec.fallback``.

The whole spec folds into one nested ``CASE`` expression, so Catalyst keeps it
in the scan's codegen stage and the classified frame keeps the partitioning of
its input. Grouping the output by label is left to the writer.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrule.functions.columns import find, make_label, put_first


@dataclass(frozen=True)
class IsIn:
    """``column IN values``; a null column never matches."""

    column: str
    values: tuple[str, ...]

    def to_column(self) -> Column:
        return F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class Matches:
    """Unanchored, case-sensitive regex; any of ``patterns`` matches."""

    column: str
    patterns: tuple[str, ...]

    def to_column(self) -> Column:
        return reduce(lambda a, b: a | b, (find(self.column, p) for p in self.patterns))


@dataclass(frozen=True)
class IsNull:
    column: str

    def to_column(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Expr:
    """Any SQL predicate over the row.

    Under ANSI mode, comparing a text field with a number casts the text to
    the number's type and fails on values like ``'31.0'`` against an integer;
    cast explicitly, e.g. ``cast(qty as double) > 25``.
    """

    sql: str

    def to_column(self) -> Column:
        return F.expr(self.sql)


Condition = Union[IsIn, Matches, IsNull, Expr]


@dataclass(frozen=True)
class Rule:
    when: Condition
    then: Union[int, "Tree"]


@dataclass(frozen=True)
class Tree:
    rules: tuple[Rule, ...]
    default: int


@dataclass(frozen=True)
class Group:
    value: str | None
    name: str
    tree: Tree


@dataclass(frozen=True)
class Spec:
    outer: str
    groups: tuple[Group, ...]
    fallback: str = "0"

    def columns(self) -> set[str]:
        """Columns the spec reads (``Expr`` conditions are not inspected)."""
        out = {self.outer}

        def walk(tree: Tree) -> None:
            for r in tree.rules:
                if not isinstance(r.when, Expr):
                    out.add(r.when.column)
                if isinstance(r.then, Tree):
                    walk(r.then)

        for g in self.groups:
            walk(g.tree)
        return out

    def labels(self) -> list[str]:
        """Every label the spec can produce, fallback last."""
        out: list[str] = []

        def walk(name: str, tree: Tree) -> None:
            for r in tree.rules:
                if isinstance(r.then, Tree):
                    walk(name, r.then)
                else:
                    out.append(f"{name}_{r.then}")
            out.append(f"{name}_{tree.default}")

        for g in self.groups:
            walk(g.name, g.tree)
        seen = list(dict.fromkeys(out))
        return seen + [self.fallback]


def _tree_column(name: str, tree: Tree) -> Column:
    if not tree.rules:
        return make_label(name, tree.default)
    expr = None
    for r in tree.rules:
        value = _tree_column(name, r.then) if isinstance(r.then, Tree) else make_label(name, r.then)
        expr = F.when(r.when.to_column(), value) if expr is None else expr.when(r.when.to_column(), value)
    return expr.otherwise(make_label(name, tree.default))


def label_column(spec: Spec) -> Column:
    """The spec as one string column."""
    outer = F.col(spec.outer)
    expr = None
    for g in spec.groups:
        test = outer.isNull() if g.value is None else outer.eqNullSafe(g.value)
        value = _tree_column(g.name, g.tree)
        expr = F.when(test, value) if expr is None else expr.when(test, value)
    # The fallback is a string literal: an integer here would make the whole
    # column numeric under ANSI coercion.
    fallback = F.lit(spec.fallback).cast("string")
    return fallback if expr is None else expr.otherwise(fallback)


def classify(df: DataFrame, spec: Spec, name: str = "brands_part") -> DataFrame:
    """Label every row by ``spec``; the label column comes first."""
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    same = str if exact else str.lower
    held = {same(c) for c in df.columns}
    missing = sorted(c for c in spec.columns() if same(c) not in held)
    if missing:
        raise ValueError(f"spec reads columns the frame lacks: {missing}")
    return put_first(df, name, label_column(spec))
