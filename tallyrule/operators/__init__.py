"""DataFrame → DataFrame operators."""

from tallyrule.operators.classify import Expr, Group, IsIn, IsNull, Matches, Rule, Spec, Tree, classify, label_column
from tallyrule.operators.filters import filter_eq_or_null, filter_none_rlike, filter_rlike_or_null, unlabelled
from tallyrule.operators.rows import (
    drop_equal_rows,
    first_row,
    observe_outcomes,
    relabel,
    split_lines,
    split_outcomes,
    with_schema,
)
from tallyrule.operators.rules import (
    MAX_RULES,
    CompiledRules,
    RuleTableError,
    compile_rules,
    label_by_rule_table,
    label_by_rules,
)
from tallyrule.operators.stats import (
    coarser_counts,
    count_group_by,
    count_rows,
    count_statistics,
    group_counts,
    groups_from_counts,
    observe_rows,
    peek,
    rows_per_partition,
    statistics_from_counts,
)

__all__ = [
    "Expr", "Group", "IsIn", "IsNull", "Matches", "Rule", "Spec", "Tree", "classify", "label_column",
    "filter_eq_or_null", "filter_none_rlike", "filter_rlike_or_null", "unlabelled",
    "drop_equal_rows", "first_row", "observe_outcomes", "relabel", "split_lines", "split_outcomes", "with_schema",
    "MAX_RULES", "CompiledRules", "RuleTableError", "compile_rules", "label_by_rule_table", "label_by_rules",
    "coarser_counts", "count_group_by", "count_rows", "count_statistics", "group_counts", "groups_from_counts",
    "observe_rows", "peek", "rows_per_partition", "statistics_from_counts",
]
