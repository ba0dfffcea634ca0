"""Column expressions."""

from tallyrule.functions.columns import (
    ELISION,
    clip_left,
    clip_right,
    elide_middle,
    find,
    make_label,
    normalise,
    normalised_prefix,
    pattern_extract,
    put_first,
    with_expr_column,
)

__all__ = [
    "ELISION",
    "clip_left",
    "clip_right",
    "elide_middle",
    "find",
    "make_label",
    "normalise",
    "normalised_prefix",
    "pattern_extract",
    "put_first",
    "with_expr_column",
]
