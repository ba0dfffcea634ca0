"""Readers and writers."""

from tallyrule.sources.delimited import (
    read_delimited,
    read_delimited_outcomes,
    read_lines,
    read_partitioned,
    read_rules,
)
from tallyrule.sources.sinks import write_partitioned, write_unpartitioned

__all__ = [
    "read_delimited",
    "read_delimited_outcomes",
    "read_lines",
    "read_partitioned",
    "read_rules",
    "write_partitioned",
    "write_unpartitioned",
]
