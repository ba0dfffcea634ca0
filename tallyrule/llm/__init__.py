"""Operators for preparing training text at scale, each a function on DataFrames.

Nothing outside this folder imports it. Every operator has its own module;
``queries`` registers one query per operator.
"""
