"""Label matchers (P27): ``=``, ``!=``, ``=~``, ``!~``.

A label that is absent (null) equals the empty string; regular expressions
are anchored at both ends.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Matcher = tuple[str, str, str]  # (label, op, value)


def matcher(label: str, op: str, value: str) -> Column:
    col = F.coalesce(F.col(label), F.lit(""))
    if op == "=":
        return col == F.lit(value)
    if op == "!=":
        return col != F.lit(value)
    if op == "=~":
        return col.rlike(f"^(?:{value})$")
    if op == "!~":
        return ~col.rlike(f"^(?:{value})$")
    raise ValueError(f"unknown matcher op {op!r}")


def match_labels(df: DataFrame, matchers: list[Matcher]) -> DataFrame:
    """Keep rows whose labels satisfy every matcher (a pushed-down filter)."""
    if not matchers:
        return df
    cond = reduce(lambda a, b: a & b, (matcher(*m) for m in matchers))
    return df.where(cond)


def organize(df: DataFrame, exclude: list[str], order: list[str] | None = None) -> DataFrame:
    """Drop helper columns of a table answer and put named ones first."""
    kept = [c for c in df.columns if c not in exclude]
    first = [c for c in (order or []) if c in kept]
    return df.select(*first, *[c for c in kept if c not in first])


def labels_to_columns(df: DataFrame, keys: list[str], labels: str = "labels") -> DataFrame:
    """Samples with a ``map<string,string>`` label column -> flat label columns.

    Only the named keys become columns (an absent key gives null, which the
    matchers treat as the empty string); the map column is dropped.
    """
    cols = [F.col(labels).getItem(k).alias(k) for k in keys]
    return df.select(*[c for c in df.columns if c != labels], *cols)
