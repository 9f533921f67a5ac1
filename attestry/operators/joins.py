"""Joins that stay spread out when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame


def left_join_many(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left outer join whose right side may hold very many rows of one key.

    The run-time skew split can divide either side of an inner join, but only the
    left side of a left outer join. So the matches come from an inner join, and
    the unmatched left rows from an anti join against the distinct keys.
    """
    matched = left.join(right, key)
    rest = left.join(right.select(key).distinct(), key, "left_anti")
    return matched.unionByName(rest, allowMissingColumns=True)
