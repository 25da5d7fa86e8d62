"""Dictionary lookup: a left join to a dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def lookup(fact: DataFrame, dim: DataFrame, on: str | list[str] | Column,
           how: str = "left") -> DataFrame:
    """``fact`` joined to ``dim``; a key missing from ``dim`` gives nulls.

    The planner, and AQE at run time, choose by bytes: a dimension below the
    broadcast threshold is broadcast and the fact is not shuffled; a larger one
    is met in a sort-merge join, whose skewed partitions AQE splits.
    """
    return fact.join(dim, on, how)
