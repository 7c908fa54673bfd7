"""Lookup joins of a large table against a keyed dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def lookup(facts: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``facts`` with a dimension that is unique on ``on``.

    Adaptive execution chooses the way: a dimension whose true size is within the broadcast limit is
    broadcast, and past it the tasks of a key that holds many facts are split, each part meeting the
    key's one row.  ``how`` may be anything that keeps fact rows: inner, left, left_semi, left_anti.
    """
    return facts.join(dim, list(on), how)
