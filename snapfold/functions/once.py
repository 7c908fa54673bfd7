"""Columns computed once per row, and rows spread over the cores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that the optimizer may not copy into the operators above.

    Catalyst pushes filters down by copying the expressions they use, so a filter on
    a gate would parse the document again for every rule.  A one-element ``inline``
    is a narrow step that such copies do not pass.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))


def apart(df: DataFrame, **columns: Column) -> DataFrame:
    """As :func:`once`, with the columns computed by a projection of their own.

    A projection computes what its columns share once, which a generator does not.
    One with a higher-order function in it is also compiled into methods of its own, not
    into the one of all steps around it, so many long steps may follow each other.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*kept, row.alias("_apart")).select(*kept, F.inline(F.array("_apart")))


#: Rows of a task whose work is heavy per row.
ROWS_IN_A_TASK = 20_000


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out over all cores, and over more tasks as they grow in number.

    For work that is heavy per row.  The scan's own partitions say little: small files hold
    many rows, and a file of one row group is one task however often it is split.
    """
    return dealt(df, tasks_for(df))


def dealt(df: DataFrame, tasks: int) -> DataFrame:
    """Rows dealt out by the hash of all they hold, which needs no sort as dealing in turn does."""
    return df.repartition(tasks, *[F.col(f"`{c}`") for c in df.columns])


def tasks_for(df: DataFrame) -> int:
    """How many tasks heavy work on these rows is dealt out over."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_IN_A_TASK))
