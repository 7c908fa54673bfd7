"""Integrity rules that Parquet does not enforce, as DataFrame checks.

:func:`enforce` runs all rules of a table over a batch: NOT NULL and CHECK row by row, UNIQUE inside the batch and
against stored rows, references against their parents.  A row that breaks any is refused with the names of all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.once import once
from ..schemas import Reference, Table
from .lookup import lookup


def with_defaults(df: DataFrame, table: Table) -> DataFrame:
    """Fill missing values, and missing columns, with the table's defaults."""
    for name, default in table.defaults.items():
        value = F.expr(default)
        if name in df.columns:
            value = F.coalesce(F.col(name), value)
        df = df.withColumn(name, value.cast(table.schema[name].dataType))
    return df


def conform(df: DataFrame, table: Table) -> DataFrame:
    """Select and cast to the table's columns; columns the rows lack become NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in table.schema
        ]
    )


def rule_violations(df: DataFrame, table: Table) -> DataFrame:
    """Add ``violations``: names of the NOT NULL and CHECK rules a row breaks."""
    required = dict.fromkeys((*table.key, *table.required))
    broken = [
        F.when(F.col(name).isNull(), F.lit(f"{name}_required")) for name in required if name in df.columns
    ]
    broken += [F.when(~F.expr(rule), F.lit(code)) for code, rule in table.checks.items()]
    return once(df, violations=F.array_compact(F.array(*broken)))


def split(df: DataFrame, table: Table) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the table's rules, and rows that break them."""
    checked = rule_violations(df, table)
    kept = checked.where(F.size("violations") == 0).drop("violations")
    return kept, checked.where(F.size("violations") > 0)


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def orphans(df: DataFrame, reference: Reference, parent: DataFrame) -> DataFrame:
    """Rows whose reference has no parent row; a NULL reference is allowed."""
    parent_keys = parent.select(
        *[F.col(p).alias(c) for p, c in zip(reference.parent_columns, reference.columns)]
    )
    known = df.dropna(subset=list(reference.columns))
    return lookup(known, parent_keys, reference.columns, "left_anti")


def unique_code(key: Sequence[str]) -> str:
    return f"{'_'.join(key)}_unique"


def reference_code(reference: Reference) -> str:
    return f"{'_'.join(reference.columns)}_reference"


def _is_known(columns: Sequence[str]) -> Column:
    known = F.lit(True)
    for name in columns:
        known = known & F.col(name).isNotNull()
    return known


def _shares(rows: DataFrame, table: Table, key: Sequence[str], flag: str) -> DataFrame:
    """Flag rows whose other key stands in the batch under a lower primary key as well; NULLs share nothing."""
    alone = F.when(~_is_known(key), F.xxhash64(*table.key))  # so that no task gathers the NULLs
    same = Window.partitionBy(*key, alone).orderBy(*table.key)
    return rows.withColumn(flag, _is_known(key) & (F.dense_rank().over(same) > 1))


def _meets(rows: DataFrame, table: Table, key: Sequence[str], stored: DataFrame, flag: str) -> DataFrame:
    """Flag rows whose other key is stored under another primary key.

    Both bounds of the batch's keys are pushed to the scan of the stored ones, and their clashes, not the
    stored rows, are joined to the batch.
    """
    bounds = rows.agg(*[f(c).alias(f"{n}_{c}") for c in key for n, f in (("lo", F.min), ("hi", F.max))]).first()
    if bounds[0] is None:
        return rows.withColumn(flag, F.lit(False))
    near = stored.select(*[F.col(c).alias(f"_stored_{c}") for c in dict.fromkeys((*key, *table.key))])
    for c in key:
        near = near.where(F.col(f"_stored_{c}").between(F.lit(bounds[f"lo_{c}"]), F.lit(bounds[f"hi_{c}"])))
    equal = [F.col(c) == F.col(f"_stored_{c}") for c in key]
    other = F.lit(False)
    for c in table.key:
        other = other | ~F.col(c).eqNullSafe(F.col(f"_stored_{c}"))
    clashes = rows.select(*dict.fromkeys((*key, *table.key))).join(near, [*equal, other], "left_semi")
    clashes = clashes.distinct().withColumn(flag, F.lit(True))
    same = list(dict.fromkeys((*key, *table.key)))
    return rows.join(clashes, same, "left").withColumn(flag, F.coalesce(flag, F.lit(False))).select(*rows.columns, flag)


def _has_no_parent(rows: DataFrame, reference: Reference, parent: DataFrame, flag: str) -> DataFrame:
    keys = parent.select(*[F.col(p).alias(c) for p, c in zip(reference.parent_columns, reference.columns)])
    keys = keys.dropna().distinct().withColumn("_there", F.lit(True))
    found = rows.join(keys, list(reference.columns), "left")
    return found.withColumn(flag, _is_known(reference.columns) & F.col("_there").isNull()).select(*rows.columns, flag)


def enforce(
    rows: DataFrame, table: Table, parents: Mapping[str, DataFrame] | None = None, stored: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows that keep every rule of the table, and the others with ``violations``; see :func:`checked`."""
    found = checked(rows, table, parents, stored)
    return found.where(F.size("violations") == 0).drop("violations"), found.where(F.size("violations") > 0)


def checked(
    rows: DataFrame, table: Table, parents: Mapping[str, DataFrame] | None = None, stored: DataFrame | None = None
) -> DataFrame:
    """Add ``violations``: names of all rules of the table that a row breaks.

    References are checked for the parents given.  UNIQUE rules are those of the other keys: the primary key is
    what a merge folds on.  Only rows that keep the row-wise rules are held against other rows, so a refused row
    refuses no other.
    """
    kept, broken = split(rows, table)
    flags = {}
    for number, key in enumerate(table.other_keys):
        if set(key) <= set(rows.columns):
            kept = _shares(kept, table, key, f"_shares_{number}")
            flags[f"_shares_{number}"] = unique_code(key)
            if stored is not None:
                kept = _meets(kept, table, key, stored, f"_meets_{number}")
                flags[f"_meets_{number}"] = unique_code(key)
    for number, reference in enumerate(table.references):
        if parents and reference.parent in parents:
            kept = _has_no_parent(kept, reference, parents[reference.parent], f"_orphan_{number}")
            flags[f"_orphan_{number}"] = reference_code(reference)
    if not flags:
        return rule_violations(rows, table)
    found = F.array_distinct(F.array_compact(F.array(*[F.when(F.col(f), F.lit(code)) for f, code in flags.items()])))
    return once(kept, violations=found).drop(*flags).unionByName(broken)
