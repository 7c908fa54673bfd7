"""Plain output types, so that two engines can be compared value by value."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import clock


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, instants as UTC texts, dates as texts, small ints as ints."""
    out = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind.startswith("decimal"):
            column = column.cast("double")
        elif kind == "timestamp":
            column = clock.utc_text(column)
        elif kind == "timestamp_ntz":
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif kind == "date":
            column = F.date_format(column, "yyyy-MM-dd")
        elif kind in ("smallint", "tinyint"):
            column = column.cast("int")
        out.append(column.alias(name))
    return df.select(*out)
