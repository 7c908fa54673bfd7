"""Text helpers and canonical JSON."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..fixed_values import WHITE_SPACE


def strip(text: Column) -> Column:
    """Cut white space from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def leaf(text: Column) -> Column:
    """A document leaf: stripped, and NULL when nothing is left.

    The XML reader has cut ASCII white space already, so only texts with other
    characters need the slow cut.
    """
    ascii_only = F.length(text) == F.octet_length(text)
    return F.nullif(F.when(ascii_only, text).otherwise(strip(text)), F.lit(""))


def join_lines(*texts: Column) -> Column:
    """Join message texts by newline; a missing member is skipped."""
    return F.concat_ws("\n", *texts)


def canonical_json(json_text: Column) -> Column:
    """Sorted keys, no blanks, Unicode kept; NULL when the text is no JSON."""
    return F.to_json(F.try_parse_json(json_text))


def fingerprint(canonical: Column) -> Column:
    return F.sha2(canonical, 256)
