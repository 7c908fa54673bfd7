"""Number parsing with sentinels, and exact means."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..fixed_values import RATIO_NULL_TEXTS, WEATHER_NULL_TEXTS
from .text import strip


# ``clean`` says that the text is stripped already, as leaves of a read document are.


def _cut(text: Column, clean: bool) -> Column:
    return text if clean else strip(text)


def _parse(text: Column, null_texts: tuple[str, ...], target: str) -> Column:
    return F.when(~text.isin(*null_texts), text.try_cast(target))


def _is_junk(text: Column, null_texts: tuple[str, ...], target: str) -> Column:
    bad = ~text.isin(*null_texts) & text.try_cast(target).isNull()
    return F.coalesce(bad, F.lit(False))


def weather_number(text: Column, target: str, clean: bool = False) -> Column:
    """Weather number as ``decimal(p,s)``; sentinels and junk give NULL."""
    return _parse(_cut(text, clean), WEATHER_NULL_TEXTS, target)


def weather_number_is_junk(text: Column, target: str, clean: bool = False) -> Column:
    return _is_junk(_cut(text, clean), WEATHER_NULL_TEXTS, target)


def ratio(text: Column, target: str = "decimal(5,2)", clean: bool = False) -> Column:
    """Population ratio; its sentinels differ from the weather ones."""
    return _parse(_cut(text, clean), RATIO_NULL_TEXTS, target)


def ratio_is_junk(text: Column, target: str = "decimal(5,2)", clean: bool = False) -> Column:
    return _is_junk(_cut(text, clean), RATIO_NULL_TEXTS, target)


def strict_int(text: Column, clean: bool = False) -> Column:
    """Whole number or NULL: ``'12.0'`` is not a whole number, ``' +5 '`` is."""
    return _cut(text, clean).try_cast("int")


def unscaled(value: Column, digits: int) -> Column:
    """A decimal of at most ``digits`` places as a whole number of its last place."""
    return (value * F.lit(10 ** digits)).cast("bigint")


def half_up_quotient(total: Column, count: Column) -> Column:
    """``total / count`` to the nearest whole number, halves away from zero, exactly."""
    nearest = F.call_function("div", F.abs(total) * 2 + count, count * 2)
    return F.when(count > 0, F.when(total < 0, -nearest).otherwise(nearest))


def mean_of_units(total: Column, count: Column, unit_digits: int, digits: int = 2) -> Column:
    """Exact mean, rounded half up to ``digits`` places.

    ``total`` is a whole number counted in units of 10**-unit_digits, so the sum
    runs on longs in generated code and nothing is rounded twice.
    """
    shift = digits - unit_digits
    if shift >= 0:
        whole = half_up_quotient(total * F.lit(10 ** shift), count)
    else:
        whole = half_up_quotient(total, count * F.lit(10 ** -shift))
    return (whole.cast("decimal(20,0)") / F.lit(10 ** digits).cast("decimal(5,0)")).cast(
        f"decimal(18,{digits})"
    )


def mean_int(value: Column, digits: int = 2) -> Column:
    """Rounded mean of an integer column, NULLs ignored."""
    return mean_of_units(F.sum(value.cast("bigint")), F.count(value), 0, digits)


def mean_decimal(value: Column, scale: int = 2, digits: int = 2) -> Column:
    """Rounded mean of a ``decimal(p,scale)`` column, NULLs ignored."""
    return mean_of_units(F.sum(unscaled(value, scale)), F.count(value), scale, digits)


def mean_midpoint(low: Column, high: Column, digits: int = 2) -> Column:
    """Rounded mean of ``(low + high) / 2``, over rows where both are known."""
    doubled = low.cast("bigint") + high.cast("bigint")
    return mean_of_units(F.sum(doubled * 5), F.count(doubled), 1, digits)
