"""Column expressions shared by all plans. Everything here stays inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(18,0)"


def quotient(num: Column, den: Column, per: int = 1) -> Column:
    """``num * per / den`` of two whole numbers as a decimal; null when ``den`` is 0."""
    return num.cast(EXACT) * F.lit(per) / F.nullif(den.cast(EXACT), F.lit(0).cast(EXACT))


def ratio(num: Column, den: Column, scale: int, per: int = 1) -> Column:
    """``quotient`` rounded half away from zero, as a double."""
    return F.round(quotient(num, den, per), scale).cast("double")


def real_ratio(num: Column, den: Column) -> Column:
    """Unrounded double ratio; equal fractions give equal doubles, so it is safe to rank by."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def sample_std(n: Column, total: Column, squares: Column) -> Column:
    """Sample deviation from exact whole-number sums; null below two values.

    Sums of integers do not depend on the merge order of partial aggregates, so
    the value is the same for every partitioning.
    """
    n_, s_ = n.cast(EXACT), total.cast(EXACT)
    spread = n_ * squares.cast("decimal(19,0)") - s_ * s_
    pairs = n.cast("double") * (n.cast("double") - 1.0)
    return F.when(n > 1, F.sqrt(spread.cast("double") / pairs))


def clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def fixed_text(value: Column, places: int) -> Column:
    """Fixed-point text of a double, rounded by its exact binary value with ties to even.

    ``round``/``bround`` decide on the shortest decimal text, where 2.675 counts
    as a tie; the number formatter only takes true ties for ties.
    """
    pattern = "0" if places == 0 else "0." + "0" * places
    return F.call_function("format_number", value.cast("double"), F.lit(pattern))


def round_half_even(value: Column, places: int) -> Column:
    """The double nearest to ``fixed_text``."""
    return F.rint(value) if places == 0 else fixed_text(value, places).cast("double")


def round_scaled(value: Column, places: int) -> Column:
    """Scale, round half to even, scale back: the columnar rule of array libraries."""
    power = F.lit(float(10**places))
    return F.rint(value * power) / power


def grouped_text(value: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(round_half_even(value, 0), 0)


def plain_text(value: Column, places: int) -> Column:
    """Shortest text of a double already rounded to ``places``, with at least one decimal."""
    text = F.format_string(f"%.{places}f", value)
    return F.regexp_replace(text, r"(\.\d+?)0+$", "$1") if places > 1 else text


def contains_text(needle: str, columns: Iterable[Column]) -> Column:
    """Case-insensitive literal substring in any of the columns; ``%`` and ``_`` are plain characters."""
    found = F.lit(False)
    for column in columns:
        found = found | F.contains(F.lower(column.cast("string")), F.lit(needle.lower()))
    return found


def all_of(conditions: Iterable[Column | None]) -> Column:
    """Conjunction of the given conditions; None means the filter was not asked for."""
    result = F.lit(True)
    for condition in conditions:
        if condition is not None:
            result = result & condition
    return result


def risk_tier(score: Column) -> Column:
    return (
        F.when(score >= 75.0, "CRITICAL")
        .when(score >= 60.0, "HIGH")
        .when(score >= 40.0, "MEDIUM")
        .otherwise("LOW")
    )
