"""Column expressions the operators share. All stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell import config

# Terms of a ranked sum are whole numbers of this part of one, so that the sum does not
# depend on the order of tasks. Integers, because wide decimals leave generated code's
# fast path.
UNIT = 1e9


def lookup(key: Column, table: dict, default=None) -> Column:
    """A constant table as a CASE expression; `default` when no entry fits."""
    chain = F
    for name, value in table.items():
        chain = chain.when(key == F.lit(name), F.lit(value))
    return chain.otherwise(F.lit(default))


def event_type_or_view(event_type: Column) -> Column:
    """An event without a type counts as a view."""
    return F.coalesce(event_type, F.lit("view"))


def interaction_weight(event_type: Column) -> Column:
    return lookup(
        F.lower(event_type_or_view(event_type)),
        config.INTERACTION_WEIGHTS,
        config.OTHER_INTERACTION_WEIGHT,
    )


def implicit_rating(event_type: Column) -> Column:
    return lookup(
        F.lower(event_type_or_view(event_type)),
        config.IMPLICIT_RATINGS,
        config.OTHER_IMPLICIT_RATING,
    )


def filled(text: Column) -> Column:
    """`text`, or null when it is empty."""
    return F.nullif(text, F.lit(""))


def has_text(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def nonzero(number: Column) -> Column:
    """`number`, or null when it is zero: a zero price or timestamp counts as absent."""
    return F.nullif(number, F.lit(0))


def parse_double(text: Column) -> Column:
    """The number in `text`, or null when there is none."""
    return F.trim(text).try_cast("double")


def parse_long(text: Column) -> Column:
    """The whole number in `text`; "2.5" is not one."""
    bare = F.trim(text)
    return F.when(bare.rlike(r"^[+-]?\d+$"), bare.try_cast("bigint"))


def clamp01(number: Column) -> Column:
    """`number` limited to 0..1; not-a-number becomes 0."""
    value = number.cast("double")
    return F.when(F.isnan(value), F.lit(0.0)).otherwise(
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), value))
    )


def round_to(number: Column, digits: int) -> Column:
    """Round half up on the binary value, the same in every engine."""
    factor = float(10**digits)
    return F.floor(number.cast("double") * F.lit(factor) + F.lit(0.5)).cast("double") / F.lit(factor)


def ratio(part: Column, whole: Column, default: float = 0.0) -> Column:
    """part / whole, `default` where the whole is 0."""
    return F.when(whole == 0, F.lit(default)).otherwise(
        part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")
    )


def fixed_sum(term: Column) -> Column:
    """The sum of `term` to nine decimals, the same for any order of the rows."""
    return F.sum(F.floor(term * F.lit(UNIT) + F.lit(0.5)).cast("bigint")).cast("double") / F.lit(UNIT)


def to_millis(timestamp: Column) -> Column:
    """Epoch milliseconds of a timestamp, with or without time zone."""
    return F.unix_millis(timestamp.cast("timestamp"))


def last_of(values: Column, n: int) -> Column:
    """The last `n` entries of an array; the whole array when it is shorter."""
    return F.when(F.size(values) >= n, F.slice(values, -n, n)).otherwise(values) if n > 0 else values


def median_of(values: Column) -> Column:
    """The middle of an array of numbers, the mean of both middles when even."""
    ordered = F.array_sort(values)
    size = F.size(ordered)
    upper = F.element_at(ordered, (size / 2).cast("int") + 1)
    lower = F.element_at(ordered, F.greatest(F.lit(1), (size / 2).cast("int")))
    return F.when(size == 0, F.lit(None)).when(size % 2 == 1, upper).otherwise((lower + upper) / 2)
