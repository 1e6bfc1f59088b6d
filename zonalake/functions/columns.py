"""Column expressions shared by the layers. All are built-ins, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonalake.fixed_values import HIGH, HIGH_FROM, LOW, MEDIUM, MEDIUM_FROM, TRAFFIC_PREFIX


def rounded(value: Column, places: int = 2) -> Column:
    """Half-up rounding through DECIMAL.

    Means of two-decimal values are often exact ties; binary rounding would let the order of
    summation decide them.
    """
    return F.round(value.cast("decimal(28,6)"), places).cast("double")


def exact_sum(value: Column) -> Column:
    """Aggregate: a sum of doubles that does not depend on the order or partitioning of the rows.

    A value's 60 bits above and 60 bits below the point are cut into parts of 20 bits, which are added
    as whole numbers; that is exact for 2^43 rows, and addition of longs in generated code. Bits further
    down are rounded off. Values of 2^60 and more, infinities and NaN are added as doubles beside them.
    """
    number = value.cast("double")
    size = F.abs(number)
    fits = size < 2.0**60
    sign = F.when(number < 0, -1).otherwise(1)
    above = F.floor(F.when(fits, size))
    below = F.rint((size - above) * 2.0**60).cast("long")
    total = F.lit(0.0)
    for bits, unit in ((below, 2.0**-60), (above, 1.0)):
        for shift in (0, 20, 40):
            part = F.shiftright(bits, shift)
            part = part if shift == 40 else part.bitwiseAND(F.lit(0xFFFFF).cast("long"))
            total = total + F.sum(part * sign).cast("double") * (unit * 2.0**shift)
    rest = F.sum(F.when(~fits, number))
    return F.coalesce(total + rest, total, rest)


def weighted_mean(total: Column, count: Column, weight: Column) -> Column:
    """Aggregate: mean over groups given by their sum and count, each repeated `weight` times."""
    w = weight.cast("double")
    return F.try_divide(exact_sum(total * w), exact_sum(count * w))


def hour_of_text(value: Column, pattern: str | None = None) -> Column:
    """Hour of a timestamp text in the session time zone; NULL when the text does not match.

    Without a pattern the text is read as ISO, and an offset in it is honoured.
    """
    if pattern is None:
        return F.hour(F.try_to_timestamp(value))
    return F.hour(F.try_to_timestamp(value, F.lit(pattern)))


def air_zone(station: Column) -> Column:
    """Lower case, with hyphens and spaces as underscores."""
    return F.lower(F.translate(station, "- ", "__"))


def traffic_zone(label: Column, prefix: str = TRAFFIC_PREFIX) -> Column:
    """Every `prefix` deleted (case-sensitive, before lowering), spaces as underscores, lower case."""
    bare = F.replace(label, F.lit(prefix), F.lit(""))
    return F.lower(F.replace(bare, F.lit(" "), F.lit("_")))


def traffic_level(
    average: Column, medium_from: float = MEDIUM_FROM, high_from: float = HIGH_FROM
) -> Column:
    """Level of an already rounded average. A NULL average falls to the last level."""
    return (
        F.when(average < medium_from, LOW)
        .when((average >= medium_from) & (average < high_from), MEDIUM)
        .otherwise(HIGH)
    )


def zone_label(zone: Column) -> Column:
    """Display form: underscores as spaces, each word capitalised."""
    return F.initcap(F.replace(zone, F.lit("_"), F.lit(" ")))


def hour_label(hour: Column) -> Column:
    """Display form such as `07h`."""
    return F.format_string("%02dh", hour)


def level_label(level: Column) -> Column:
    """Display form: the level without the word Traffic."""
    return F.replace(level, F.lit(" Traffic"), F.lit(""))
