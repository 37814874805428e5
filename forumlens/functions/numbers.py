"""Scores, distributions and their text forms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_nearest(x: Column, decimals: int) -> Column:
    """Round by the exact binary value of a double, true ties to even.

    A product that looks like a tie is decided by its rounding error, which the two
    halves of the factor give exactly.
    """
    scale = F.lit(10.0**decimals)
    scaled = x * scale
    spread = x * F.lit(2.0**27 + 1)
    high = spread - (spread - x)
    error = (high * scale - scaled) + (x - high) * scale
    tie = scaled - F.floor(scaled) == 0.5
    nearest = (
        F.when(tie & (error > 0), F.ceil(scaled).cast("double"))
        .when(tie & (error < 0), F.floor(scaled).cast("double"))
        .otherwise(F.rint(scaled))
    )
    return nearest / scale


def comments_per_up(count: Column, ups: Column) -> Column:
    """Comments per upvote to three decimals; 0 when there are no upvotes."""
    return F.coalesce(round_nearest(count / F.nullif(ups, F.lit(0)), 3), F.lit(0.0))


def lurker_score(ratio: Column) -> Column:
    return F.lit(1.0) / F.nullif(ratio, F.lit(0.0))


def largest(distribution: Column) -> Column:
    return F.array_max(distribution)


def dominant_topic(distribution: Column) -> Column:
    """1-based position of the first largest value; 0 when no value is above zero."""
    top = F.array_max(distribution)
    return F.when(top > 0, F.array_position(distribution, top)).otherwise(F.lit(0).cast("long"))


def topic_number(topic: Column) -> Column:
    return topic + 1


def full_digits(x: Column) -> Column:
    """A double with all its digits, written ``0.0001`` and ``1e-05`` rather than ``1.0E-5``."""
    text = x.cast("string")
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    power = F.substring_index(text, "E", -1).try_cast("int")
    sign = F.when(F.startswith(text, F.lit("-")), "-").otherwise("")
    digits = F.translate(mantissa, "-.", "")
    whole = F.rpad(digits, F.greatest(F.length(digits), power + 1), "0")
    fraction = F.substring(whole, power + 2, F.length(whole))
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    large = F.concat(
        sign,
        F.substring(whole, F.lit(1), power + 1),
        F.lit("."),
        F.when(fraction == "", "0").otherwise(fraction),
    )
    exponent = F.abs(power).cast("string")
    scientific = F.concat(
        mantissa,
        F.when(power < 0, "e-").otherwise("e+"),
        F.lpad(exponent, F.greatest(F.lit(2), F.length(exponent)), F.lit("0")),
    )
    return (
        F.when(~F.contains(text, F.lit("E")), text)
        .when(power.between(-4, -1), small)
        .when(power.between(0, 15), large)
        .otherwise(scientific)
    )


def distribution_text(distribution: Column) -> Column:
    """Comma-joined values with all their digits."""
    return F.array_join(F.transform(distribution, full_digits), ",")


def distribution_text_fixed(distribution: Column, decimals: int = 5) -> Column:
    """Comma-joined values with a fixed number of decimals."""
    return F.array_join(
        F.transform(distribution, lambda x: fixed_decimals(x, decimals)), ","
    )


def parse_distribution(text: Column) -> Column:
    """Comma-joined text, quoted or not, as an array of doubles."""
    return F.split(F.replace(text, F.lit('"'), F.lit("")), ",").cast("array<double>")


def fixed_decimals(x: Column, decimals: int) -> Column:
    return F.format_string(f"%.{decimals}f", round_nearest(x, decimals))


def four_decimals(x: Column) -> Column:
    return fixed_decimals(x, 4)


def thousands(n: Column) -> Column:
    return F.format_number(n, 0)
