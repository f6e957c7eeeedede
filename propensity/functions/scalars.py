"""Column functions. All stay inside whole-stage code generation."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F

DAY = 86_400


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970, rounded down. Needs a UTC session for zone-less timestamps."""
    return F.unix_timestamp(ts.cast("timestamp"))


def seconds_between(start: Column, end: Column) -> Column:
    """``end - start`` in seconds, each side rounded down first (0.9 s to 1.1 s is 1)."""
    return epoch_seconds(end) - epoch_seconds(start)


def days_between(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``, rounded down, so -1 hour is -1 day."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    whole = micros - F.pmod(micros, F.lit(DAY * 1_000_000))
    return (whole / (DAY * 1_000_000)).cast("long")


def ratio(numerator: Column, denominator: Column) -> Column:
    """True division to double; NULL when the denominator is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def click_through_rate(clicks: Column, impressions: Column) -> Column:
    """Clicks per impression; 0, not NULL, when impressions are 0 or missing."""
    return F.when(impressions > 0, clicks.cast("double") / impressions).otherwise(F.lit(0.0))


def money_sum(amount: Column) -> Column:
    """Sum amounts in their own type (decimals exactly, in their scale), then give a double."""
    return F.sum(amount).cast("double")


def only(rows: Column | None, value: Column) -> Column:
    """``value`` on the rows that qualify, NULL (so skipped by aggregates) elsewhere."""
    return value if rows is None else F.when(rows, value)


def non_finite_to_null(value: Column) -> Column:
    """NaN and both infinities become NULL."""
    number = value.cast("double")
    finite = ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))
    return F.when(finite, value)


def blank_to_null(text: Column) -> Column:
    """Strings with nothing but white space become NULL."""
    return F.when(~text.rlike(r"^\s*$"), text)


def hash_text(value: Column, seed: int, hex_digits: int) -> Column:
    """A seeded md5 prefix in hexadecimal: the same in every engine, run and partitioning."""
    digest = F.md5(F.concat_ws("-", value.cast("string"), F.lit(str(seed))))
    return F.substring(digest, 1, hex_digits)


def row_digest(df: DataFrame) -> Column:
    """A 128-bit digest of a whole row in hexadecimal: the texts of its columns in order, NULL apart from every text."""

    def text(name: str, kind: str) -> Column:
        column = F.col(f"`{name}`")
        return F.coalesce(F.hex(column) if kind == "binary" else column.cast("string"), F.lit("\x00"))

    return F.md5(F.concat_ws("\x1f", *[text(name, kind) for name, kind in df.dtypes]))


def in_share(value: Column, share: float, seed: int) -> Column:
    """Whether a value's 60-bit hash lies in the first ``share`` of all hashes; any share, however small, counts."""
    return hash_number(value, seed) < F.lit(math.ceil(Fraction(str(share)) * 2**60))


def hash_number(value: Column, seed: int, hex_digits: int = 15) -> Column:
    """The same prefix as a non-negative number."""
    return F.conv(hash_text(value, seed, hex_digits), 16, 10).cast("long")
