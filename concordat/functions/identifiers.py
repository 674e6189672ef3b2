"""Identifier expressions: tidy, unpad and check digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tidy_id(text: Column) -> Column:
    return F.upper(F.trim(text))


def unpad(text: Column) -> Column:
    """A number kept as text, without leading zeros; text that is no number fails."""
    return text.cast("bigint").cast("string")


def is_digits(text: Column) -> Column:
    return text.rlike(r"\A[0-9]+\z")


# The characters of an identifier, each worth its place in the list.
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def mod97(text: Column) -> Column:
    """ISO 7064 MOD 97-10 remainder of an identifier; 1 means the check digits hold.

    A digit shifts the remainder by one decimal place and a letter, worth 10 to 35, by
    two. Any other character, or none at all, makes the result NULL. The text is named
    once in the expression, so it is worked out once per row.
    """

    def add(remainder: Column, char: Column) -> Column:
        value = F.instr(F.lit(ALPHABET), char) - 1
        return (
            F.when(value > 9, (remainder * 100 + value) % 97)
            .when((value >= 0) & (char != ""), (remainder * 10 + value) % 97)
        )

    return F.aggregate(F.split(tidy_id(text), ""), F.lit(0), add)


def check_digits_hold(text: Column) -> Column:
    """Never NULL: a missing or malformed identifier does not hold."""
    return mod97(text).eqNullSafe(F.lit(1))


def with_check_digits(base: Column) -> Column:
    """An 18-character base with the two digits that make the remainder 1."""
    digits = F.lit(98) - mod97(F.concat(base, F.lit("00")))
    return F.concat(base, F.lpad(digits.cast("string"), 2, "0"))
