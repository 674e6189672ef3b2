"""Text expressions: accent stripping, search text, full-match patterns, rendering."""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@functools.cache
def accent_table() -> tuple[str, str]:
    """Every character that loses an accent with the one left behind, then every mark.

    Decompose, drop the combining marks, recompose. Characters that do not decompose
    (the Polish l with stroke, the Danish o with stroke, sharp s) are left alone. Marks
    that stand by themselves have no counterpart, which is how `translate` drops them.
    """
    accented, plain, marks = [], [], []
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if unicodedata.category(char).startswith("M"):
            marks.append(char)
            continue
        parts = unicodedata.normalize("NFD", char)
        kept = "".join(p for p in parts if not unicodedata.category(p).startswith("M"))
        bare = unicodedata.normalize("NFC", kept)
        if len(bare) == 1 and bare != char:
            accented.append(char)
            plain.append(bare)
    return "".join(accented + marks), "".join(plain)


def once(value: Column) -> Column:
    """A costly value to filter on, worked out where it stands and once per row.

    Written as a generator: a filter on a plain column would be moved down to the scan
    together with the expression, ahead of the aggregate that leaves fewer rows.
    """
    return F.explode(F.array(value))


def strip_accents(text: Column) -> Column:
    """`text` without accents. Plain ASCII values skip the character table."""
    accented, plain = accent_table()
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, accented, plain)).otherwise(text)


def search_text(*parts: Column) -> Column:
    """One lower-case, accent-free search field; a missing part leaves no gap."""
    return F.lower(strip_accents(F.concat_ws(" ", *parts)))


def collapse_spaces(text: Column) -> Column:
    """Runs of white space become one space, and the ends are trimmed."""
    return F.trim(F.regexp_replace(text, r"[ \t\n\f\r]+", " "))


def is_blank(text: Column) -> Column:
    return text.isNull() | (text == "")


def matches_whole(text: Column, pattern: str) -> Column:
    """Whether the whole value matches, a trailing newline included."""
    return text.rlike(rf"\A(?:{pattern})\z")


def as_text(value: Column, kind: T.DataType) -> Column:
    """A value written the way a contract reads it.

    Floating point is written as a plain decimal with no exponent, so that a pattern sees
    `0.0000001` rather than `1.0E-7`. Values too wide for that keep their own form.
    """
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        own = value.cast("string")
        fixed = value.try_cast("decimal(38,18)").cast("string")
        plain = F.coalesce(F.regexp_replace(fixed, r"(\.\d+?)0+$", "$1"), own)
        return F.when(own.contains("E"), plain).otherwise(own)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value.cast("string")


def quoted_key(*values: Column) -> Column:
    """A key as text for a message: values in quotes, a missing part bare as NULL."""
    parts = [
        F.when(v.isNull(), F.lit("NULL")).otherwise(F.concat(F.lit("'"), v.cast("string"), F.lit("'")))
        for v in values
    ]
    if len(parts) == 1:
        return parts[0]
    return F.concat(F.lit("("), F.concat_ws(", ", *parts), F.lit(")"))


def grouped_digits(count: Column) -> Column:
    """A count with thousands separators, as messages print it."""
    return F.format_number(count, 0)


def written_like(count: Column, like: Column) -> Column:
    """`count` in the form and to the precision that the stated figure `like` has.

    A figure written in full is matched digit for digit. One with a K, M or B suffix is
    the count rounded half-up to as many decimals as the figure shows. A figure in any
    other form gives NULL, which the caller reports as a disagreement.
    """
    whole = F.when(like.contains(","), grouped_digits(count)).otherwise(count.cast("string"))
    scale = (
        F.when(like.endswith("K"), F.lit(1_000))
        .when(like.endswith("M"), F.lit(1_000_000))
        .otherwise(F.lit(1_000_000_000))
    )
    decimals = F.length(F.regexp_extract(like, r"\.(\d+)[KMB]", 1))
    # Half-up in whole numbers: scale to the last stated decimal, add a half, cut.
    step = (scale / F.pow(F.lit(10), decimals)).cast("decimal(38,9)")
    units = F.floor(count.cast("decimal(28,0)") / step + F.lit(0.5).cast("decimal(2,1)")).cast("bigint")
    shift = F.pow(F.lit(10), decimals).cast("bigint")
    fraction = F.lpad(F.pmod(units, shift).cast("string"), decimals, "0")
    whole_part = F.floor(units / shift).cast("bigint").cast("string")
    rounded = F.concat(
        whole_part,
        F.when(decimals > 0, F.concat(F.lit("."), fraction)).otherwise(F.lit("")),
        F.substring(like, -1, 1),
    )
    return (
        F.when(matches_whole(like, r"\d{1,3}(?:,\d{3})+|\d+"), whole)
        .when(matches_whole(like, r"\d+(?:\.\d+)?[KMB]"), rounded)
        .otherwise(F.lit(None).cast("string"))
    )
