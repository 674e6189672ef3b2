"""The same functions by name, for queries written in SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .identifiers import ALPHABET
from .similarity import jaro_winkler
from .text import accent_table


def create_functions(spark: SparkSession) -> None:
    """Make `lei_mod97`, `strip_accents` and `jaro_winkler_similarity` known to the session."""
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION lei_mod97(id STRING) RETURNS INT RETURN
        aggregate(
          transform(split(upper(trim(id)), ''), c -> CASE WHEN c <> '' THEN instr('{ALPHABET}', c) - 1 END),
          0,
          (r, v) -> CASE WHEN v > 9 THEN (r * 100 + v) % 97 WHEN v >= 0 THEN (r * 10 + v) % 97 END)"""
    )
    accented, plain = accent_table()
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION strip_accents(text STRING) RETURNS STRING "
        f"RETURN translate(text, '{accented}', '{plain}')"
    )
    spark.udf.register("jaro_winkler_similarity", jaro_winkler)
