"""Load models: raw rows to typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import is_digits, tidy_id, unpad
from ..functions.text import collapse_spaces, search_text

# The register's column names and the names they are published under.
REGISTER_COLUMNS = {
    "LEI": "lei",
    "Entity.LegalName": "legal_name",
    "Entity.LegalAddress.Country": "country",
    "Entity.LegalAddress.City": "city",
    "Entity.LegalJurisdiction": "jurisdiction",
    "Entity.LegalForm.EntityLegalFormCode": "legal_form",
    "Entity.EntityStatus": "entity_status",
    "Registration.RegistrationStatus": "registration_status",
}
REGISTER_DATES = {
    "Registration.InitialRegistrationDate": "initial_registration",
    "Registration.NextRenewalDate": "next_renewal",
}


def calendar_date(text: Column) -> Column:
    """The date a timestamp text starts with, or NULL where there is none.

    Year, month and day must all be there; Spark's own cast would read a bare year.
    """
    day = F.trim(F.substring(text, 1, 10))
    whole = day.rlike(r"\A\d{4}([-/])\d{1,2}\1\d{1,2}\z")
    return F.when(whole, F.replace(day, F.lit("/"), F.lit("-")).try_cast("date"))


def load_register(raw: DataFrame) -> DataFrame:
    """The published fields of a register export, values as the register gives them."""
    plain = [F.col(f"`{source}`").alias(name) for source, name in REGISTER_COLUMNS.items()]
    dates = [calendar_date(F.col(f"`{source}`")).alias(name) for source, name in REGISTER_DATES.items()]
    return raw.select(*plain, *dates)


def load_taxonomy(raw: DataFrame) -> DataFrame:
    """Codes, titles and descriptions, with the level that the code's shape implies."""
    code = F.col("code")
    text = F.col("description")
    nothing = F.lower(F.trim(F.coalesce(text, F.lit("")))).isin("", "null")
    # Levels by number of digits; a hyphenated range is a sector.
    level = (
        F.when(code.contains("-") | (F.length(code) == 2), "sector")
        .when(F.length(code) == 3, "subsector")
        .when(F.length(code) == 4, "industry_group")
        .when(F.length(code) == 5, "naics_industry")
        .when(F.length(code) == 6, "national_industry")
    )
    return raw.select(
        code,
        F.regexp_replace(F.trim("title"), r"T\z", "").alias("title"),
        level.alias("level"),
        F.when(~nothing, collapse_spaces(text)).alias("description"),
    )


def with_corpus(table: DataFrame, *columns: str) -> DataFrame:
    return table.withColumn("corpus", search_text(*[F.col(c) for c in columns]))


# A name line ends in a ten-digit number between colons; the name may hold colons itself.
TRAILING_KEY = r":([0-9]{10}):\z"


def parse_name_lines(lines: DataFrame) -> DataFrame:
    """Number and name off each line; other lines and empty names are left out."""
    line = F.col("line")
    name = F.regexp_replace(line, TRAILING_KEY, "")
    return lines.where(line.rlike(TRAILING_KEY) & ~line.contains("\n") & (name != "")).select(
        unpad(F.regexp_extract(line, TRAILING_KEY, 1)).alias("cik"), name.alias("company_name")
    )


def entity_universe(names: DataFrame, tickers: DataFrame) -> DataFrame:
    """Every name of every filer, with one ticker and exchange where the filer has any."""
    one = tickers.groupBy(unpad(F.col("cik").cast("string")).alias("cik")).agg(
        F.min("ticker").alias("ticker"), F.min("exchange").alias("exchange")
    )
    return names.join(one, "cik", "left").select("cik", "company_name", "ticker", "exchange")


def type_registrations(raw: DataFrame) -> DataFrame:
    """Registrations typed by the scheme of the number they were made under.

    Numbers of any other scheme would be edges to nothing and are left out.
    """
    number = F.col("registered_as")
    kind = (
        F.when(number.startswith("S"), "series")
        .when(number.startswith("C"), "class")
        .when(is_digits(number), "cik")
    )
    key = F.when(is_digits(number), unpad(number)).otherwise(F.trim(number))
    return (
        raw.where(kind.isNotNull() & F.col("lei").isNotNull())
        .select(tidy_id(F.col("lei")).alias("lei"), kind.alias("key_type"), key.alias("key"), "category")
    )
