"""Identifier admission, tiered edges, their enrichment and the gate behind them.

An edge says that a filer key and a register identifier name the same entity.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.identifiers import check_digits_hold, tidy_id, unpad
from ..functions.text import once, search_text
from ..session import staged

EDGE = ["key_type", "key", "lei"]

# Tiers and the methods that put an edge in them.
AUTHORITATIVE = "authoritative"
REGISTRATION = "sec-registration"
FILING = "sec-ncen"
NAME_TIERS = ["confirmed", "candidate", "ambiguous"]
DEFAULT_CATEGORY = "GENERAL"


def tidy_key(key: Column) -> Column:
    """A filer's key in one form: trimmed, a number without leading zeros."""
    text = F.trim(key)
    return F.when(text.startswith("0"), F.regexp_replace(text, r"^0+(?=[0-9]+$)", "")).otherwise(text)


def published_ids(register: DataFrame) -> DataFrame:
    """Identifiers of the register, to be met by semi and anti joins only."""
    return register.select(tidy_id(F.col("lei")).alias("lei"))


def admit_identifiers(filings: DataFrame, register: DataFrame) -> DataFrame:
    """Distinct (key, lei) claims whose identifier holds, or which the register publishes.

    Keys are admitted in their tidy form; a blank key is none.

    Identifiers are reduced to one row each before their digits are checked, so a
    placeholder that very many claims carry is checked once. Those that fail meet the
    register, and the claims then meet only the few that the register does publish.
    """
    claims = filings.select(tidy_key(F.col("key")).alias("key"), tidy_id(F.col("lei")).alias("lei")).where(
        "lei <> '' and key <> ''"
    )
    holds = check_digits_hold(F.col("lei"))
    doubtful = claims.select("lei").distinct().select("lei", once(holds).alias("holds")).where(~F.col("holds"))
    kept = doubtful.join(published_ids(register), "lei", "left_semi").select("lei", F.lit(True).alias("published"))
    return (
        claims.distinct()
        .join(kept, "lei", "left")
        .select("key", "lei", once(F.col("published").isNotNull() | holds).alias("admitted"))
        .where("admitted")
        .select("key", "lei")
    )


def unresolved(edges: DataFrame, register: DataFrame) -> DataFrame:
    """One row per identifier that fails both tests, with the edges that carry it."""
    counted = edges.groupBy("lei").agg(F.count(F.lit(1)).alias("edges"))
    failing = counted.select("lei", "edges", once(check_digits_hold(F.col("lei"))).alias("holds")).where(~F.col("holds"))
    return failing.select("lei", "edges").join(published_ids(register), "lei", "left_anti")


def gate_report(edges: DataFrame, register: DataFrame, examples: int = 5) -> DataFrame:
    """One row: edges and distinct identifiers that fail both tests, and the first few."""
    failing = unresolved(edges, register)
    totals = failing.agg(
        F.coalesce(F.sum("edges"), F.lit(0)).alias("edges"),
        F.count(F.lit(1)).alias("distinct_ids"),
    ).withColumn("lei", F.lit(None).cast("string"))
    shown = failing.select("lei").orderBy("lei").limit(examples)
    return totals.unionByName(shown, allowMissingColumns=True).agg(
        F.max("edges").alias("edges"),
        F.max("distinct_ids").alias("distinct_ids"),
        F.array_join(F.array_sort(F.collect_list("lei")), ", ").alias("examples"),
    )


def split_edges(edges: DataFrame, register: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges that pass the gate, and those it would refuse; the failing identifiers are one row each."""
    failing = unresolved(edges.where(F.col("lei").isNotNull()), register).select("lei")
    return edges.join(failing, "lei", "left_anti").select(*edges.columns), edges.join(failing, "lei", "left_semi").select(*edges.columns)


class GateError(Exception):
    """A gate refused the table behind it."""


def require_identifiers(edges: DataFrame, register: DataFrame) -> DataFrame:
    """`edges` unchanged, or a GateError where any identifier names nothing."""
    found = gate_report(edges, register).first()
    if found.edges:
        raise GateError(
            f"{found.edges} edge(s) carry an identifier that fails its check digits and that the "
            f"register does not publish: {found.distinct_ids} distinct, e.g. {found.examples}"
        )
    return edges


def dedup_edges(edges: DataFrame) -> DataFrame:
    """One row per edge; a registration wins over a filing, then the first category.

    The smallest row is kept by a partial aggregate, so a much repeated edge is reduced
    before it is shuffled.
    """
    order = F.struct(
        F.when(F.col("method") == REGISTRATION, 0).otherwise(1).alias("rank"),
        F.col("category").isNull().alias("untyped"),
        "category",
        "method",
        "tier",
        "confidence",
    )
    return edges.groupBy(*EDGE).agg(F.min(order).alias("first")).select(
        *EDGE, "first.category", "first.method", "first.tier", "first.confidence"
    )


def authoritative_edges(
    registrations: DataFrame, filed_ciks: DataFrame, filed_series: DataFrame
) -> DataFrame:
    """Edges from official sources: typed registrations and two kinds of annual filing."""

    def stamped(source: DataFrame, method: str) -> DataFrame:
        return source.select(
            *EDGE,
            "category",
            F.lit(method).alias("method"),
            F.lit(AUTHORITATIVE).alias("tier"),
            F.lit(1.0).alias("confidence"),
        )

    def fund(source: DataFrame, key_type: str) -> DataFrame:
        return source.withColumns({"key_type": F.lit(key_type), "category": F.lit("FUND")})

    parts = [
        stamped(registrations, REGISTRATION),
        stamped(fund(filed_ciks, "cik"), FILING),
        stamped(fund(filed_series, "series"), FILING),
    ]
    return dedup_edges(reduce(DataFrame.unionByName, parts))


def probabilistic_edges(resolved: DataFrame, authoritative: DataFrame) -> DataFrame:
    """The best name match per (cik, lei), for keys that no authoritative edge covers."""
    covered = authoritative.where(F.col("key_type") == "cik").select("key").distinct()
    best = F.struct(F.col("confidence"), F.col("method"), F.col("tier"))
    return (
        resolved.where(F.col("status").isin(NAME_TIERS))
        .select(
            unpad(F.col("cik")).alias("key"),
            F.upper("lei").alias("lei"),
            "method",
            F.col("status").alias("tier"),
            F.col("match_probability").alias("confidence"),
        )
        .groupBy("key", "lei")
        .agg(F.max(best).alias("best"))
        .join(covered, "key", "left_anti")
        .select(
            F.lit("cik").alias("key_type"),
            "key",
            "lei",
            F.lit(None).cast("string").alias("category"),
            "best.method",
            "best.tier",
            "best.confidence",
        )
    )


def tier_edges(
    registrations: DataFrame, filed_ciks: DataFrame, filed_series: DataFrame, resolved: DataFrame
) -> DataFrame:
    """Every edge in its tier; an authoritative edge displaces name matches for its key.

    Official edges are staged, as they are both part of the result and the keys that name
    matches are held against.
    """
    official = staged(authoritative_edges(registrations, filed_ciks, filed_series), "official")
    return official.unionByName(probabilistic_edges(resolved, official))


def one_row_per_filer(universe: DataFrame) -> DataFrame:
    """Filers with all their tickers in one list and the first of their names.

    Tickers are made distinct before they are listed, so a filer repeated many times
    reaches its list as one row per ticker.
    """
    names = universe.groupBy("cik", "ticker").agg(F.min("company_name").alias("company_name"))
    return names.groupBy("cik").agg(
        F.array_join(F.array_sort(F.collect_list("ticker")), ",").alias("ticker_list"),
        F.count("ticker").alias("tickers"),
        F.min("company_name").alias("company_name"),
    ).select("cik", F.when(F.col("tickers") > 0, F.col("ticker_list")).alias("ticker"), "company_name")


def enrich_edges(edges: DataFrame, register: DataFrame, universe: DataFrame, as_of: str | None) -> DataFrame:
    """Edges with the names and attributes of both sides, the run date and a search field.

    Both lookups hold one row per key, so neither fans an edge out, and adaptive
    execution may split a key that very many edges share.
    """
    entity = register.select(
        tidy_id(F.col("lei")).alias("lei"),
        "legal_name",
        "jurisdiction",
        F.col("registration_status").alias("reg_status"),
    )
    filer = one_row_per_filer(universe).select(
        F.lit("cik").alias("key_type"), F.col("cik").alias("key"), "ticker", F.col("company_name").alias("filer")
    )
    name = F.coalesce("filer", "legal_name")
    return (
        edges.join(entity, "lei", "left")
        .join(filer, ["key_type", "key"], "left")
        .select(
            "key_type",
            "key",
            "ticker",
            name.alias("company_name"),
            "lei",
            "legal_name",
            F.coalesce("category", F.lit(DEFAULT_CATEGORY)).alias("category"),
            "jurisdiction",
            "reg_status",
            "method",
            "tier",
            F.round("confidence", 6).alias("confidence"),
            F.lit(as_of or None).cast("date").alias("as_of"),
            search_text(name, F.col("legal_name"), F.col("ticker"), F.col("lei")).alias("corpus"),
        )
    )


def excluded_keys(sources: list[DataFrame], edges: DataFrame) -> DataFrame:
    """Source keys that no edge carries; each source has `key_type` and `key`."""
    keys = reduce(DataFrame.unionByName, [s.select("key_type", "key") for s in sources])
    usable = F.col("key").isNotNull() & (F.trim("key") != "")
    carried = edges.select("key_type", "key").distinct()
    return keys.where(usable).distinct().join(carried, ["key_type", "key"], "left_anti")


def _sorting(table: DataFrame, column: str, descending: bool) -> list:
    """What sorts like the column in the direction asked for, a NULL last in either."""
    value, kind = F.col(column), table.schema[column].dataType
    if descending:
        if isinstance(kind, T.DateType):
            value = F.unix_date(value)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            value = F.unix_micros(value.cast("timestamp"))
        elif isinstance(kind, T.BooleanType):
            value = value.cast("int")
        elif not isinstance(kind, T.NumericType):
            raise TypeError(f"{column}: {kind.simpleString()} has no descending order here")
        value = -value
    return [F.col(column).isNull(), value]


def best_per_key(rows: DataFrame, keys: list[str], order: list, keep: list[str]) -> DataFrame:
    """The first row of each group in a total order, by a partial aggregate.

    `order` lists (column, descending) pairs; a NULL comes last in either direction.
    """
    parts = [part for column, descending in order for part in _sorting(rows, column, descending)]
    ranked = [part.alias(f"o{i}") for i, part in enumerate(parts)]
    first = F.min(F.struct(*ranked, *[F.col(c).alias(c) for c in keep])).alias("first")
    return rows.groupBy(*keys).agg(first).select(*keys, *[f"first.{c}" for c in keep])
