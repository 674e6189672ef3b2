"""Identifier admission, tiers, enrichment and the gate, on the crosswalk's own fixtures."""

import pytest
from pyspark.sql import functions as F

from concordat.operators import edges, loads

GOOD = ["5493001KJTIIGC8Y1R12", "529900T8BM49AURSDO55", "213800WSGIIZCXF1P572", "HWUPKR0MPOU8FGXBT394"]
ZEROS = "0" * 20
WRONG = "6GG1425B5X0SPG36P158"


@pytest.fixture
def register(rows):
    return rows(
        "lei string, legal_name string, jurisdiction string, registration_status string",
        (GOOD[0], "Apple Société", "US-CA", "ISSUED"), (f" {GOOD[1].lower()} ", "Fund", "LU", "LAPSED"), (WRONG, "Odd digits", "GB", "ISSUED"))


@pytest.fixture
def universe(rows):
    return rows(
        "cik string, company_name string, ticker string, exchange string",
        ("1", "ZED CORP", "B", "X"), ("1", "APPLE CORP", "A", "X"), ("1", "APPLE CORP", "A", "Y"), ("2", "NO TICKER", None, None))


def claims(rows, *values):
    return rows("key string, lei string", *values)


def test_admission_by_digits_or_by_register(rows, register):
    filed = claims(
        rows, ("1", GOOD[0]), ("1", f" {GOOD[0].lower()}"), ("2", ZEROS), ("3", WRONG), ("4", GOOD[2]), ("5", None), ("6", ""),
        (None, GOOD[0]), ("7", GOOD[0].replace("0", "O")), ("8", "x"))
    assert rows.of(edges.admit_identifiers(filed, register)) == [("1", GOOD[0]), ("3", WRONG), ("4", GOOD[2])]


def test_admission_of_a_placeholder_held_by_a_third_of_all_rows(spark, register):
    filed = spark.range(3000).select(
        F.col("id").cast("string").alias("key"),
        F.when(F.col("id") % 3 == 0, ZEROS).when(F.col("id") % 3 == 1, WRONG).otherwise(GOOD[3]).alias("lei"))
    got = {r.lei: r["count"] for r in edges.admit_identifiers(filed, register).groupBy("lei").count().collect()}
    assert got == {WRONG: 1000, GOOD[3]: 1000}


def test_registrations_are_typed_and_others_dropped(rows):
    raw = rows(
        "lei string, registered_as string, category string",
        (GOOD[0].lower(), "0000000042", "GENERAL"), (GOOD[1], "S000000001 ", "FUND"), (GOOD[1], "C000000002", None),
        (GOOD[2], "805-12345", "FUND"), (GOOD[2], "", None), (GOOD[2], None, None), (None, "12", None))
    assert rows.of(loads.type_registrations(raw)) == [
        (GOOD[1], "class", "C000000002", None), (GOOD[1], "series", "S000000001", "FUND"), (GOOD[0], "cik", "42", "GENERAL")]


def test_official_edges_win_and_repeats_collapse(rows):
    registrations = rows("lei string, key_type string, key string, category string",
                         (GOOD[0], "cik", "1", "GENERAL"), (GOOD[0], "cik", "1", None), (GOOD[1], "series", "S1", None))
    resolved = rows("cik string, lei string, method string, status string, match_probability double",
                    ("0001", GOOD[2], "exact_name", "confirmed", 0.9), ("0002", GOOD[2].lower(), "jaro_winkler", "candidate", 0.3),
                    ("2", GOOD[2], "exact_name", "confirmed", 0.8), ("3", GOOD[3], "jaro_winkler", "rejected", 0.1),
                    ("S1", GOOD[3], "x", "rejected", 0.1))
    tiered = edges.tier_edges(registrations, claims(rows, ("1", GOOD[0]), ("9", GOOD[3])), claims(rows, ("S1", GOOD[1])), resolved)
    assert rows.of(tiered) == [
        ("cik", "1", GOOD[0], "GENERAL", "sec-registration", "authoritative", 1.0),
        ("cik", "2", GOOD[2], None, "exact_name", "confirmed", 0.8),
        ("cik", "9", GOOD[3], "FUND", "sec-ncen", "authoritative", 1.0),
        ("series", "S1", GOOD[1], None, "sec-registration", "authoritative", 1.0)]


def test_enrichment_fans_nothing_out(rows, register, universe):
    tiered = rows(
        "key_type string, key string, lei string, category string, method string, tier string, confidence double",
        ("cik", "1", GOOD[0], None, "exact_name", "confirmed", 0.12345678), ("series", "1", GOOD[1], "FUND", "m", "authoritative", 1.0),
        ("cik", "2", GOOD[3], None, "m", "candidate", 0.5))
    got = edges.enrich_edges(tiered, register, universe, "2026-01-15")
    assert [str(r[0]) for r in got.select("as_of").distinct().collect()] == ["2026-01-15"]
    assert rows.of(got, "key_type", "key", "ticker", "company_name", "legal_name", "category", "reg_status", "confidence", "corpus") == [
        ("cik", "1", "A,B", "APPLE CORP", "Apple Société", "GENERAL", "ISSUED", 0.123457, f"apple corp apple societe a,b {GOOD[0].lower()}"),
        ("cik", "2", None, "NO TICKER", None, "GENERAL", None, 0.5, f"no ticker {GOOD[3].lower()}"),
        ("series", "1", None, "Fund", "Fund", "FUND", "LAPSED", 1.0, f"fund fund {GOOD[1].lower()}")]
    assert edges.enrich_edges(tiered, register, universe, "").first().as_of is None


def test_the_gate_passes_good_edges_and_stops_bad_ones(rows, register):
    good = rows("key_type string, key string, lei string", ("cik", "1", GOOD[0]), ("cik", "2", WRONG), ("cik", "3", GOOD[3]))
    assert edges.require_identifiers(good, register).count() == 3
    assert tuple(edges.gate_report(good, register).first()) == (0, 0, "")
    bad = good.union(rows("a string, b string, c string", ("cik", "4", ZEROS), ("cik", "5", ZEROS), ("cik", "6", "x-"), ("cik", "7", None)))
    report = edges.gate_report(bad, register).first()
    assert (report.edges, report.distinct_ids, report.examples) == (4, 3, f"{ZEROS}, x-")
    with pytest.raises(edges.GateError, match=ZEROS):
        edges.require_identifiers(bad, register)


def test_gate_shows_the_first_five(rows, register):
    bad = rows("key string, lei string", *[(str(n), f"BAD-{n}") for n in range(9)])
    assert edges.gate_report(bad, register).first().examples == "BAD-0, BAD-1, BAD-2, BAD-3, BAD-4"


def test_excluded_keys(rows):
    source = rows("key_type string, key string", ("cik", "1"), ("cik", "2"), ("cik", "2"), ("series", " "), ("series", "1"), ("cik", None))
    carried = rows("key_type string, key string, lei string", ("cik", "1", "x"))
    assert rows.of(edges.excluded_keys([source, source], carried)) == [("cik", "2"), ("series", "1")]


def test_universe_takes_one_ticker(rows):
    names = rows("cik string, company_name string", ("1", "A"), ("1", "B"), ("2", "C"))
    tickers = rows("cik int, ticker string, exchange string", (1, "Z", "N"), (1, "Y", "Q"))
    assert rows.of(loads.entity_universe(names, tickers)) == [("1", "A", "Y", "N"), ("1", "B", "Y", "N"), ("2", "C", None, None)]


def test_best_per_key_is_a_total_order(rows):
    frame = rows("k int, p double, i int, v string", (1, 2.0, 9, "a"), (1, 5.0, 8, "b"), (1, 5.0, 7, "c"), (2, 1.0, 1, "d"))
    assert rows.of(edges.best_per_key(frame, ["k"], [("p", True), ("i", False)], ["v"])) == [(1, "c"), (2, "d")]


def test_nulls_come_last_in_either_direction(rows):
    frame = rows("k int, p double, d date, v string", (1, None, None, "none"), (1, 5.0, None, "five"), (1, 7.0, None, "seven"))
    assert rows.of(edges.best_per_key(frame, ["k"], [("p", True)], ["v"])) == [(1, "seven")]
    assert rows.of(edges.best_per_key(frame, ["k"], [("p", False)], ["v"])) == [(1, "five")]
    assert rows.of(edges.best_per_key(frame, ["k"], [("d", True), ("p", True)], ["v"])) == [(1, "seven")]


def test_keys_are_admitted_in_one_form(rows):
    good = "529900T8BM49AURSDO55"
    filings = rows("key string, lei string", ("0000000012", good), (" 12 ", good), ("", good), ("  ", good), (None, good), ("S000000012", good), ("12", None))
    register = rows("lei string", ("x",))
    assert rows.of(edges.admit_identifiers(filings, register), "key") == [("12",), ("S000000012",)]
