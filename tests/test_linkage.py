"""Linkage against a brute force over all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from concordat.functions.similarity import jaro_winkler
from concordat.operators import linkage
from test_functions import plain_jaro_winkler

STEMS = ["Acme Holdings", "Acme Holding", "Acme Holdngs Group", "Société Générale", "Societe Generale Intl", "The Big Bank", "The Big Banks",
         "Alpha Beta Gamma", "Alpha Beta Gamme", "Zed", "Zed Co", "Straße Bau", "Strasse Bau GmbH", "Łódź Works", "A", "Oméga-Trust, Inc."]


def entities(seed, count, register):
    rng = random.Random(seed)
    out = []
    for at in range(count):
        name = rng.choice(STEMS)
        if rng.random() < 0.6:
            cut = rng.randrange(len(name))
            name = name[:cut] + rng.choice("aeio ") + name[cut + rng.randint(0, 1):]
        if rng.random() < 0.2:
            name += rng.choice([" Inc.", " LTD", " co. ltd", " plc"])
        row = (f"{'r' if register else 'l'}{at:03d}", name, rng.choice(["us", "de"]))
        out.append(row + (rng.choice(["ISSUED", "LAPSED", "RETIRED", "OTHER"]), rng.choice(["US", "XX"])) if register else row)
    return out


def brute_force(left, register):
    """The same result by comparing every pair that shares a block."""

    def keys(country, name):
        word = name.split(" ")[0]
        found = {(country, "prefix", name[:6])}
        return found | ({(country, "word", word)} if word not in linkage.STOPWORDS else set())

    rank = {s: n for n, s in enumerate(linkage.STATUS_RANK)}
    out = set()
    for ident, name, country in left:
        options = []
        for other_id, other, other_country, status, jurisdiction in register:
            if name == other and country == other_country:
                level, score = 0, 1.0
            elif keys(country, name) & keys(other_country, other):
                score = round(plain_jaro_winkler(name, other), 9)
                if score < linkage.NEAR:
                    continue
                level = 1 if score >= linkage.CLOSE else 2
            else:
                continue
            options.append((level, -score, rank.get(status, 3), jurisdiction != "US", other_id))
        if options:
            level, _, _, _, match = min(options)
            equal = sum(o[0] == 0 for o in options)
            status = "candidate" if level else ("confirmed" if equal == 1 else "ambiguous")
            out.add((ident, match, "jaro_winkler" if level else "exact_name", status))
    return out


@pytest.fixture
def sides(rows):
    left = rows("id string, name string, country string", *entities(1, 150, False))
    register = rows("id string, name string, country string, status string, jurisdiction string", *entities(2, 150, True))
    return linkage.named(left), linkage.named(register)


@pytest.mark.parametrize("tile", [1000, 3])
def test_resolution_equals_brute_force_with_and_without_hot_blocks(sides, monkeypatch, tile):
    monkeypatch.setattr(linkage, "TILE", tile)
    left, register = sides
    got = {tuple(r)[:4] for r in linkage.resolve_entities(left, register).collect()}
    expected = brute_force([tuple(r) for r in left.select("id", "name", "country").collect()],
                           [tuple(r) for r in register.select("id", "name", "country", "status", "jurisdiction").collect()])
    assert got == expected
    assert {g[3] for g in got} == {"confirmed", "candidate", "ambiguous"}


def test_every_pair_of_a_tiled_block_meets_once(spark, monkeypatch):
    monkeypatch.setattr(linkage, "TILE", 7)
    left = spark.range(40).select(F.lit("k").alias("block"), F.concat(F.lit("l"), "id").alias("name"))
    right = spark.range(25).select(F.lit("k").alias("block"), F.concat(F.lit("r"), "id").alias("name"))
    a, b = linkage._tiles(left, right, ["block"])
    met = a.alias("a").join(b.alias("b"), ["block", "row", "col"]).select("a.name", F.col("b.name").alias("other"))
    assert met.count() == met.distinct().count() == 1000
    assert a.groupBy("row", "col").count().agg(F.max("count")).first()[0] < 20


def test_pairs_are_counted_not_formed(sides):
    left, register = sides
    counted = linkage.block_pairs(left, register)
    l, r = linkage.block_keys(left.select("country", "name").distinct()), linkage.block_keys(register.select("country", "name").distinct())
    formed = l.alias("l").join(r.alias("r"), linkage.BLOCK).groupBy(*linkage.BLOCK).count()
    assert {tuple(x) for x in counted.select(*linkage.BLOCK, "pairs").collect()} == {tuple(x) for x in formed.collect()}


def test_names_are_normalised(rows):
    frame = rows("name string", ("  Oméga-Trust, Inc. ",), ("ACME CO. LTD",), ("Straße & Søn",), ("Inc",), ("The Company",))
    got = [r[0] for r in frame.select(linkage.normal_name(F.col("name"))).collect()]
    assert got == ["omega trust", "acme", "strasse son", "inc", "the"]


def test_probabilities_follow_the_weights():
    p = {level: linkage.probability(level) for level in linkage.AGREEMENT}
    assert 0.95 < p["exact"] < 1 and p["exact"] > p["close"] > p["near"] > 0
    assert linkage.weight("exact") == pytest.approx(6.228963, abs=1e-6)


def test_a_name_shared_by_a_third_of_all_rows(spark, rows):
    left = spark.range(3000).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 3 == 0, "hot name").otherwise(F.concat(F.lit("cold "), "id")).alias("name"), F.lit("us").alias("country"))
    register = rows("id string, name string, country string, status string, jurisdiction string",
                    ("r2", "Hot Name", "us", "LAPSED", "US"), ("r1", "hot name", "us", "ISSUED", "XX"), ("r0", "hot name", "de", "ISSUED", "US"))
    got = linkage.resolve_entities(linkage.named(left), linkage.named(register))
    assert [tuple(r) for r in got.groupBy("lei", "status").count().collect()] == [("r1", "ambiguous", 1000)]


def test_short_cuts_never_drop_a_near_pair(spark):
    """Lengths, letters and bands let every pair through that reaches the threshold."""
    from test_functions import some_names

    rng = random.Random(5)
    names = sorted({n.strip() for n in some_names(60, 4) if n.strip()} | {"q", "ab", "abc", "中国 bank", "日本 bank", "x1 y2", "x1 y3"})
    near = [(a, b) for a in names for b in names if plain_jaro_winkler(a, b) >= linkage.NEAR]
    far = [(rng.choice(names), rng.choice(names)) for _ in range(300)]
    frame = spark.createDataFrame([(*p, p in near) for p in near + far], "a string, b string, near boolean")
    ratio = linkage.least_length_ratio(linkage.NEAR)

    def side(column, alias):
        own = frame.select("a", "b", "near", F.col(column).alias("name"))
        return own.select("a", "b", "near", F.length("name").alias("length"), linkage._letters(F.col("name")).alias("letters"),
                          linkage._length_band(ratio).alias("band")).distinct().alias(alias)

    met = side("a", "l").join(side("b", "r"), [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("a", "b", "near")])
    kept = met.select(F.col("l.near").alias("near"), linkage._may_be_near("l", "r").alias("may"),
                      (F.abs(F.col("l.band") - F.col("r.band")) <= 1).alias("band")).collect()
    assert all(r.may and r.band for r in kept if r.near)
    assert any(not r.may for r in kept)


def test_a_home_entity_beats_an_unknown_jurisdiction(rows):
    register = rows("country string, name string, id string, status string, jurisdiction string",
                    ("x", "acme", "r1", "ISSUED", None), ("x", "acme", "r2", "ISSUED", linkage.HOME))
    assert linkage.register_names(register).first().winner.id == "r2"


def test_the_similarity_is_that_of_the_match(rows):
    names = rows("id string, country string, name string", ("l", None, "international business machines"))
    register = rows("id string, country string, name string, status string, jurisdiction string",
                    ("a", None, "international business machine", None, None), ("b", None, "international business machinez", "ISSUED", linkage.HOME))
    got = linkage.link_scores(linkage.named(names), linkage.named(register)).first()
    both = {r.id: r.s for r in register.select("id", F.round(jaro_winkler("name", F.lit("international business machines")), 6).alias("s")).collect()}
    assert got.similarity == both[got.match] == max(both.values())
