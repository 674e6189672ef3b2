"""Name linkage: normalise, block, compare, weigh, choose (Fellegi and Sunter 1969).

Both sides are reduced to distinct (country, name) before anything is compared, so a name
that many entities share costs one comparison. Equal names meet in an equi-join. Only names
without an equal go on to the fuzzy comparison, inside blocks.

Columns of either side: `id`, `name`, `country`; of the register side also `status` and
`jurisdiction`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import jaro_winkler, least_length_ratio, least_matches
from ..functions.text import once, strip_accents
from ..session import staged

# Fixed values of the frozen model: levels of agreement on the name, how often a true
# match and a chance pair fall in each, and the share of pairs that match at all.
CLOSE = 0.95
NEAR = 0.92
PRIOR = 1e-4
AGREEMENT = {
    "exact": (0.75, 1e-6),
    "close": (0.15, 5e-6),
    "near": (0.07, 2e-5),
}
# Legal forms that end a name and say nothing about whose it is.
LEGAL_FORMS = [
    "ag", "bv", "co", "company", "corp", "corporation", "gmbh", "inc", "incorporated",
    "limited", "llc", "llp", "lp", "ltd", "nv", "plc", "sa", "sarl", "se", "spa",
]
# First words too common to block on.
STOPWORDS = ["a", "an", "and", "das", "de", "der", "die", "el", "en", "in", "la", "le", "les", "los", "of", "the", "to"]
# Letters that carry no accent mark and are spelled out instead.
SPELLED_OUT = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d"}
# Which register entry wins among equals.
STATUS_RANK = ["ISSUED", "LAPSED", "RETIRED"]
HOME = "US"

PREFIX = 6
# Letters counted apart when a pair's common characters are bounded.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
# A block with more names than this on a side is compared in tiles of this many names.
TILE = 1000
BLOCK = ["country", "rule", "block"]
NAME = ["country", "name"]


def normal_name(text: Column) -> Column:
    """A name ready to compare: lower case, no accents, no punctuation, no legal form."""
    plain = strip_accents(F.lower(text))
    for letter, spelled in SPELLED_OUT.items():
        plain = F.replace(plain, F.lit(letter), F.lit(spelled))
    words = F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " "))
    return F.regexp_replace(words, rf"(?: (?:{'|'.join(LEGAL_FORMS)}))+\z", "")


def weight(level: str) -> float:
    """log2 odds that a pair at this level matches."""
    m, u = AGREEMENT[level]
    return math.log2(PRIOR / (1 - PRIOR)) + math.log2(m / u)


def probability(level: str) -> float:
    odds = 2.0 ** weight(level)
    return round(odds / (1 + odds), 6)


def per_level(level: Column, values: dict[str, float]) -> Column:
    out = F.lit(None).cast("double")
    for name, value in values.items():
        out = F.when(level == name, F.lit(value)).otherwise(out)
    return out


def named(entities: DataFrame) -> DataFrame:
    """Entities under their normal name; those without a name are left out.

    Names meet within a country. The dimension is optional: where a side has no such column,
    drop it on the other, and all names meet; unknown countries meet each other.
    """
    country = F.coalesce(F.col("country"), F.lit("")) if "country" in entities.columns else F.lit("")
    return entities.withColumns({"name": normal_name(F.col("name")), "country": country}).where(F.col("name") != "")


def register_names(register: DataFrame) -> DataFrame:
    """Distinct register names, how many entities share each, and the one that wins.

    Current registrations go first, then home entities, an unknown jurisdiction being abroad,
    then the smallest identifier.
    """
    rank = F.lit(len(STATUS_RANK))
    for place, status in reversed(list(enumerate(STATUS_RANK))):
        rank = F.when(F.col("status") == status, place).otherwise(rank)
    first = F.struct(
        rank.alias("rank"), (~F.col("jurisdiction").eqNullSafe(HOME)).cast("int").alias("abroad"), F.col("id").alias("id")
    )
    return register.groupBy(*NAME).agg(F.count(F.lit(1)).alias("entities"), F.min(first).alias("winner"))


def block_keys(names: DataFrame) -> DataFrame:
    """Each name once per block it falls in: its first characters, all of a short one, and its first word."""
    word = F.substring_index("name", " ", 1)
    lead = F.substring("name", 1, PREFIX)
    keys = F.array(
        F.struct(F.lit("prefix").alias("rule"), lead.alias("block")),
        F.struct(F.lit("word").alias("rule"), F.when(~word.isin(STOPWORDS), word).alias("block")),
    )
    return (
        names.withColumn("key", F.explode(keys))
        .where(F.col("key.block").isNotNull())
        .select("*", "key.rule", "key.block")
        .drop("key")
    )


def block_pairs(left: DataFrame, register: DataFrame) -> DataFrame:
    """Names per side and candidate pairs per block, counted without forming a pair.

    `left` and `register` are as returned by `named`.
    """

    def sizes(names: DataFrame, count: str) -> DataFrame:
        return block_keys(names.select(*NAME).distinct()).groupBy(*BLOCK).agg(F.count(F.lit(1)).alias(count))

    return (
        sizes(left, "left_names")
        .join(sizes(register, "register_names"), BLOCK)
        .withColumn("pairs", F.col("left_names") * F.col("register_names"))
    )


def _length_band(ratio: float) -> Column:
    """Names whose lengths differ by no more than `ratio` fall in this band or the next."""
    return F.floor(F.log(F.length("name").cast("double")) / F.lit(math.log(1 / ratio))).cast("int")


def _letters(name: Column) -> Column:
    """How often a name has each letter, and how many other characters it has."""
    length = F.length(name)
    counts = [length - F.length(F.replace(name, F.lit(letter), F.lit(""))) for letter in LETTERS]
    other = F.length(F.translate(name, LETTERS, ""))
    return F.struct(*[n.alias(letter) for n, letter in zip(counts, LETTERS)], other.alias("other"))


def _may_be_near(left: str, right: str) -> Column:
    """Whether lengths and letters leave room for the threshold; never false for a near pair.

    Only characters that both names have can match, and each as often as both have it.
    """
    common = sum((F.least(f"{left}.letters.{c}", f"{right}.letters.{c}") for c in [*LETTERS, "other"]), F.lit(0))
    a, b = F.col(f"{left}.length"), F.col(f"{right}.length")
    slack = 1e-6
    return (F.least(a, b) >= least_length_ratio(NEAR) * F.greatest(a, b) - slack) & (
        common >= least_matches(NEAR) * a * b / (a + b) - slack
    )


def _tiles(left: DataFrame, right: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with a tile number, so that a hot block becomes many small ones.

    A block is cut into a grid: every left row falls in one grid row and is copied to
    each grid column, every right row the other way round, and each pair meets in exactly
    one tile. Blocks within the limit stay one tile. The number of hot blocks is at most
    the number of names over the limit.
    """
    l_size = left.groupBy(*on).agg(F.count(F.lit(1)).alias("l"))
    r_size = right.groupBy(*on).agg(F.count(F.lit(1)).alias("r"))
    hot = (
        l_size.join(r_size, on)
        .where((F.col("l") > TILE) | (F.col("r") > TILE))
        .select(*on, F.ceil(F.col("l") / TILE).alias("down"), F.ceil(F.col("r") / TILE).alias("across"))
    )
    own = lambda n: F.pmod(F.xxhash64("name"), F.coalesce(n, F.lit(1)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.coalesce(n, F.lit(1)) - 1))
    l_tiled = left.join(hot, on, "left").select(
        *left.columns, own(F.col("down")).alias("row"), every(F.col("across")).alias("col")
    )
    r_tiled = right.join(hot, on, "left").select(
        *right.columns, own(F.col("across")).alias("col"), every(F.col("down")).alias("row")
    )
    return l_tiled, r_tiled


def near_pairs(names: DataFrame, register: DataFrame) -> DataFrame:
    """Every pair of a name and a register name that share a block and are near, equal names included.

    Sound short cuts keep the block from being compared whole: the block key carries a
    length band outside of which the threshold cannot be reached; the join itself lets
    through only pairs whose lengths and letters leave room for it, and a pair that shares
    both blocks in the first only. What is left is compared where it is formed.
    """
    ratio = least_length_ratio(NEAR)
    on = [*BLOCK, "band"]
    left = block_keys(names.select(*NAME)).withColumn("band", _length_band(ratio))
    right = block_keys(register).select(
        *BLOCK,
        F.explode(F.array(*[_length_band(ratio) + step for step in (-1, 0, 1)])).alias("band"),
        "name",
        "winner",
    )
    left, right = _tiles(left, right, on)
    # Comparing is much work on few bytes, so the tiles are dealt out over a set number of
    # tasks; left to itself, adaptive execution would join small partitions into few.
    tile = [*on, "row", "col"]
    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    measures = {"length": F.length("name"), "letters": _letters(F.col("name"))}
    left, right = (side.repartition(tasks, *tile).withColumns(measures) for side in (left, right))
    lead_l, lead_r = F.substring("l.name", 1, PREFIX), F.substring("r.name", 1, PREFIX)
    first_time = (F.col("l.rule") == "prefix") | (lead_l != lead_r)
    same_tile = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in tile]
    return (
        left.alias("l")
        .join(right.alias("r"), [*same_tile, first_time, _may_be_near("l", "r")])
        .select(F.col("l.country").alias("country"), F.col("l.name").alias("name"), F.col("r.name").alias("other"), "winner")
        .withColumn("similarity", once(F.round(jaro_winkler("name", "other"), 9)))
        .where(F.col("similarity") >= NEAR)
        .withColumn("level", F.when(F.col("similarity") >= CLOSE, "close").otherwise("near"))
    )


def near_names(names: DataFrame, register: DataFrame) -> DataFrame:
    """For each name without an equal, the best register name that is near to it, reduced to
    one row per name before any shuffle."""
    pairs = near_pairs(names, register)
    # "close" sorts before "near"; then the nearest; then the tie-break that equal names use.
    best = F.min(F.struct("level", (-F.col("similarity")).alias("far"), "winner")).alias("best")
    return pairs.groupBy(*NAME).agg(best).select(
        *NAME, "best.level", F.round(-F.col("best.far"), 6).alias("similarity"), F.col("best.winner.id").alias("match")
    )


def link_scores(left: DataFrame, register: DataFrame) -> DataFrame:
    """One row per linked left name: level, weight, probability and the winning entity.

    `left` and `register` are as returned by `named`. Distinct names are staged: blocking
    reads them several times, and the texts they were taken from are read only once.
    """
    theirs = staged(register_names(register), "register_names")
    names = staged(left.select(*NAME).distinct().join(theirs, NAME, "left"), "names")
    equal = names.where(F.col("winner").isNotNull()).select(
        *NAME,
        F.lit("exact").alias("level"),
        F.lit(1.0).alias("similarity"),
        F.col("winner.id").alias("match"),
        "entities",
    )
    alone = names.where(F.col("winner").isNull()).select(*NAME)
    near = near_names(alone, theirs).withColumn("entities", F.lit(1).cast("bigint"))
    return equal.unionByName(near).withColumns(
        {
            "weight": per_level(F.col("level"), {k: round(weight(k), 6) for k in AGREEMENT}),
            "match_probability": per_level(F.col("level"), {k: probability(k) for k in AGREEMENT}),
        }
    )


def resolve_entities(left: DataFrame, register: DataFrame) -> DataFrame:
    """The best register entity of each left entity that has one.

    An equal name held by one entity is confirmed, by several ambiguous; a near name is a
    candidate. The scores hold one row per name, so a name that very many left entities
    share is a hot key on one side only and can be split. The left side is staged under
    its normal names, as it is read for its distinct names and again for its rows.
    """
    left = staged(left.select("id", *NAME), "filers")
    scored = link_scores(left, register)
    exact = F.col("level") == "exact"
    status = (
        F.when(exact & (F.col("entities") == 1), "confirmed").when(exact, "ambiguous").otherwise("candidate")
    )
    return left.join(scored, NAME).select(
        F.col("id").alias("cik"),
        F.col("match").alias("lei"),
        F.when(exact, "exact_name").otherwise("jaro_winkler").alias("method"),
        status.alias("status"),
        "match_probability",
    )
