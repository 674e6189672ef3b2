"""Weights of the name model, estimated from the data instead of frozen.

The model of Fellegi and Sunter with several comparisons: each pair of names shows a pattern of
agreement levels, and expectation-maximisation finds how often each level falls on matches (m) and
on chance pairs (u), and the share of pairs that match. It works on counts of patterns: a table
of a dozen rows, whatever the number of pairs.

Pairs are those that share a block. They are counted, not formed: pairs that agree on a block
and on some attributes are the products of group sizes, inclusion and exclusion takes out what two blocks
share and splits agreement from disagreement. Only pairs of names that are near are formed, as the linkage forms
them; all others of a pattern are what is left.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staged
from . import linkage
from .linkage import NAME

# The comparisons and where their estimation starts: shares of matches by level.
START = {
    "name": {"exact": 0.6, "close": 0.2, "near": 0.1, "else": 0.1},
    "tail": {"same": 0.9, "else": 0.1},
    "words": {"same": 0.9, "else": 0.1},
}
ATTRIBUTES = [c for c in START if c != "name"]
START_PRIOR = 0.05
LEAST = 1e-9
ROUNDS = 25


@dataclass
class Model:
    """Shares by comparison and level, and the share of pairs that match."""

    prior: float = START_PRIOR
    m: dict[str, dict[str, float]] = field(default_factory=lambda: {c: dict(x) for c, x in START.items()})
    u: dict[str, dict[str, float]] = field(default_factory=dict)

    def weight(self, comparison: str, level: str) -> float:
        """log2 of how much more often a match shows the level than a chance pair does."""
        return math.log2(self.m[comparison][level] / self.u[comparison][level])


def attributes(name: Column) -> dict[str, Column]:
    """What is compared beside the name as a whole: its last word, and how many words it has."""
    return {"tail": F.substring_index(name, " ", -1), "words": F.size(F.split(name, " ")).cast("string")}


def block_totals(names: DataFrame, register: DataFrame) -> DataFrame:
    """One row: how many pairs share a block, and how many of those agree on each set of attributes.

    Columns `same_0` to `same_3`: bit i of the number asks for agreement on attribute i. Either side is
    reduced to one row a key before they meet, so a hot block is a product, not a join of its names.
    """
    word, lead = F.substring_index("name", " ", 1), F.substring("name", 1, linkage.PREFIX)
    word = F.when(~word.isin(linkage.STOPWORDS), word)
    rules = [(1, "prefix", lead), (1, "word", word), (-1, "both", F.concat(lead, F.lit("\n"), word))]
    kinds = F.array(*[F.struct(F.lit(s).alias("sign"), F.lit(r).alias("rule"), b.alias("block")) for s, r, b in rules])
    wanted = range(1 << len(ATTRIBUTES))

    def counted(side: DataFrame, count: str) -> DataFrame:
        rows = side.select("country", F.inline(kinds), *[x.alias(c) for c, x in attributes(F.col("name")).items()])
        rows = rows.where("block is not null").groupBy("country", "sign", "rule", "block", *ATTRIBUTES).agg(F.count(F.lit(1)).alias("n"))
        sets = F.explode(F.array(*map(F.lit, wanted))).alias("wanted")
        kept = [F.when(F.col("wanted").bitwiseAND(F.lit(1 << i)) != 0, F.col(c)).otherwise("").alias(c) for i, c in enumerate(ATTRIBUTES)]
        rows = rows.select("*", sets).select("country", "sign", "rule", "block", "wanted", "n", *kept)
        return rows.groupBy("country", "sign", "rule", "block", "wanted", *ATTRIBUTES).agg(F.sum("n").alias(count))

    met = counted(names, "l").join(counted(register, "r"), ["country", "sign", "rule", "block", "wanted", *ATTRIBUTES])
    pairs = F.col("sign") * F.col("l") * F.col("r")
    return met.agg(*[F.coalesce(F.sum(F.when(F.col("wanted") == k, pairs)), F.lit(0)).alias(f"same_{k}") for k in wanted])


def compared_pairs(names: DataFrame, register: DataFrame) -> DataFrame:
    """Every pair that is equal or near, with its level in each comparison and the register's winner.

    `names` are distinct names of one side, `register` is as `linkage.register_names` returns it.
    """
    equal = names.join(register, NAME).select(
        *NAME, F.col("name").alias("other"), "winner", F.lit(1.0).alias("similarity"), F.lit("exact").alias("level")
    )
    near = linkage.near_pairs(names, register).where("name != other").select(*NAME, "other", "winner", "similarity", "level")
    pairs = equal.unionByName(near)
    mine, theirs = attributes(F.col("name")), attributes(F.col("other"))
    same = {c: F.when(mine[c] == theirs[c], "same").otherwise("else") for c in ATTRIBUTES}
    return pairs.withColumns(same)


def pattern_counts(names: DataFrame, register: DataFrame, pairs: DataFrame) -> DataFrame:
    """(name, tail, words, pairs): how many pairs that share a block show each pattern of levels."""
    totals = block_totals(names.select(*NAME), register.select(*NAME))
    formed = pairs.groupBy(F.col("level").alias("level"), *ATTRIBUTES).agg(F.count(F.lit(1)).alias("pairs"))
    every = []
    for levels in itertools.product(("else", "same"), repeat=len(ATTRIBUTES)):
        own = sum(1 << i for i, level in enumerate(levels) if level == "same")
        # Exactly these agree: those with at least these, less those with more, and so on.
        terms = [
            (-1) ** bin(k ^ own).count("1") * F.col(f"same_{k}") for k in range(1 << len(levels)) if k & own == own
        ]
        every.append(F.struct(*[F.lit(x).alias(c) for c, x in zip(ATTRIBUTES, levels)], sum(terms[1:], terms[0]).alias("pairs")))
    whole = totals.select(F.inline(F.array(*every))).withColumn("level", F.lit("else"))
    less = formed.select(*ATTRIBUTES, (-F.col("pairs")).alias("pairs"), F.lit("else").alias("level"))
    rest = whole.unionByName(less).groupBy("level", *ATTRIBUTES).agg(F.sum("pairs").alias("pairs"))
    return formed.unionByName(rest).where("pairs > 0").withColumnRenamed("level", "name")


def estimate(patterns: DataFrame, rounds: int = ROUNDS) -> Model:
    """The model after `rounds` rounds of expectation and maximisation; the driver holds one row a pattern.

    Only levels that occur have shares. No pair at all leaves nothing to learn from, and is an error.
    """
    rows = [({c: r[c] for c in START}, float(r["pairs"])) for r in patterns.collect()]
    total = sum(n for _, n in rows)
    if not total:
        raise ValueError("no two names share a block")
    model = Model()
    for c in START:
        present = {x[c] for x, _ in rows}
        model.m[c] = {level: share for level, share in START[c].items() if level in present}
        model.u[c] = {level: sum(n for x, n in rows if x[c] == level) / total for level in model.m[c]}
    for _ in range(rounds):
        matches = []
        for x, n in rows:
            a = model.prior * math.prod(model.m[c][x[c]] for c in START)
            b = (1 - model.prior) * math.prod(model.u[c][x[c]] for c in START)
            matches.append(n * a / (a + b))
        found = sum(matches)
        model.prior = found / total
        for c in START:
            for level in model.m[c]:
                own = [(n, g) for (x, n), g in zip(rows, matches) if x[c] == level]
                model.m[c][level] = max(sum(g for _, g in own) / found, LEAST)
                model.u[c][level] = max(sum(n - g for n, g in own) / (total - found), LEAST)
    return model


def model_table(spark: SparkSession, model: Model) -> DataFrame:
    """The model as rows: comparison, level, m, u and weight; the prior stands as a comparison of its own."""
    rows = [
        (c, level, round(model.m[c][level], 6), round(model.u[c][level], 6), round(model.weight(c, level), 4))
        for c in model.u for level in model.m[c]
    ]
    rows.append(("prior", "match", round(model.prior, 6), round(1 - model.prior, 6), round(math.log2(model.prior / (1 - model.prior)), 4)))
    return spark.createDataFrame(rows, "comparison string, level string, m double, u double, weight double")


def posterior(model: Model, levels: dict[str, str]) -> Column:
    """Chance that a pair is a match, from the columns that hold its levels."""
    weights = [linkage.per_level(F.col(levels[c]), {x: model.weight(c, x) for x in model.m[c]}) for c in START]
    odds = F.pow(F.lit(2.0), sum(weights, F.lit(math.log2(model.prior / (1 - model.prior)))))
    return odds / (1 + odds)


def learned(left: DataFrame, register: DataFrame, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model that two sides (as `linkage.named` returns them) teach, and their compared pairs."""
    theirs = staged(linkage.register_names(register), "register_names")
    names = staged(left.select(*NAME).distinct(), "names")
    pairs = staged(compared_pairs(names, theirs), "compared")
    return estimate(pattern_counts(names, theirs, pairs), rounds), pairs


def estimated_links(left: DataFrame, register: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """For each name the pair of greatest posterior, then similarity, then the register's order of winners."""
    model, pairs = learned(left, register, rounds)
    scored = pairs.withColumn("p", F.round(posterior(model, {"name": "level", **{c: c for c in ATTRIBUTES}}), 6))
    best = F.min(F.struct((-F.col("p")).alias("p"), (-F.col("similarity")).alias("far"), "winner", "level", *ATTRIBUTES)).alias("best")
    return scored.groupBy(*NAME).agg(best).select(
        *NAME, "best.level", *[f"best.{c}" for c in ATTRIBUTES], F.round(-F.col("best.far"), 6).alias("similarity"),
        F.col("best.winner.id").alias("match"), (-F.col("best.p")).alias("match_probability"),
    )
