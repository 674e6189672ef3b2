"""Expressions against independent implementations."""

import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.functions import identifiers, similarity, text

VALID = ["5493001KJTIIGC8Y1R12", "529900T8BM49AURSDO55", "213800WSGIIZCXF1P572", "HWUPKR0MPOU8FGXBT394"]


def remainder(value):
    """The standard's own arithmetic, over whole numbers of any size."""
    if not value or any(c not in "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in value):
        return None
    return int("".join(str(int(c, 36)) for c in value)) % 97


def test_mod97_agrees_with_whole_number_arithmetic(rows):
    rng = random.Random(7)
    letters = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    values = VALID + ["0" * 20, "2549OOXU4138OHZ4BG72", "6GG1425B5X0SPG36P158", "579100JDDBCKJJEJC031", "", "A", "52990-T8BM49AURSDO55"]
    values += ["".join(rng.choices(letters, k=rng.randint(1, 40))) for _ in range(300)]
    got = rows("v string", *[(v,) for v in values]).select("v", identifiers.mod97(F.col("v"))).collect()
    assert [r[1] for r in got] == [remainder(v) for v in values]


def test_fixture_identifiers(rows):
    known = {"0" * 20: 0, "2549OOXU4138OHZ4BG72": 64, "6GG1425B5X0SPG36P158": 88, "579100JDDBCKJJEJC031": 62}
    got = rows("v string", *[(v,) for v in known]).select("v", identifiers.mod97(F.col("v"))).collect()
    assert {r[0]: r[1] for r in got} == known


def test_check_digits_ignore_case_and_padding_and_fail_closed(rows):
    good = VALID[1]
    values = [good, good.lower(), f"  {good} ", None, "", good[:-1], good[:-1] + "4", good.replace("0", "O")]
    got = rows("v string", *[(v,) for v in values]).select(identifiers.check_digits_hold(F.col("v"))).collect()
    assert [r[0] for r in got] == [True, True, True, False, False, False, False, False]


def test_with_check_digits_always_holds(spark):
    base = F.concat(F.lit("529900Q"), F.lpad(F.col("id").cast("string"), 11, "0"))
    made = spark.range(500).select(identifiers.with_check_digits(base).alias("v"))
    assert all(len(r.v) == 20 and remainder(r.v) == 1 for r in made.collect())


def test_unpad(rows):
    got = rows("v string", ("007",), (" 12 ",), ("0",)).select(identifiers.unpad(F.col("v"))).collect()
    assert [r[0] for r in got] == ["7", "12", "0"]


def test_strip_accents_follows_the_unicode_rule(spark):
    chars = [chr(c) for c in range(0x20, 0x2FFF) if unicodedata.category(chr(c)) not in ("Cs", "Cn")]

    def rule(value):
        kept = "".join(p for p in unicodedata.normalize("NFD", value) if not unicodedata.category(p).startswith("M"))
        return unicodedata.normalize("NFC", kept)

    frame = spark.createDataFrame([(c,) for c in chars], "v string")
    got = frame.select("v", text.strip_accents(F.col("v")).alias("s")).collect()
    wrong = [(r.v, r.s) for r in got if r.s != rule(r.v)]
    assert not wrong
    assert {c: r for c, r in [(x.v, x.s) for x in got] if c in "łøß"} == {"ł": "ł", "ø": "ø", "ß": "ß"}


def test_search_text_skips_null_and_keeps_empty(rows):
    frame = rows("a string, b string, c string", ("Société", None, "X"), ("É", "", "y"))
    assert rows.of(frame.select(text.search_text(*[F.col(c) for c in "abc"]).alias("s"))) == [("e  y",), ("societe x",)]


def test_whole_match_sees_a_trailing_newline(rows):
    frame = rows("v string", ("ABC",), ("ABC\n",), ("xABC",))
    got = frame.select(text.matches_whole(F.col("v"), "^ABC$|^Q$")).collect()
    assert [r[0] for r in got] == [True, False, False]


@pytest.mark.parametrize("value,shown", [(1e-7, "0.0000001"), (0.92, "0.92"), (5.0, "5.0"), (1e9, "1000000000.0"), (-3.25, "-3.25")])
def test_numbers_are_written_without_an_exponent(rows, value, shown):
    frame = rows("v double", (value,))
    assert frame.select(text.as_text(F.col("v"), T.DoubleType())).first()[0] == shown


@pytest.mark.parametrize(
    "count,like,shown",
    [
        (1234, "1,234", "1,234"), (1234, "1234", "1234"), (1235, "1,234", "1,235"), (1234, "1.2K", "1.2K"),
        (1234, "1K", "1K"), (1250, "1.3K", "1.3K"), (1250, "1.2K", "1.3K"), (1500, "2K", "2K"), (1499, "2K", "1K"),
        (3377398, "3.38M", "3.38M"), (3377398, "3.36M", "3.38M"), (3377398, "3M", "3M"), (999999, "1.0M", "1.0M"),
        (12, "0.0K", "0.0K"), (4_000_000_000, "4B", "4B"), (5, "about five", None), (5, "1,23", None), (5, "3.K", None),
    ],
)
def test_a_figure_is_read_at_its_own_precision(rows, count, like, shown):
    frame = rows("n bigint, l string", (count, like))
    assert frame.select(text.written_like(F.col("n"), F.col("l"))).first()[0] == shown


def plain_jaro_winkler(a, b):
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, left = [False] * len(b), []
    for i, char in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == char:
                used[j] = True
                left.append(char)
                break
    right = [c for c, u in zip(b, used) if u]
    if not left:
        return 0.0
    m = len(left)
    swaps = sum(x != y for x, y in zip(left, right)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def some_names(count, seed):
    rng = random.Random(seed)
    words = ["the", "anea", "eriner", "ouié", "ß", "über", "tion", "a", "holdings", "中国", "x" * 70]
    names = []
    for _ in range(count):
        name = " ".join(rng.choice(words) for _ in range(rng.randint(1, 5)))
        cut = rng.randrange(len(name))
        names.append(name[:cut] + rng.choice("abc ") + name[cut + rng.randint(0, 2):])
    return names


def test_jaro_winkler_agrees_with_the_plain_loop(spark):
    left, right = some_names(3000, 1), some_names(3000, 2)
    right[::3] = [n[1:] + n[:1] if len(n) > 1 else n for n in left[::3]]
    got = similarities = similarity.similarities(np.array(left, object), np.array(right, object))
    assert np.allclose(got, [plain_jaro_winkler(a, b) for a, b in zip(left, right)], atol=1e-12)
    frame = spark.createDataFrame(list(zip(left[:50], right[:50])), "a string, b string")
    through = [r[0] for r in frame.select(similarity.jaro_winkler("a", "b")).collect()]
    assert np.allclose(through, similarities[:50])


def test_classic_pairs():
    pairs = {("martha", "marhta"): 0.961111, ("dixon", "dicksonx"): 0.813333, ("dwayne", "duane"): 0.84}
    for (a, b), expected in pairs.items():
        assert abs(similarity.similarities(np.array([a], object), np.array([b], object))[0] - expected) < 1e-6


def test_length_bound_is_sound():
    ratio = similarity.least_length_ratio(0.92)
    names = some_names(400, 3)
    for a in names[:120]:
        for b in names:
            if plain_jaro_winkler(a, b) >= 0.92:
                assert min(len(a), len(b)) >= ratio * max(len(a), len(b)) - 1e-9
