"""SimHash groups against all pairs, and near copies by similarity."""

import random
import re

import pyarrow as pa
import xxhash

from concordat.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_print(text, size):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, distance):
    """component of each print: least id reachable, by all pairs."""
    nodes = list({f for _, f in prints})
    label = {f: min((i for i, g in prints if g == f and i is not None), default=None) for f in nodes}
    parent = {f: f for f in nodes}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= distance:
                parent[root(a)] = root(b)
    least = {}
    for f in nodes:
        if label[f] is not None:
            least[root(f)] = min(least.get(root(f), label[f]), label[f])
    return {f: least.get(root(f)) for f in nodes}


def test_groups_equal_all_pairs(frame, documents):
    prints = [(i, plain_print(t, 3)) for i, t in documents]
    groups = plain_groups(prints, 2)
    expected = sorted([(i, f"{f:016x}", groups[f]) for i, f in prints], key=repr)
    got = simhash.near_groups(frame(documents).selectExpr("*", "doc_id as f", "text as component_id"))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == expected


def test_crowded_keys_lose_no_link(spark):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    prints = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(400)} | {rng.getrandbits(64) for _ in range(200)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    for rows in (4, 32, 1000):
        links = simhash.print_links(spark.createDataFrame(signed, "f long"), group_rows=rows).collect()
        assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in links)
        parent = {f: f for (f,) in signed}

        def root(f):
            while parent[f] != f:
                f = parent[f]
            return f

        for a, b in links:
            parent[root(a)] = root(b)
        plain = plain_groups([(i, f) for i, (f,) in enumerate(signed)], 2)
        byte = {}
        for i, (f,) in enumerate(signed):
            byte[root(f)] = min(byte.get(root(f), i), i)
        assert {f: byte[root(f)] for (f,) in signed} == plain


def test_links_at_distance_one_in_crowded_keys(spark):
    prints = [*range(16), 1 << 40, 3 << 40]
    links = {tuple(r) for r in simhash.print_links(spark.createDataFrame([(p,) for p in prints], "f long"), max_distance=1, group_rows=1).collect()}
    assert links == {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() == 1}


def test_empty_table(frame):
    assert simhash.near_groups(frame([])).collect() == []
    assert simhash.similar_rows(frame([])).collect() == []


def test_long_text_is_read_whole():
    text = "a b c d e f g " * 5000
    one = simhash.majority_bits(simhash.shingle_hashes(text, 3))
    many = simhash._lanes(simhash.shingle_hashes(text, 3), 1)[:, 0]
    votes = [sum(int(h) >> (63 - b) & 1 for h in many) for b in range(64)]
    assert one.tolist() == [2 * v > len(many) for v in votes]


def test_near_copies_go_and_others_stay(frame):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(3000)]

    def fresh():
        return [rng.choice(vocabulary) for _ in range(300)]

    def edited(words, n):
        words = list(words)
        for i in rng.sample(range(len(words)), n):
            words[i] = rng.choice(vocabulary)
        return words

    rows, original = [], [fresh() for _ in range(40)]
    for i, words in enumerate(original):
        rows.append((i, " ".join(words)))
    hot = original[0]
    rows += [(1000 + i, " ".join(edited(hot, 3))) for i in range(150)]  # about 0.9 alike
    rows += [(2000 + i, " ".join(edited(original[1 + i], 3))) for i in range(20)]
    rows += [(3000 + i, " ".join(original[25])) for i in range(30)]
    rows += [(4000 + i, " ".join(edited(original[30], 60))) for i in range(5)]  # under 0.4 alike
    rows += [(None, rows[3][1]), (3, rows[3][1])]
    kept = [r.doc_id for r in simhash.similar_rows(frame(rows)).collect()]
    assert sorted(kept) == [*range(40), *range(4000, 4005)]


def test_pairs_at_the_similarity_are_judged_exactly(frame):
    rng = random.Random(6)
    rows = []
    for i in range(120):  # one run of new words at the end: 400 shingles, of which all but n are shared
        words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(404)]
        n = 42 if i % 2 else 49  # similarities of 0.810 and 0.782
        rows += [(i, " ".join(words)), (1000 + i, " ".join(words[: 404 - n] + [f"{w}x" for w in words[404 - n :]]))]
    kept = {r.doc_id for r in simhash.similar_rows(frame(rows)).collect()}
    assert all(1000 + i in kept for i in range(0, 120, 2))
    assert not any(1000 + i in kept for i in range(1, 120, 2))


def test_a_repeated_line_does_not_outweigh_the_rest(frame):
    rng = random.Random(7)
    texts = [" ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(40)) for _ in range(2)]
    rows = [(i, "one line comes again and again " * 60 + t) for i, t in enumerate(texts)]
    assert {r.doc_id for r in simhash.similar_rows(frame(rows)).collect()} == {0, 1}


def test_groups_that_meet_in_hot_blocks_only(frame):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(404)]

    def changed(words, at, n, mark):
        return words[:at] + [f"{mark}z{j}" for j in range(n)] + words[at + n :]

    rows = []
    for m in range(60):  # two pairs of near twins, 0.85 alike, among texts that are 0.6 alike
        own = changed(base, rng.randrange(150), 36, f"m{m}")
        for i, words in enumerate((changed(own, rng.randrange(200, 280), 12, f"p{m}"), changed(own, rng.randrange(300, 380), 12, f"q{m}"))):
            rows += [(10 * m + 2 * i, " ".join(words)), (10 * m + 2 * i + 1, " ".join([*words[:-1], f"end{m}"]))]
    kept = sorted(r.doc_id for r in simhash.similar_rows(frame(rows), common=3).collect())
    assert kept == [10 * m for m in range(60)]


def sets_of(text):
    words = text.split(" ") if text else []
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_kept(rows, similarity=0.8):
    """The least id of each group of texts, by all pairs."""
    sets = [sets_of(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both * (1 + similarity) >= (len(a) + len(sets[j])) * similarity - 1e-6:
                parent[root(i)] = root(j)
    least = {}
    for i, (own, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), own), own)
    return sorted(least.values())


def variants(rng, count, words, share):
    """Texts that each change a share of one base text's words."""
    base = [f"b{rng.randrange(10**6)}" for _ in range(words)]
    for _ in range(count):
        own = list(base)
        at = rng.randrange(words)
        for k in range(int(share * words)):
            own[(at + k) % words] = f"v{rng.randrange(10**6)}"
        yield " ".join(own)


def test_groups_are_those_of_all_pairs(frame):
    rng = random.Random(11)
    texts = ["", "", "one two", "one two", "one two three"]
    for share in (0.02, 0.05, 0.09, 0.1, 0.11, 0.13, 0.3):
        for words in (12, 40, 150):
            texts += variants(rng, 14, words, share)
    passage = " ".join(f"p{k}" for k in range(60))
    texts += [f"{passage} {' '.join(f'q{rng.randrange(10**6)}' for _ in range(n))}" for n in (2, 4, 6, 8, 10, 20, 60) for _ in range(6)]
    texts += [t + " and one more" for t in texts[5:200:7]]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    for common in (2, 8, 10**6):  # the order of shingles decides on nothing
        assert sorted(r.doc_id for r in simhash.similar_rows(frame(rows), common=common).collect()) == plain_kept(rows)


def test_pairs_grow_with_a_group_not_with_its_square(frame, monkeypatch):
    counted, real = [], simhash._verified

    def counting(pairs, *more):
        counted.append(pairs.count())
        return real(pairs, *more)

    monkeypatch.setattr(simhash, "_verified", counting)
    for share in (0.01, 0.02, 0.17):  # to each other about 0.93, 0.9 and 0.5 alike
        pairs = []
        for n in (400, 800):
            counted.clear()
            simhash.similar_rows(frame(enumerate(variants(random.Random(n), n, 200, share)))).count()
            pairs.append(sum(counted))
        assert pairs[1] <= 2.3 * max(pairs[0], 10) and pairs[1] <= 2 * 800, (share, pairs)


def test_pairs_are_taken_apart_a_few_megabytes_at_a_time(monkeypatch):
    texts = [" ".join(f"w{i}x{k}" for k in range(20_000)) for i in range(40)]
    near = [t + " end" for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(range(40, 80)), pa.array(texts), pa.array([*near[:20], *texts[:20]])], ["a", "b", "a_text", "b_text"])
    held, plain = [], simhash.shingle_sets
    monkeypatch.setattr(simhash, "shingle_sets", lambda said, size: held.append(sum(map(len, said))) or plain(said, size))
    found = [row for part in simhash._alike(5, 0.8)(iter([batch])) for row in part.to_pylist()]
    assert found == [{"a": i, "b": i + 40} for i in range(20)]
    assert sum(held) > 10 << 20 and max(held) < 4 << 20
