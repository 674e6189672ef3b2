"""Token files and packing against the tokenizer run on whole texts."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from concordat.llm import packing, token_files
from concordat.llm.queries import op7_tokens, op10_packing, tokenizer
from concordat.llm.tokens import Encoder

FILES = [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)]


def plain(name, texts):
    found = Tokenizer.from_file(tokenizer(name)).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [x.ids for x in found]


@pytest.mark.parametrize("name,joins", FILES)
def test_cut_texts_encode_like_whole_ones(name, joins, documents):
    rng = random.Random(1)
    marks = [*" \n\t'!aAéñ1’́ 漢İςΣ<|>\x1c­​\u0085 ", "ll", "<|endoftext|>", "re", "  "]
    texts = [t for _, t in documents] + ["".join(rng.choice(marks) for _ in range(rng.randint(0, 30))) for _ in range(20_000)]
    made = Encoder(tokenizer(name), joins, limit=2000)
    got = [x for at in range(0, len(texts), 500) for x in made.encode(texts[at : at + 500])]
    assert [np.frombuffer(x, np.uint32).tolist() for x in got] == plain(name, texts)


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, real):
        self.real, self.texts = real, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.real.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("name,joins", FILES)
def test_new_pieces_reach_the_library_many_to_a_text(name, joins):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghijklmnopé") for _ in range(9)) for _ in range(6400)]
    texts = ["\n".join(words[at : at + 100]) for at in range(0, 6400, 100)]  # no piece begins with a space
    made = Encoder(tokenizer(name), joins)
    made.tokenizer, made.merger = Counted(made.tokenizer), Counted(made.merger)
    got = made.encode(texts)
    assert made.tokenizer.texts + made.merger.texts < 200
    assert [np.frombuffer(x, np.uint32).tolist() for x in got] == plain(name, texts)


def test_texts_split_together_stay_apart():
    texts = ["it'", "s", "", " ", "", "'s", "x ", "y", "  ", "'", "ll", "a\n", "\n b", "'re", "7", "8", None, "漢", "z'"]
    for name, joins in FILES:
        for chunk in (1, 1 << 20):
            got = Encoder(tokenizer(name), joins, chunk=chunk).encode(texts)
            assert [np.frombuffer(x, np.uint32).tolist() for x in got] == plain(name, texts)


def test_a_worker_keeps_few_pieces():
    made = Encoder(tokenizer("byte_bpe_50k.json"), True)
    for at in range(0, 240_000, 40_000):
        made.encode([" ".join(f"{k}" for k in range(at, at + 40_000))])
    assert len(made.known) <= 200_000


def test_token_files(spark, frame, documents, tmp_path):
    out = str(tmp_path / "tokens")
    docs = frame(documents).selectExpr("*", "doc_id as ids", "text as part")
    token_files.write_tokens(docs, out, tokenizer("word_bpe_49k.json"), 1, files=5)
    rows = token_files.read_tokens(spark, out).collect()
    ids = {}
    for (i, _), x in zip(documents, plain("word_bpe_49k.json", [t for _, t in documents])):
        ids.setdefault(i, []).append([*x, 1])
    assert len(rows) == len(documents)
    assert all(list(r.ids) in ids[r.doc_id] and r.n_tokens == len(r.ids) for r in rows)
    at = 0
    ordered = sorted(rows, key=lambda r: r.start)
    for r in ordered:
        assert r.start == at
        at += r.n_tokens
    order = [(r.doc_id is not None, r.doc_id or 0) for r in ordered]
    assert order == sorted(order)


def test_token_query(spark, folder):
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    at, expected = 0, []
    for (i, _), ids in zip(docs, plain("word_bpe_49k.json", [t for _, t in docs])):
        expected.append((i, at, len(ids) + 1, zlib.crc32(np.array([*ids, 1], "<u4").tobytes())))
        at += len(ids) + 1
    assert sorted(tuple(r) for r in op7_tokens(spark, folder).collect()) == expected


def test_no_documents(spark, frame, tmp_path):
    token_files.write_tokens(frame([]), str(tmp_path / "none"), tokenizer("word_bpe_49k.json"), 1)
    assert token_files.read_tokens(spark, str(tmp_path / "none")).collect() == []
    assert packing.pack(frame([]), tokenizer("byte_bpe_50k.json"), 0).collect() == []


def sequences(pieces, window=1024):
    """Checks the sequences and returns the share of padding."""
    made = {}
    for r in pieces:
        made.setdefault(r.sequence_id, []).append((r.offset, r.length))
    padded = total = 0
    for parts in made.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
        total += at
        padded += 0 if at & (at - 1) == 0 else window - at
    return padded / max(total, 1)


def test_packing_holds_every_id_once(frame, documents):
    docs = frame([(k, t) for k, (_, t) in enumerate(documents)]).selectExpr("*", "doc_id as ids", "doc_id as sequence_id").repartition(3)
    rows = packing.pack(docs, tokenizer("byte_bpe_50k.json"), 0, shard_rows=50).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    for k, ids in enumerate(plain("byte_bpe_50k.json", [t for _, t in documents])):
        whole, at = [*ids, 0], 0
        for r in sorted(pieces[k], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(whole)
            assert np.frombuffer(r.ids, "<u4").tolist() == whole[at : at + r.length]
            at += r.length
        assert at == len(whole)
    assert sequences(rows) == 0


def test_packing_query(spark, folder):
    assert sequences(op10_packing(spark, folder).collect()) == 0


def scattered():
    """Texts of twelve topics, those of a topic as far apart as can be."""
    rng = random.Random(3)
    words = [["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(60)] for _ in range(12)]
    return [(i, " ".join(rng.choice(words[i % 12]) for _ in range(60))) for i in range(600)]


def windows(rows):
    made = {}
    for r in rows:
        made.setdefault(r.sequence_id, []).append((r.offset, r.doc_id, r.start, r.length))
    return [sorted(x) for x in made.values()]


def test_related_texts_meet_wherever_they_lie(spark, frame):
    docs = frame(scattered()).repartitionByRange(12, "doc_id")
    packed = packing.pack(docs, tokenizer("byte_bpe_50k.json"), 0, shard_rows=40).collect()
    assert sequences(packed) == 0
    shared = [len({doc % 12 for _, doc, _, _ in x}) for x in windows(packed) if len(x) > 2]
    assert np.mean(shared) < 2  # a window of near rows would have as many topics as texts


def test_packing_does_not_depend_on_splits(frame):
    made = [
        sorted(windows(packing.pack(frame(scattered()).repartition(n), tokenizer("byte_bpe_50k.json"), 0, shard_rows=100).collect()))
        for n in (2, 7)
    ]
    assert made[0] == made[1]


def test_windows_prefer_neighbours():
    rng = np.random.default_rng(1)
    topics = [rng.integers(1000 * k, 1000 * k + 300, (12, 100)).astype(np.uint32) for k in range(5)]
    tails = [row for rows in zip(*topics) for row in rows]  # five topics, dealt in turn
    alone = np.mean([len({item % 5 for item, _, _ in row}) for row in packing.fill(tails, 400)])
    assert alone < 2.2  # four neighbours by place would be of four topics


def test_bm25_against_plain_scores():
    rng = np.random.default_rng(2)
    lists = [rng.integers(0, 40, rng.integers(1, 30)).astype(np.uint32) for _ in range(30)]
    index = packing.Bm25(lists, terms=1000)
    mean = np.mean([len(x) for x in lists])
    score = np.zeros(30)
    for t in set(lists[4].tolist()):
        df = sum(t in x for x in lists)
        for d, x in enumerate(lists):
            tf = int((x == t).sum())
            score[d] += np.log1p((30 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(x) / mean))
    unused = np.ones(30, bool)
    unused[4] = False
    got = list(index.neighbours(4, unused))
    assert np.allclose(score[got], sorted(score[unused & (score > 0)], reverse=True), rtol=1e-4)


def test_common_terms_stand_in_a_table_and_score_as_in_lists():
    rng = np.random.default_rng(6)
    lists = [np.concatenate([rng.choice(20, 10, False), rng.integers(100, 900, rng.integers(0, 40))]).astype(np.uint32) for _ in range(200)]
    index = packing.Bm25(lists)
    assert len(index.table) == 20 and len(index.owner) == sum(len(set(x.tolist())) - 10 for x in lists)
    mean = np.mean([len(x) for x in lists])
    sets = [set(x.tolist()) for x in lists]
    unused = np.arange(200) != 7
    score = np.zeros(200)
    for t in sets[7]:
        df = sum(t in s for s in sets)
        for d in (d for d in range(200) if t in sets[d]):
            tf = int((lists[d] == t).sum())
            score[d] += np.log1p((200 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(lists[d]) / mean))
    got = list(index.neighbours(7, unused))
    assert np.allclose(score[got], sorted(score[unused & (score > 0)], reverse=True), rtol=1e-4)


def test_used_up_texts_leave_the_index():
    rng = np.random.default_rng(5)
    lists = [rng.integers(0, 200, rng.integers(1, 60)).astype(np.uint32) for _ in range(300)]
    unused = rng.random(300) < 0.4
    for terms in (None, 5):
        index, whole = packing.Bm25(lists, terms), packing.Bm25(lists, terms)
        index.shrink(unused)
        assert len(index.owner) < 0.6 * len(whole.owner)
        for seed in np.flatnonzero(unused).tolist():
            assert list(index.neighbours(seed, unused)) == list(whole.neighbours(seed, unused))


def test_terms_of_one_text_hide_no_neighbour():
    own = [np.arange(1000 * k, 1000 * k + 40) for k in range(1, 5)]  # forty terms that no other text has
    common = [np.arange(5), np.arange(5), np.arange(100, 105), np.arange(100, 105)]
    tails = [np.concatenate(x).astype(np.uint32) for x in zip(own, common)]
    for order in ([0, 2, 1, 3], [0, 3, 2, 1]):
        pairs = packing.fill([tails[i] for i in order], 90)
        assert [{order[item] // 2 for item, _, _ in row} for row in pairs] in ([{0}, {1}], [{1}, {0}])


def test_every_term_of_a_seed_counts():
    rng = np.random.default_rng(4)
    rare = [np.arange(30) + 30 * k for k in range(20)]
    seed = np.arange(600, 900)
    some = [np.concatenate([seed[10 * k : 10 * k + 3], rare[k]]) for k in range(20)]
    best = np.concatenate([seed[150:], rng.integers(2000, 3000, 20)])  # shares many terms, none of them rarest
    others = [np.concatenate([seed[150:200], rng.integers(3000, 9000, 300)]) for _ in range(20)]
    lists = [x.astype(np.uint32) for x in [seed, *some, *others, best]]
    windows = packing.fill(lists, 450)
    assert [item for item, _, _ in windows[0]][:2] == [0, len(lists) - 1]
