"""The transducer against the library, its lookahead against brute force, and the decoder."""

import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest

from concordat.llm import queries, transducer

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = (
    "a b th in the ing 's ' r e v 're l 'll 1 2 ! ? É é é ́ 漢 字 가 ᄀ ᅡ ᆨ <|endoftext|> <| startoftext |> İ ß   \xa0 \x1c \x85 ² ½ 🙂 Σ ’ क ा ক া ͸ Ǆ"
).split(" ") + [" ", "\n", "  "]


@pytest.fixture(scope="module")
def words():
    return transducer.Vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def streamed(words, text, step, block):
    encoder = transducer.Encoder(words, block=block)
    out = [encoder.feed(text[i : i + step]) for i in range(0, len(text), step)]
    return np.frombuffer(b"".join([*out, encoder.end()]), np.uint32).tolist()


def test_any_text_in_any_parts(words, library):
    rng = random.Random(1)
    for _ in range(1500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60)))
        if rng.random() < 0.3:
            text = "".join(rng.choice("abthiner") for _ in range(rng.randint(1, 300))) + text
        ids = streamed(words, text, rng.choice([1, 3, 7, 1000]), rng.choice([1, 2, 8, 10**6]))
        assert ids == library.encode(text, add_special_tokens=False).ids, text
        decoder, step = transducer.Decoder(words.texts), rng.randint(1, 5)
        back = "".join(decoder.feed(ids[i : i + step]) for i in range(0, len(ids), step)) + decoder.end()
        assert back == library.decode(ids, skip_special_tokens=False)


def test_one_endless_word(words, library):
    """A piece far longer than the window is emitted as it comes, and what is held stays within the window."""
    rng = random.Random(2)
    for letters in ("ab", "thinger", "漢字가"):
        text = "".join(rng.choice(letters) for _ in range(12_000))
        assert streamed(words, text, 500, 300) == library.encode(text, add_special_tokens=False).ids
        encoder, most = transducer.Encoder(words, block=300), 0
        for at in range(0, len(text), 500):
            encoder.feed(text[at : at + 500])
            most = max(most, len(encoder.raw) + (len(encoder.open[1].held) if encoder.open else 0))
        assert most <= 1200 + 2 * (4 * words.lookahead + transducer.SHORT)


def test_lookahead_is_sufficient():
    """On small merge lists: no two texts with a common prefix have other tokens farther before its end."""
    rng = random.Random(5)
    for _ in range(60):
        tokens, merges = ["a", "b"], []
        while len(merges) < 6:
            pair = rng.choice(tokens), rng.choice(tokens)
            if pair not in merges and len(pair[0] + pair[1]) <= 5:
                merges.append(pair)
                tokens.append(pair[0] + pair[1])
        ranks = {m: i for i, m in reversed(list(enumerate(merges)))}
        bound = transducer.sufficient_lookahead(merges)
        for prefix in itertools.product("ab", repeat=7):
            ends = []
            for rest in itertools.chain.from_iterable(itertools.product("ab", repeat=n) for n in range(5)):
                at, own = 0, set()
                for token in transducer.merge([*prefix, *rest], ranks):
                    at += len(token)
                    own.add(at)
                ends.append({e for e in own if e <= 7 - bound})
            assert all(e == ends[0] for e in ends)


def test_long_and_short_merging_agree(words):
    rng = random.Random(3)
    for _ in range(200):
        symbols = [rng.choice("thinger") for _ in range(rng.randint(25, 60))]
        plain = symbols[:]
        while True:
            found = [(words.ranks[p], i) for i, p in enumerate(zip(plain, plain[1:])) if p in words.ranks]
            if not found:
                break
            _, i = min(found)
            plain[i : i + 2] = [plain[i] + plain[i + 1]]
        assert transducer.merge(symbols, words.ranks) == plain


def test_other_files_are_refused():
    with pytest.raises((ValueError, KeyError)):
        transducer.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def test_documents(frame, documents, library):
    coded = transducer.decode(transducer.encode(frame([(t, i, 0) for i, t in documents], "t string, i long, ids int"), PATH, "i", "t"), PATH)
    expected = []
    for i, t in documents:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i, len(ids), ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted([tuple(r) for r in coded.collect()], key=repr) == sorted(expected, key=repr)
    assert transducer.decode(transducer.encode(frame([]), PATH), PATH).collect() == []


def test_query(spark, folder, library):
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    expected = []
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        expected.append((r.doc_id, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False))))
    assert sorted(tuple(r) for r in queries.op13_transducer(spark, folder).collect()) == sorted(expected)
