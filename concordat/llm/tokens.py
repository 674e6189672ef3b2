"""Token ids of a `tokenizers` file, encoded in batches with a cache of pieces.

Both vocabularies first split a text by a pattern, then merge within each piece. Texts of ASCII
and Latin letters are split here at the same places, many at once, and each distinct piece is merged once by
the library, with its vocabulary and merges; the ids of a text are its pieces' ids in order. All other
texts, and those that may hold an added token, are encoded whole by the library. A test holds
either way to the library's ids of whole texts.

A worker keeps its encoder for as long as it lives, and an executor has several workers, so few pieces are kept: their
ids lie in one Arrow array.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LETTER, DIGIT, OTHER, BLANK, END = 1, 2, 3, 4, 5
# ASCII and Latin-1 but for what the library's tables and Python's might sort differently; zero stands between texts.
_OF = bytearray(256)
for _kind, _chars in (
    (LETTER, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))),
    (DIGIT, "0123456789"), (BLANK, "\t\n\v\f\r "), (END, "\0"),
    (OTHER, "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¡¢£¤¥¦§¨©«¬®¯°±´¶·¸»¿×÷"),
):
    for _char in _chars:
        _OF[ord(_char)] = _kind
_OF = bytes(_OF)
_PLAIN = bytes(i for i in range(1, 256) if _OF[i])
# The letters that stand for bytes in both vocabularies: the byte's own where it can be seen, else the next from 256 on.
_SEEN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_LETTERS = {b: b if b in _SEEN else 256 + sum(x not in _SEEN for x in range(b)) for b in range(256)} | {0: 32}


class Encoder:
    """Encodes texts with the tokenizer at `path`.

    `joins_space`: the vocabulary splits so that a piece begins with the space before it; else it
    lower-cases and drops white space. `limit` bounds the pieces kept, `chunk` the letters worked on at a time.
    """

    def __init__(self, path: str, joins_space: bool, limit: int = 200_000, chunk: int = 4 << 20):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # The same vocabulary and merges for pieces that are split already and spelt in the vocabulary's letters, many to a text.
        self.merger = Tokenizer(self.tokenizer.model)
        self.merger.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        # How many letters an id stands for; the mark of a word's end is none.
        vocabulary = self.tokenizer.get_vocab()
        self.letters = np.zeros(max(vocabulary.values(), default=-1) + 1, np.int64)
        for token, i in vocabulary.items():
            self.letters[i] = len(token if joins_space else token.removesuffix("</w>"))
        self.spelling = _LETTERS if joins_space else _LETTERS | dict.fromkeys(b"\t\n\v\f\r ")
        self.joins_space = joins_space
        self.limit, self.chunk = limit, chunk
        self.known = {b"\0": 0}
        self.ids = pa.array([b""], pa.large_binary())

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _merged(self, new: list[bytes]) -> pa.Array:
        """The ids of pieces, many to a text: the library has a price by the text. They part again by their letters."""
        spelt = b"\0".join(new).decode("latin-1").encode().decode("latin-1").translate(self.spelling).split(" ")
        found = self.merger.encode_batch_fast([" ".join(spelt[at : at + 64]) for at in range(0, len(spelt), 64)], add_special_tokens=False)
        ids = np.concatenate([np.array(x.ids, np.uint32) for x in found])
        past = np.concatenate([[0], np.cumsum(self.letters[ids])])
        ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, spelt), np.int64, len(spelt)))])
        cuts = np.searchsorted(past, ends)
        if past[-1] != ends[-1] or (past[cuts] != ends).any():  # letters that the vocabulary lacks: piece by piece
            found = self.merger.encode_batch_fast(spelt, add_special_tokens=False)
            return pa.array([array("I", x.ids).tobytes() for x in found], pa.large_binary())
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(spelt), [None, pa.py_buffer(4 * cuts), pa.py_buffer(ids)])

    def _starts(self, said: np.ndarray) -> np.ndarray:
        """Where the pieces of texts begin that stand with a zero after each."""
        kind = np.frombuffer(said.tobytes().translate(_OF), np.uint8)
        starts = np.empty(len(kind), bool)
        starts[0] = True
        np.not_equal(kind[1:], kind[:-1], out=starts[1:])
        runs = np.flatnonzero(starts[1:]) + 1
        # An apostrophe alone, and the letters that it takes along.
        quotes = np.flatnonzero(said == ord("'"))
        quotes = quotes[starts[quotes] & (kind[quotes + 1] == LETTER)]
        if self.joins_space:
            quotes = quotes[(quotes == 0) | (said[quotes - 1] != ord(" "))]
            # The last blank before a word is a piece of its own, or, if a space, the word's beginning.
            words = runs[(kind[runs - 1] == BLANK) & (kind[runs] != END)]
            starts[words - 1] = True
            starts[words[said[words - 1] == ord(" ")]] = False
        else:
            starts |= kind == DIGIT
        starts |= kind == END
        if len(quotes):
            first, second = said[quotes + 1], said[quotes + 2]
            taken = np.isin(first, np.frombuffer(b"stmd", np.uint8)).astype(np.int64)
            for pair in (b"re", b"ve", b"ll"):
                taken[(first == pair[0]) & (second == pair[1])] = 2
            quotes, taken = quotes[taken > 0], taken[taken > 0]
            starts[quotes + 1] = False
            starts[quotes + taken + 1] = True
        return np.flatnonzero(starts)

    def _joined(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of plain texts, split and looked up together."""
        text = b"\0".join([*texts, b""])
        said = np.frombuffer(text, np.uint8)
        starts = self._starts(said)
        bounds = np.append(starts, len(said))
        split = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(text)]).dictionary_encode()
        met = split.dictionary.to_pylist()
        if len(self.known) + len(met) > self.limit:  # only what these texts have is kept
            kept = [x for x in met if x in self.known]
            self.ids = self.ids.take(pa.array([self.known[x] for x in kept], pa.int64()))
            self.known = dict(zip(kept, range(len(kept))))
        if new := [x for x in met if x not in self.known]:
            self.ids = pa.concat_arrays([self.ids, self._merged(new)])
            self.known.update(zip(new, range(len(self.known), len(self.ids))))
        place = pa.array(np.fromiter(map(self.known.__getitem__, met), np.int64, len(met)))
        found = self.ids.take(place.take(split.indices))
        ends = np.frombuffer(found.buffers()[1], np.int64)[: len(starts) + 1]
        flat = memoryview(found.buffers()[2] or b"")
        at = 0
        for size in map(len, texts):
            a, b = np.searchsorted(starts, (at, at + size))
            yield bytes(flat[ends[a] : ends[b]])
            at += size + 1

    def _plain(self, text: str) -> bytes | None:
        """A plain text, lower-cased if need be, a byte for each letter; None for another."""
        if "<|" in text:
            return None
        try:
            if text.encode("latin-1").translate(None, _PLAIN):
                return None
        except UnicodeEncodeError:
            return None
        return (text if self.joins_space else text.lower()).encode("latin-1")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as unsigned 32-bit integers; none for a null."""
        plain = [self._plain(t or "") for t in texts]
        found = [b""] * len(texts)
        whole = [i for i, x in enumerate(plain) if x is None]
        for i, ids in zip(whole, self._encode([texts[i] for i in whole])):
            found[i] = ids
        part: list[int] = []
        size = 0
        for i, x in enumerate(plain):
            if x:
                part.append(i)
                size += len(x)
            if part and (size >= self.chunk or i == len(plain) - 1):
                for k, ids in zip(part, self._joined([plain[k] for k in part])):
                    found[k] = ids
                part, size = [], 0
        pa.default_memory_pool().release_unused()  # other stages of this worker's executor need it
        return found


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, joins_space: bool) -> Encoder:
    """This worker's encoder for `path`, with the pieces it has met."""
    if (path, joins_space) not in _ENCODERS:
        _ENCODERS[path, joins_space] = Encoder(path, joins_space)
    return _ENCODERS[path, joins_space]
