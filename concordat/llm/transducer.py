"""BPE as a bounded-lookahead streaming transducer, and an incremental decoder.

Merging is local: what follows a prefix can change that prefix's tokens only near its end. Take
two texts with a common prefix, and apply the merges by rank. The place up to which both have the
same tokens moves left only when a merge (u, v) takes the last common token u in one of them and
not in the other, by the length of u. The next such merge has a later rank, and its right operand
begins, among its left operands of operands, with that u. So the farthest that the place can
move is the longest chain of such merges, weighed by the lengths of u: the sufficient lookahead, worked out once from
the merge list. Tokens that end that far before the end of what was read are final. They are
emitted, and the merging starts anew after them, as no merge crosses the end of a token.

The stream before the merges has bounded state too. Texts are read in blocks; a block ends after
white space where there is any, else where neither normalisation, nor an added token, nor a
contraction can reach over its end. An open piece goes on as a state of the merger, however long it is.
(Marks that follow one another without end have no such place: the norm itself needs them whole.)

Short whole pieces are remembered, up to a limit, so the merger runs once for each of them.

The file must be of the kind this module reads: BPE over byte letters, with an end-of-word
suffix, pieces split by the contraction pattern, and merges whose operands are made before them. Others are refused.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, small_batches

# The splitting pattern of this kind of vocabulary, as the file states it, and over classes of letters.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_BY_CLASS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|0|['!]+")
# The same over plain lower-case text itself.
_BY_LETTER = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
# ASCII and Latin-1, but for what Python's tables and the file's might class or lower-case differently.
_ASCII = bytes([*range(0x1C), *range(0x20, 0x80)])
_LATIN = re.compile("[\\x00-\\x1b -~¡-©«¬®-±´¶-¸»¿-ÿ]*")
BLOCK = 1 << 16
SHORT = 64


def _plain(text: str) -> bool:
    if text.isascii():
        return not text.encode().translate(None, _ASCII)
    return bool(_LATIN.fullmatch(text))


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it prints, else the next one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def sufficient_lookahead(merges: list[tuple[str, str]], suffix: str = "") -> int:
    """How many letters before the end of a prefix its tokens may still change, whatever follows."""
    size = lambda token: len(token.removesuffix(suffix)) if suffix else len(token)
    lefts: dict[str, set[str]] = {}  # the token and its left operands, theirs, and so on
    reach: dict[str, int] = {}  # the longest chain so far that ends in a merge with this left operand
    longest = 0
    for u, v in merges:
        chain = size(u) + max((reach.get(x, 0) for x in lefts.get(v, ()) if x != v), default=0)
        chain = max(chain, size(u) + reach.get(v, 0))
        reach[u] = max(reach.get(u, 0), chain)
        longest = max(longest, chain)
        lefts.setdefault(u + v, set()).update(lefts.get(u, ()), (u,))
    return longest


class Vocabulary:
    """What a `tokenizers` file says, checked to be of the kind read here."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model, norm, split = said["model"], said["normalizer"], said["pre_tokenizer"]["pretokenizers"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = {x for x in byte_letters()} | {x + self.suffix for x in byte_letters()}
        for u, v in merges:
            if u not in made or v not in made:
                raise ValueError("a merge's operand is made after it")
            made.add(u + v)
        known = (
            [x["type"] for x in norm["normalizers"]] == ["NFC", "Replace", "Lowercase"]
            and [x["type"] for x in split] == ["Split", "ByteLevel"]
            and split[0]["pattern"].get("Regex") == PATTERN
            and not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges"))
            and not any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in said["added_tokens"])
            and not said.get("decoder") and made <= self.ids.keys() and self.suffix
        )
        if not known:
            raise ValueError(f"{path} is not of the kind of vocabulary this transducer reads")
        self.ranks: dict[tuple[str, str], int] = {}
        for pair in merges:
            self.ranks.setdefault(pair, len(self.ranks))
        self.lookahead = sufficient_lookahead(merges, self.suffix)
        self.added = {x["content"]: x["id"] for x in said["added_tokens"]}
        self.special = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.letters = byte_letters()
        self.last = [x + self.suffix for x in self.letters]
        tokenizer = Tokenizer.from_file(path)
        self.normal, self.split = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
        tokens = self.ids | self.added
        self.texts = [""] * (max(tokens.values()) + 1)
        for token, i in tokens.items():
            self.texts[i] = token
        self.packed = {token: np.uint32(i).tobytes() for token, i in self.ids.items()}
        self.classes = _Classes(self.split)


class _Classes(dict):
    """A letter for each normalised character, as the splitting pattern sees it: contractions' letters are themselves,
    other letters a, numbers 0, white space a space, all else an exclamation mark. What is not ASCII is asked of the file's own splitter, once."""

    def __init__(self, split):
        super().__init__({i: " " if i in (*range(9, 14), 32) else "!" for i in range(0x80) if not 0x1C <= i <= 0x1F})
        self.update({ord(c): c if c in "strevmld" else "a" for c in "abcdefghijklmnopqrstuvwxyz"})
        self.update({ord(c): "a" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} | {ord(c): "0" for c in "0123456789"} | {39: "'"})
        self.split = split

    def __missing__(self, code: int) -> str:
        got = [span for _, span in self.split(f"a{chr(code)}!")]
        kind = {((0, 2), (2, 3)): "a", ((0, 1), (1, 2), (2, 3)): "0", ((0, 1), (2, 3)): " ", ((0, 1), (1, 3)): "!"}[tuple(got)]
        if len(self) < 1 << 17:
            self[code] = kind
        return kind


def merge(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The symbols after all merges: always the least rank, of equal ones the leftmost."""
    n, get = len(symbols), ranks.get
    if n <= 64:
        token, none = symbols[:], len(ranks)
        rank = [get(pair, none) for pair in zip(token, token[1:])]
        while rank and (least := min(rank)) < none:
            at = rank.index(least)
            token[at] = joined = token[at] + token.pop(at + 1)
            del rank[at]
            if at:
                rank[at - 1] = get((token[at - 1], joined), none)
            if at < len(rank):
                rank[at] = get((joined, token[at + 1]), none)
        return token
    token = symbols[:]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[pair], i, pair) for i, pair in enumerate(zip(token, token[1:])) if pair in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i]
        if j >= n or token[i] is None or (token[i], token[j]) != pair:
            continue
        token[i], token[j] = pair[0] + pair[1], None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (token[i], token[k]) in ranks:
                heapq.heappush(heap, (ranks[token[i], token[k]], i, (token[i], token[k])))
        h = before[i]
        if h >= 0 and (token[h], token[i]) in ranks:
            heapq.heappush(heap, (ranks[token[h], token[i]], h, (token[h], token[i])))
    return [t for t in token if t is not None]


class Merger:
    """The merges of one piece that comes in parts: `push` returns the ids that are final, `end` the rest."""

    def __init__(self, words: Vocabulary):
        self.words = words
        self.window = 4 * words.lookahead + SHORT
        self.held = ""  # byte letters of the piece whose tokens are not final

    def push(self, part: str) -> list[bytes]:
        words, out = self.words, []
        letters = "".join(map(words.letters.__getitem__, part.encode()))
        for at in range(0, len(letters), self.window):
            self.held += letters[at : at + self.window]
            if len(self.held) <= self.window:
                continue
            # The last letter may be the piece's last, which is another symbol.
            final, upto = len(self.held) - 1 - words.lookahead, 0
            for token in merge(list(self.held[:-1]), words.ranks):
                if upto + len(token) > final:
                    break
                upto += len(token)
                out.append(words.packed[token])
            self.held = self.held[upto:]
        return out

    def end(self) -> list[bytes]:
        words, held = self.words, self.held
        self.held = ""
        if not held:
            return []
        return [words.packed[t] for t in merge([*held[:-1], held[-1] + words.suffix], words.ranks)]


class _Pieces(dict):
    """Ids of short whole pieces, packed. When it is full, what was not asked for since the last time goes."""

    def __init__(self, words: Vocabulary, limit: int):
        super().__init__()
        self.words, self.limit, self.old = words, limit, {}
        self.merger = Merger(words)

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            if len(piece) > SHORT:
                return b"".join([*self.merger.push(piece), *self.merger.end()])
            words = self.words
            raw = piece.encode()
            symbols = [*map(words.letters.__getitem__, raw[:-1]), words.last[raw[-1]]]
            found = b"".join(map(words.packed.__getitem__, merge(symbols, words.ranks)))
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[piece] = found
        return found


class Encoder:
    """Packed ids (unsigned 32-bit) of a text that comes in parts."""

    def __init__(self, words: Vocabulary, known: _Pieces | None = None, block: int = BLOCK):
        self.words, self.known, self.block = words, known if known is not None else _Pieces(words, 200_000), block
        self.raw = ""  # read, but not normalised
        self.begun = ""  # normalised, but too short to tell a contraction
        self.open = None  # class and merger of a piece that may go on
        self.longest_special = max(map(len, words.added), default=1)

    def _close(self) -> list[bytes]:
        merger, self.open = self.open, None
        return merger[1].end() if merger else []

    def _normal(self, text: str, last: bool) -> list[bytes]:
        """Ids of a stretch without added tokens; not `last`: it may go on anywhere."""
        words = self.words
        plain = _plain(text)
        begun, self.begun = self.begun, ""
        text = begun + (text.lower() if plain else words.normal(text))
        out: list[bytes] = []
        if plain and not begun and last and self.open is None:
            return list(map(self.known.__getitem__, _BY_LETTER.findall(text)))
        kinds = text.translate(words.classes)
        at = 0
        if self.open is not None:
            letters = "strevmlda" if self.open[0] == "a" else "'!"
            at = len(kinds) - len(kinds.lstrip(letters))
            out += self.open[1].push(text[:at])
            if at < len(text) or last:
                out += self._close()
        spans = [m.span() for m in _BY_CLASS.finditer(kinds, at)]
        if not last and spans and spans[-1][1] == len(text):
            begin = spans.pop()[0]
            # "'r" may become a contraction, and so may "'" by itself where a piece begins; "don" may go on.
            if len(text) - begin == 1 and spans and spans[-1] == (begin - 1, begin) and kinds[begin - 1] == "'":
                begin = spans.pop()[0]
            if kinds[begin] == "'" and len(text) - begin < 3:
                self.begun = text[begin:]
            elif kinds[begin] != "0" and not re.fullmatch("'s|'t|'re|'ve|'m|'ll|'d", kinds[begin:]):
                self.open = ("!" if kinds[begin] in "'!" else "a", Merger(words))
                out += self.open[1].push(text[begin:])
            else:
                spans.append((begin, len(text)))
        out += [self.known[text[a:b]] for a, b in spans]
        return out

    def _stretch(self, text: str, last: bool) -> list[bytes]:
        return self._normal(text, last) if text or self.begun or (last and self.open) else []

    def _safe(self, text: str) -> int:
        """The last place where a stretch may be cut: nothing that follows may join what is before."""
        end = len(text) - self.longest_special
        for at in range(end, 0, -1):
            c = text[at]
            if c.isascii() or (unicodedata.category(c)[0] in "LNPZ" and not 0x1100 <= ord(c) <= 0x11FF):
                cut = at
                break
        else:
            return 0
        # An added token may have begun before the cut.
        for match in self.words.special.finditer(text) if self.words.special else ():
            if match.start() < cut < match.end():
                cut = match.start()
        return cut

    def feed(self, part: str) -> bytes:
        """The ids that are final after this part."""
        out: list[bytes] = []
        self.raw += part
        while len(self.raw) >= 2 * self.block:
            block = self.raw[: self.block + self.longest_special]
            cut = max(block.rfind(" ", 1), block.rfind("\n", 1))
            if cut <= 0:
                cut = self._safe(block)
            if cut <= 0:
                cut = self._safe(self.raw)
            if cut <= 0:
                break
            out += self._specials(self.raw[:cut], False)
            self.raw = self.raw[cut:]
        return b"".join(out)

    def _specials(self, text: str, last: bool) -> list[bytes]:
        out, at = [], 0
        if self.words.special and "<" in text:
            for match in self.words.special.finditer(text):
                out += self._stretch(text[at : match.start()], True)
                out.append(np.uint32(self.words.added[match.group()]).tobytes())
                at = match.end()
        return out + self._stretch(text[at:], last)

    def end(self) -> bytes:
        """The ids of what is left; the encoder is then new."""
        raw, self.raw = self.raw, ""
        return b"".join(self._specials(raw, True))


class Decoder:
    """Text of ids that come in parts, as the file says: no decoder, so tokens stand with a space between.

    Tokens are bytes that go through a byte-to-text state machine, which holds back the bytes of an unfinished character.
    """

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.begun = False
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        found = " ".join(map(self.texts.__getitem__, ids))
        if not found:
            return ""
        lead, self.begun = " " if self.begun else "", True
        return self.state.decode((lead + found).encode())

    def end(self) -> str:
        self.begun = False
        return self.state.decode(b"", True)


_READ: dict[str, tuple[Vocabulary, _Pieces]] = {}


def _read(path: str, limit: int) -> tuple[Vocabulary, _Pieces]:
    if path not in _READ:
        words = Vocabulary(path)
        _READ[path] = words, _Pieces(words, limit)
    return _READ[path]


def encode(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = 400_000,
) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row of `docs`; a null text is empty and has no ids, a repeated row comes as often.

    Ids are those of the tokenizer file at `path`, added tokens in a text being themselves, and nothing added, cut or padded. `limit`
    bounds the pieces that a worker remembers.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, known = _read(path, limit)
        for batch in pieces(stream, 4 << 20):
            blobs = []
            for said in batch.column("text").to_pylist():
                transducer = Encoder(words, known)
                got = [transducer.feed(said[at : at + BLOCK]) for at in range(0, len(said), BLOCK)] if said else []
                blobs.append(b"".join([*got, transducer.end()]))
            sizes = np.array([len(b) // 4 for b in blobs], np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(blobs), np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes), ids], ["doc_id", "n_tokens", "ids"])

    own = small_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")


def decode(rows: DataFrame, path: str, limit: int = 400_000) -> DataFrame:
    """`rows` (doc_id, n_tokens, ids) with `decoded`, the text of the ids; special tokens are shown."""
    step = 1 << 16

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, _ = _read(path, limit)
        for batch in pieces(stream, 4 << 20):
            lists = batch.column("ids")
            ends, flat = lists.offsets.to_numpy().tolist(), lists.values.to_numpy()
            texts = []
            for a, b in zip(ends, ends[1:]):
                decoder = Decoder(words.texts)
                got = [decoder.feed(flat[at : min(at + step, b)].tolist()) for at in range(a, b, step)]
                texts.append("".join([*got, decoder.end()]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{schema}, decoded string")
