"""Byte-level BPE ids of whole texts: those that the ``tokenizers`` library gives, with words remembered.

The vocabulary merges inside pre-tokens only (a word with the blank before it, a run of digits, of
signs or of white space), so a text's ids are its pre-tokens' ids in a row. A batch of texts is cut
into pre-tokens with array operations, each pre-token is looked up by a 64-bit hash in a table of
fixed size; those not in the table are merged by ``tiktoken`` with the ranks of the same vocabulary,
which takes a sixth of the time. ``encoded`` cuts texts at the vocabulary's added tokens first and gives each its one
id, as the library does; ``Encoder.encode`` takes their strings as ordinary text, as it does with ``encode_special_tokens``.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd

OTHER, LETTER, NUMBER, WHITE = 0, 1, 2, 3
CODES = 0x110000
BATCH_CHARS = 1_000_000

# Fixed values of the vocabulary's pre-token rule: white space, and the endings cut after an apostrophe.
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def default_vocabulary() -> str:
    """Place of the public 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def text_batches(texts: Iterable[str], most: int = BATCH_CHARS) -> Iterator[list[str]]:
    """Lists of whole texts of about ``most`` characters, so that working arrays stay small."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SpanHash:
    """Hashes of many spans of one code-point array: polynomials modulo two primes (62 bits), mixed with the span's length."""

    PRIMES = (2**31 - 1, 2**31 - 19)
    BASES = (1_103_515_245, 1_812_433_253)

    def __init__(self):
        codes = np.arange(1, CODES + 2, dtype=np.uint64)
        seeds = (0xD1342543DE82EF95, 0xA0761D6478BD642F)
        with np.errstate(over="ignore"):
            self.letters = [mix64(codes * np.uint64(seed)) % np.uint64(p - 1) + np.uint64(1) for seed, p in zip(seeds, self.PRIMES, strict=True)]
        self.powers = [(np.ones(1, np.uint64), np.ones(1, np.uint64)) for _ in self.PRIMES]

    @staticmethod
    def _grown(table: np.ndarray, base: int, prime: int, size: int) -> np.ndarray:
        """Powers of the base, doubled until there are ``size``."""
        while len(table) < size:
            table = np.concatenate([table, table * np.uint64(pow(base, len(table), prime)) % np.uint64(prime)])
        return table

    def sums(self, codes: np.ndarray) -> list[np.ndarray]:
        """Running sums that ``between`` reads spans from. A sum of up to 2**32 letters doesn't overflow."""
        size = max(len(codes) + 1, 1 << 16)
        out = []
        for i, (base, prime) in enumerate(zip(self.BASES, self.PRIMES, strict=True)):
            if len(self.powers[i][0]) < size:
                up, down = self.powers[i]
                self.powers[i] = self._grown(up, base, prime, size), self._grown(down, pow(base, -1, prime), prime, size)
            total = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum(self.letters[i][codes] * self.powers[i][0][: len(codes)] % np.uint64(prime), out=total[1:])
            out.append(total)
        return out

    def between(self, sums: list[np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        first, second = (
            (total[ends] - total[starts]) % np.uint64(prime) * down[starts] % np.uint64(prime)
            for total, prime, (_, down) in zip(sums, self.PRIMES, self.powers, strict=True)
        )
        with np.errstate(over="ignore"):
            return mix64(mix64(first | second << np.uint64(31)) + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def __call__(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.between(self.sums(codes), starts, ends)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


def character_classes() -> np.ndarray:
    kinds = np.zeros(CODES, np.uint8)
    for code in range(CODES):
        first = unicodedata.category(chr(code))[0]
        if first == "L":
            kinds[code] = LETTER
        elif first == "N":
            kinds[code] = NUMBER
    kinds[WHITE_SPACE] = WHITE
    return kinds


def cut(codes: np.ndarray, kinds: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """First positions of all pre-tokens; ``text_starts`` are those of the non-empty texts."""
    n = len(codes)
    if not n:
        return np.empty(0, np.int64)
    own = kinds[codes]
    mark = np.zeros(n + 1, bool)
    mark[1:n] = own[1:] != own[:-1]
    first = np.zeros(n + 1, bool)
    first[text_starts] = True
    first[n] = True
    mark |= first
    begins = np.flatnonzero(mark[:n])
    ends = np.append(begins[1:], n)
    kind = own[begins]
    # The last white character before a word stands alone, or joins the word if it is a blank.
    inner = (kind == WHITE) & ~first[ends]
    last = ends[inner] - 1
    mark[last] = True
    blank = codes[last] == 32
    mark[last[blank] + 1] = False
    # A lone apostrophe that starts a pre-token takes an ending of the word after it.
    lone = begins[(kind == OTHER) & (ends - begins == 1) & (codes[begins] == 39) & mark[begins] & ~first[ends]]
    lone = lone[own[np.minimum(lone + 1, n - 1)] == LETTER] if len(lone) else lone
    bounds = np.flatnonzero(first)
    for at in lone.tolist():
        stop = int(bounds[np.searchsorted(bounds, at, side="right")])
        tail = "".join(map(chr, codes[at + 1 : min(at + 3, stop)].tolist()))
        for ending in ENDINGS:
            if tail.startswith(ending):
                mark[at + 1] = False
                mark[at + 1 + len(ending)] = True
                break
    return np.flatnonzero(mark[:n])


class Encoder:
    """Ids of lists of texts. ``words`` bounds the table and so the memory, not the texts."""

    SLOT_BITS = 20

    def __init__(self, path: str, words: int = 500_000):
        import tiktoken

        with open(path, encoding="utf-8") as source:
            content = json.load(source)
        cutter = content.get("pre_tokenizer") or {}
        if cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space"):
            raise ValueError("the vocabulary must be byte-level, without an added prefix blank")
        added = content.get("added_tokens") or []
        if content.get("normalizer") or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("texts can't be normalised, nor added tokens take words or blanks beside them")
        self.added = {t["content"]: t["id"] for t in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        vocabulary = content["model"]["vocab"]
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if all(c in letters for c in token)}
        ranks = {token: i for token, i in ranks.items() if not token.startswith(b"<|")}
        self.merge = tiktoken.Encoding("pieces", pat_str=r"\s+|\S+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece
        self.kinds, self.hash, self.words = character_classes(), SpanHash(), words
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(1 << self.SLOT_BITS, np.uint64)
        self.entry = np.zeros(1 << self.SLOT_BITS, np.int32)
        self.flat = np.empty(0, np.int32)
        self.offset = np.empty(0, np.int64)
        self.size = np.empty(0, np.int64)

    def _learn(self, pieces: list[str]) -> None:
        found = list(map(self.merge, pieces))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
        self.offset = np.concatenate([self.offset, len(self.flat) + np.cumsum(sizes) - sizes])
        self.flat, self.size = np.concatenate([self.flat, ids]), np.concatenate([self.size, sizes])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the bounds of each text in them (one more than texts)."""
        joined = "".join(texts)
        codes = code_points(joined)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        starts = cut(codes, self.kinds, bounds[:-1][lengths > 0])
        if not len(starts):
            return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        ends = np.append(starts[1:], len(codes))
        hashes = self.hash(codes, starts, ends)
        if len(self.size) > self.words:
            self._reset()
        slots = (hashes >> np.uint64(64 - self.SLOT_BITS)).astype(np.int64)
        entry = self.entry[slots].astype(np.int64)
        missed = np.flatnonzero((self.keys[slots] != hashes) | (hashes == 0))
        if len(missed):
            fresh, first, place = np.unique(hashes[missed], return_index=True, return_inverse=True)
            known = len(self.size)
            at = missed[first]
            self._learn([joined[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            entry[missed] = known + place
            self.keys[slots[at]], self.entry[slots[at]] = fresh, known + np.arange(len(fresh))
        sizes = self.size[entry]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        where = np.repeat(self.offset[entry] - upto[:-1], sizes) + np.arange(upto[-1])
        return self.flat[where], upto[np.searchsorted(starts, bounds)]

    def encode_added(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Like ``encode``, with one id for each added token inside a text; what lies between them is cut by itself."""
        if self.marks is None or not any(map(self.marks.search, texts)):
            return self.encode(texts)
        pieces, marks, after, firsts = [], [], [], [0]
        for text in texts:
            parts = self.marks.split(text)
            marks += [self.added[t] for t in parts[1::2]]
            after += range(len(pieces) + 1, len(pieces) + 1 + len(parts) // 2)
            pieces += parts[::2]
            firsts.append(len(pieces))
        ids, bounds = self.encode(pieces)
        before = np.searchsorted(after, firsts, side="right")
        return np.insert(ids, bounds[after], marks), bounds[firsts] + before


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a worker process, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(texts: pd.Series, path: str, added: bool = True) -> Iterator[tuple[int, np.ndarray]]:
    """Position and ids of every text in order; null counts as empty. Without ``added``, added tokens are ordinary text."""
    own, row = encoder(path), 0
    for batch in text_batches(t if isinstance(t, str) else "" for t in texts):
        ids, bounds = own.encode_added(batch) if added else own.encode(batch)
        for k in range(len(batch)):
            yield row + k, ids[bounds[k] : bounds[k + 1]]
        row += len(batch)


def release_memory() -> None:
    """Give back what a worker has freed: workers live on, idle or in stages of other operators, and would keep it."""
    import ctypes

    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def release_encoders() -> None:
    """Drop the tables of words after a task, too."""
    _encoders.clear()
    release_memory()


def tidy(run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """``run`` over batches, giving memory back after each batch and at the end of the task."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame
            del frame
            release_memory()

    def tidied(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from run(each(frames))
        release_memory()

    return tidied
