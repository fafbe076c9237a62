"""Words of whole batches of texts by array operations: where they stand, and a 64-bit hash of each, without an object for any word."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

#: Random numbers by place in a word and byte: a word's hash is their sum. Longer words go through the places again, times a power.
_PLACES = 64
_TABLE = np.random.default_rng(20231).integers(0, 1 << 64, _PLACES * 256, np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Characters of words that are hashed at a time, so that arrays of a number for each character stay small however long a text is.
BLOCK = 2_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of true values; the last value is false."""
    turn = np.nonzero(np.diff(inside, prepend=False))[0]
    return turn[::2], turn[1::2] - turn[::2]


def _blocks(length: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of words with about BLOCK characters; a longer word is a range of its own."""
    ends = np.cumsum(length)
    a = 0
    while a < len(length):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BLOCK, "right")))
        yield a, b
        a = b


def byte_words(x: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the runs of bytes that are inside a word. Two words have the same hash with a probability of 2^-64."""
    start, length = runs(inside)
    h = np.empty(len(start), np.uint64)
    for a, b in _blocks(length):
        own = length[a:b]
        edge = np.cumsum(own) - own
        place = np.arange(int(own.sum())) - np.repeat(edge, own)
        at = slice(start[a], start[b - 1] + own[-1])
        part = _TABLE[(place % _PLACES << 8) + x[at][inside[at]]]
        if own.max() > _PLACES:
            power = np.cumprod(np.append(np.uint64(1), np.full(int(own.max()) // _PLACES, _ODD)), dtype=np.uint64)
            part = part * power[place // _PLACES]
        h[a:b] = mix(np.add.reduceat(part, edge) ^ own.astype(np.uint64))
    return start, h


@lru_cache
def points_like(pattern: str) -> np.ndarray:
    """Which code points match a pattern for one character, made once in a process. Patterns with a property (\\p) are those of the regex
    library; in others a word character is what Python's own says, without combining marks."""
    if r"\p" in pattern:
        import regex as engine
    else:
        engine = re
    table = np.zeros(0x110000, bool)
    for a, b in ((0, 0xD800), (0xE000, 0x110000)):
        for m in engine.finditer(f"(?:{pattern})+", "".join(map(chr, range(a, b)))):
            table[a + m.start() : a + m.end()] = True
    return table


@dataclass
class Words:
    """The words, or parts of longer words, of some texts, one behind the other."""

    points: np.ndarray  # code points of all texts
    start: np.ndarray
    length: np.ndarray
    begins: np.ndarray  # whether it begins a word
    hash: np.ndarray
    per_text: np.ndarray  # their number in each text

    def rows(self, which: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """The words at these places, of one length at a time and of at most about `most` characters: (indexes into `which`, points,
        whether they begin a word)."""
        kind = 2 * self.length[which] + self.begins[which]
        order = np.argsort(kind, kind="stable")
        edge = [0, *(np.nonzero(np.diff(kind[order]))[0] + 1).tolist(), len(order)]
        for a, b in zip(edge, edge[1:], strict=False):
            if a == b:
                continue
            length, begins = divmod(int(kind[order[a]]), 2)
            step = max(1, most // (length + 1))
            for k in range(a, b, step):
                at = order[k : min(k + step, b)]
                yield at, self.points[self.start[which[at]][:, None] + np.arange(length)], bool(begins)

    def texts(self, which: np.ndarray) -> list[str]:
        """The words at these places as texts."""
        return [self.points[s : s + n].tobytes().decode("utf-32-le") for s, n in zip(self.start[which].tolist(), self.length[which].tolist(), strict=True)]


def words_of(texts: list[str], pattern: str, max_len: int | None = None) -> Words:
    """Runs of characters like `pattern` in the texts in lower case; a run of more than max_len is read in parts of that length."""
    lower = [t.lower() for t in texts]
    points = np.frombuffer(" ".join([*lower, ""]).encode("utf-32-le", "replace"), np.uint32)
    start, length = runs(points_like(pattern)[points])
    after = np.cumsum([len(t) + 1 for t in lower])
    begins = np.ones(len(start), bool)
    if max_len:
        parts = -(-length // max_len)
        of = np.repeat(np.arange(len(start)), parts)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
        start, length, begins = start[of] + max_len * nth, np.minimum(length[of] - max_len * nth, max_len), nth == 0
    power = np.cumprod(np.full(int(length.max(initial=1)), _ODD), dtype=np.uint64)
    h = np.empty(len(start), np.uint64)
    for a, b in _blocks(length):
        own = length[a:b]
        edge = np.cumsum(own) - own
        place = np.arange(int(own.sum())) - np.repeat(edge, own)
        letters = (points[np.repeat(start[a:b], own) + place].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        letters = (letters ^ (letters >> np.uint64(29))) * power[place]
        h[a:b] = mix(np.add.reduceat(letters, edge) ^ (own * 2 + begins[a:b]).astype(np.uint64))
    return Words(points, start, length, begins, h, np.diff(np.append(0, np.searchsorted(start, after))))


class Slots:
    """A number for each distinct hash, by order of coming."""

    def __init__(self):
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Their numbers, -1 for those that are not here."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.numbers[at], -1)

    def add(self, keys: np.ndarray) -> None:
        """Distinct keys that are not here."""
        numbers = np.arange(len(self.keys), len(self.keys) + len(keys))
        keys, numbers = np.append(self.keys, keys), np.append(self.numbers, numbers)
        order = np.argsort(keys)
        self.keys, self.numbers = keys[order], numbers[order]
