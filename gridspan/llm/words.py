"""Words and word hashes of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bytes between words of `[^\x20\x09-\x0D]+`, and of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`
#: once A-Z are lower-cased.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
NON_WORD = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

#: Odd multipliers of the polynomial hashes modulo 2^64.
_BYTE, _WORD = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The byte multiplier's powers and their inverses, kept at the largest size used."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, base in (("up", _BYTE), ("down", pow(_BYTE, -1, 1 << 64))):
            table = np.full(size, np.uint64(base))
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all output bits."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@dataclass
class Words:
    """All words of some texts: where they start and end in `data`, and which text has which."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each text the index of its first word, and at the end the number of words

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return span_hashes(self.data, self.starts, self.ends)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, from prefix sums of one polynomial."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def words(texts: list[bytes], between: bytes = SPACES) -> Words:
    """Words of UTF-8 texts with A-Z lower-cased; `between` are the bytes outside words."""
    blob = (b"\n".join(texts) + b"\n").lower()
    data = np.frombuffer(blob, np.uint8)
    outside = np.zeros(256, bool)
    outside[list(between)] = True
    gap = outside[data]
    previous = np.concatenate([[True], gap[:-1]])
    starts, ends = np.flatnonzero(~gap & previous), np.flatnonzero(gap & ~previous)
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def gram_hashes(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive words; entry i starts at word i, whatever its text."""
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * np.uint64(_WORD) + word_hashes[j : n + j]
    return mixed(total + np.uint64(k))


def shingles(table: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, number per text) of all k-word shingles; a shorter text is one shingle.

    A text without words has none.
    """
    hashes, counts = table.hashes(), table.counts
    number = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out = np.empty(int(number.sum()), np.uint64)
    place = np.concatenate([[0], np.cumsum(number)])
    full = np.flatnonzero(counts >= k)
    grams = gram_hashes(hashes, k)
    if len(full):
        runs = number[full]
        shift = np.repeat(table.first[full] - (np.cumsum(runs) - runs), runs)
        into = np.repeat(place[full] - (np.cumsum(runs) - runs), runs)
        steps = np.arange(int(runs.sum()))
        out[into + steps] = grams[shift + steps]
    for i in np.flatnonzero((counts > 0) & (counts < k)):
        own = hashes[table.first[i] : table.first[i + 1]]
        out[place[i]] = gram_hashes(own, len(own))[0]
    return out, number
