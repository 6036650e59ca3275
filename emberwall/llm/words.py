"""Words, lines and their hashes for many texts at once, by array operations.

Words are maximal runs of bytes other than space and \\x09 to \\x0d. A word is
known by a 64-bit hash; two words of one text share it by chance with odds of
about 1 in 10^19.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LOWER = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
)
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Hashes of any spans of a byte array: sums of a number per byte value times
    a power of an odd base, modulo 2^64, brought back to the start of the span."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(0, 2**64, 256, dtype=np.uint64)
        self.base = int(rng.integers(0, 2**62)) * 4 + 3
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, CHUNK_BYTES + 1)
            for name, base in (("powers", self.base), ("inverses", pow(self.base, -1, 2**64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums, one longer than ``data``."""
        self._grow(len(data) + 1)
        out = np.empty(len(data) + 1, np.uint64)
        out[0] = 0
        terms = self.values[data]
        terms *= self.powers[: len(data)]
        np.cumsum(terms, out=out[1:])
        return out

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (sums[ends] - sums[starts]) * self.inverses[starts]
        return mix(raw + (ends - starts).astype(np.uint64))


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


@dataclass
class Chunk:
    """Texts ``first`` to ``last`` of a list, joined by newlines."""

    first: int
    last: int
    data: np.ndarray  # bytes
    offsets: np.ndarray  # where each text starts; one more than texts
    space: np.ndarray  # per byte
    starts: np.ndarray  # of words
    ends: np.ndarray
    sums: np.ndarray
    hasher: Hasher

    @property
    def word_offsets(self) -> np.ndarray:
        """Number of the first word of each text; one more than texts."""
        return np.searchsorted(self.starts, self.offsets)

    def word_hashes(self) -> np.ndarray:
        return self.hasher.spans(self.sums, self.starts, self.ends)

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        """How many bytes of each text are marked."""
        total = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
        return np.diff(total[self.offsets])


def chunks(texts: list[bytes], hasher: Hasher, lower: bool = False):
    """Split into chunks of about ``CHUNK_BYTES``, never inside a text."""
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) < CHUNK_BYTES):
            size += len(texts[last]) + 1
            last += 1
        part = texts[first:last]
        joined = b"\n".join(part) + b"\n"
        if lower:
            joined = joined.translate(LOWER)
        data = np.frombuffer(joined, np.uint8)
        offsets = np.concatenate(([0], np.cumsum([len(x) + 1 for x in part])))
        space = _SPACE[data]
        edges = np.concatenate(([True], space, [True])).view(np.int8)
        bounds = np.flatnonzero(np.diff(edges))
        yield Chunk(
            first, last, data, offsets, space, bounds[::2], bounds[1::2],
            hasher.sums(data), hasher,
        )
        first = last


def owners(offsets: np.ndarray) -> np.ndarray:
    """Number of the text that each element between the offsets belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def seen_twice(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    if not len(keys):
        return np.zeros(0, bool)
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    out = np.zeros(len(keys), bool)
    out[order] = np.concatenate(([False], same)) | np.concatenate((same, [False]))
    return out


def distinct_per_text(keys: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """How many different keys each of ``n`` texts has; keys tell texts apart."""
    if not len(keys):
        return np.zeros(n, np.int64)
    order = np.argsort(keys)
    ranked = keys[order]
    first = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    return np.bincount(text[order][first], minlength=n)


def repeated_words(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Places of the words in three-word runs that occur twice or more in a text."""
    if len(hashes) < 3:
        return np.zeros(0, np.int64)
    run = mix(hashes[:-2] + mix(hashes[1:-1] + mix(hashes[2:])))
    run = mix(run + mix(owner[:-2].astype(np.uint64)))
    at = np.flatnonzero(owner[2:] == owner[:-2])
    marked = np.zeros(len(hashes), bool)
    starts = at[seen_twice(run[at])]
    for shift in range(3):
        marked[starts + shift] = True
    return np.flatnonzero(marked)
