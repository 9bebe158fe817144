"""Words and word shingles of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of ASCII digits, ASCII letters (lower-cased) and all non-ASCII characters.
Texts become one byte buffer, so that no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: Lower-cases A-Z; every byte outside words becomes a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: Texts are taken together until they hold so many bytes, which bounds the arrays.
CHUNK_BYTES = 2 << 20

_powers = np.zeros(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, of: int) -> np.ndarray:
    """``n`` fixed odd multipliers; ``of`` tells families apart."""
    start = np.uint64((of * 0x9E3779B97F4A7C15 + 1) % 2**64)
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + start) | np.uint64(1)


def _position_powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = seeds(max(64, 2 * n), 1)
    return _powers


def encode(text: str | None) -> bytes:
    return text.encode("utf-8", "replace") if text else b""


def chunks(texts: Sequence[str | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Index of the first text, and the encoded texts, of each chunk."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append(encode(text))
        size += len(held[-1])
        if size >= limit:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


class Words:
    """Words of encoded texts: byte ``starts`` and ``lengths``, and ``offsets`` of each text's first word."""

    def __init__(self, encoded: Sequence[bytes], table: bytes = WORD_BYTES):
        joined = b" ".join(b.translate(table) for b in encoded) + b" "
        self.bytes = np.frombuffer(joined, np.uint8)
        inside = self.bytes != 32
        change = np.flatnonzero(np.diff(inside, prepend=False))
        self.starts, ends = change[0::2], change[1::2]
        self.lengths = ends - self.starts
        begin = np.cumsum([0] + [len(b) + 1 for b in encoded])
        self.offsets = np.searchsorted(self.starts, begin)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def owner(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def hashes(self, prefix: int | None = None) -> np.ndarray:
        """Hash of each word, or of its first ``prefix`` bytes."""
        if not len(self):
            return np.zeros(0, np.uint64)
        lengths = self.lengths if prefix is None else np.minimum(self.lengths, prefix)
        first = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        taken = self.bytes[place + np.repeat(self.starts, lengths)].astype(np.uint64) + np.uint64(1)
        total = np.add.reduceat(taken * _position_powers(int(lengths.max()))[place], first)
        return mix(total + lengths.astype(np.uint64))


def shingles(hashes: np.ndarray, offsets: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of ``n`` words, in order, and their offsets.

    A text of fewer words, but not none, has one shingle of all its words.
    """
    counts = np.diff(offsets)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    where = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(where[-1], np.uint64)
    factor = seeds(n, 2)
    long = np.flatnonzero(counts >= n)
    if len(long):
        runs = len(hashes) - n + 1
        total = np.zeros(runs, np.uint64)
        for j in range(n):
            total += hashes[j : j + runs] * factor[j]
        size = sizes[long]
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[step + np.repeat(where[:-1][long], size)] = mix(total[step + np.repeat(offsets[:-1][long], size)])
    for i in np.flatnonzero((counts > 0) & (counts < n)):
        own = hashes[offsets[i] : offsets[i + 1]]
        out[where[i]] = mix((own * factor[: len(own)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(own)))[0]
    return out, where
