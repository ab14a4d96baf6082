"""One-permutation MinHash fingerprints of whole texts.

Every shingle of five words is hashed once. The hash's upper bits choose one of BINS bins, which keeps its
smallest hash. An empty bin copies from another one, found by hashing its number and the number of the try
until a filled bin comes up (optimal densification: each try is independent, and equal for all texts). Of each
bin BITS low-order bits are stored, packed. Two texts with likeness J agree in a bin with probability
J + (1 - J) / 2**BITS; the likeness is corrected for that.

Defined results: null texts are empty ones; no words give the all-zero fingerprint; a text of fewer than five
words is one shingle. Equal texts have equal fingerprints, and equal fingerprints have likeness 1.
"""

from __future__ import annotations

import numpy as np
import xxhash

from wardline.llm.texts import parts

WORDS = 5
BINS = 256
BITS = 4
REMEMBERED = 300_000

_SHIFT = np.uint64(64 - BINS.bit_length() + 1)
_EDGES = np.arange(BINS, dtype=np.uint64) << _SHIFT
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


WORD_HASHES = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = (x ^ (x >> _HALF)) * _SECOND
    return x ^ (x >> _HALF)


def _turns() -> np.ndarray:
    """Bins to try for each bin, in order."""
    tries = np.arange(BINS * 64, dtype=np.uint64).reshape(BINS, 64)
    return (_mixed(tries + np.uint64(1)) >> _SHIFT).astype(np.intp)


TURNS = _turns()


def _least(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(smallest hash of each bin, whether there is one)."""
    hashes = np.sort(hashes)
    at = np.searchsorted(hashes, _EDGES)
    values = np.concatenate([hashes, np.zeros(1, np.uint64)])[at]
    return values, (at < len(hashes)) & (values >> _SHIFT == np.arange(BINS, dtype=np.uint64))


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    one = np.fromiter(map(WORD_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(WORDS, len(words))
    n = len(words) - size + 1
    mixed = one[:n]
    for k in range(1, size):
        mixed = (mixed ^ (mixed >> _HALF)) * _FIRST + one[k : k + n]
    return _mixed(mixed)


def fingerprint(text: str | None) -> bytes:
    """Packed low-order bits of all bins."""
    least, filled, tail = np.full(BINS, np.iinfo(np.uint64).max, np.uint64), np.zeros(BINS, bool), []
    for k, part in enumerate(parts(text or "")):
        words = part.encode("utf-8", "surrogatepass").lower().split()
        whole = tail + words
        if len(whole) < WORDS and (k or len(text or "") > len(part)):
            tail = whole  # too few words so far
            continue
        if whole:
            values, there = _least(shingle_hashes(whole))
            least = np.where(there, np.minimum(least, values), least)
            filled |= there
        tail = whole[-(WORDS - 1) :]
    if not filled.any() and tail:
        values, filled = _least(shingle_hashes(tail))
        least = values
    if not filled.any():
        return bytes(BINS * BITS // 8)
    empty = np.flatnonzero(~filled)
    if len(empty):
        options = filled[TURNS[empty]]
        found = TURNS[empty, options.argmax(axis=1)]
        # 64 tries fail for a bin about once in 10**7 texts of one shingle's sparsest kind; then the next filled bin serves
        after = np.flatnonzero(filled)
        spare = after[np.searchsorted(after, empty) % len(after)]
        least[empty] = least[np.where(options.any(axis=1), found, spare)]
    low = (least & np.uint64((1 << BITS) - 1)).astype(np.uint8).reshape(-1, 8 // BITS)
    return (low << (np.arange(8 // BITS, dtype=np.uint8) * BITS)).sum(axis=1).astype(np.uint8).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Estimated Jaccard likeness of the shingle sets behind two fingerprints, 0 to 1."""
    same = np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)
    low = sum(int(np.count_nonzero((same >> np.uint8(k)) & np.uint8((1 << BITS) - 1) == 0)) for k in range(0, 8, BITS))
    chance = 2.0**-BITS
    return min(1.0, max(0.0, (low / BINS - chance) / (1 - chance)))
