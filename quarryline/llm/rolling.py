"""Vectorised Rabin-Karp hashes of word windows.

Word values are polynomials over the word's bytes and window values polynomials over word
values, both modulo 2**64 with odd bases, so that any range comes out of one prefix sum times an
inverse power. Random byte values and a final mixer spread the bits.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

#: Word separators: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: All of ASCII that is neither letter nor digit.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

_BYTE_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xD1342543DE82EF95 | 1
_BYTES = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
#: Bytes worked on at a time, and the length from which a word is hashed whole by XXH64.
CHUNK = 1 << 21
LONG_WORD = 1 << 16


@lru_cache(maxsize=2)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse; sizes are rounded up so that tables are reused."""
    return _powers(base, max(CHUNK + LONG_WORD, 1 << max(0, size - 1).bit_length()))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 (changes its argument)."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _hash_chunk(data: np.ndarray, raw: bytes, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start offset and hash of each word of a piece that ends between words."""
    edge = np.empty(len(data) + 2, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = separators[data]
    change = np.flatnonzero(edge[1:] != edge[:-1])
    start, end = change[::2], change[1::2]
    if len(data) > CHUNK + LONG_WORD:  # one word longer than a chunk
        return start, np.array([xxhash.xxh64_intdigest(raw[s:e]) for s, e in zip(start, end)], np.uint64)
    power, inverse = powers(_BYTE_BASE, CHUNK)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * power[: len(data)], out=total[1:])
    value = mix((total[end] - total[start]) * inverse[start])
    for k in np.flatnonzero(end - start > LONG_WORD):
        value[k] = xxhash.xxh64_intdigest(raw[start[k] : end[k]])
    return start, value


def word_hashes(texts: list[bytes], separators: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of each text, in order, and the offset of each text's first word (one more at the end)."""
    values: list[np.ndarray] = []
    counts = np.zeros(len(texts), np.int64)
    held: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal held, size
        if held:
            raw = b"\n".join([texts[k] for k in held]) + b"\n"
            data = np.frombuffer(raw, np.uint8)
            start, value = _hash_chunk(data, raw, separators)
            ends = np.cumsum([len(texts[k]) + 1 for k in held])
            upto = np.searchsorted(start, ends)
            counts[held] += np.diff(upto, prepend=0)
            values.append(value)
        held, size = [], 0

    for k, text in enumerate(texts):
        if len(text) > CHUNK:
            flush()
            data = np.frombuffer(text, np.uint8)
            at = 0
            while at < len(text):
                to = min(len(text), at + CHUNK)
                while to < len(text) and not separators[text[to]]:
                    near = np.flatnonzero(separators[data[to : to + CHUNK]])
                    to = to + int(near[0]) if len(near) else min(len(text), to + CHUNK)
                piece = text[at:to]
                _, value = _hash_chunk(data[at:to], piece, separators)
                values.append(value)
                counts[k] += len(value)
                at = to
            continue
        if size + len(text) > CHUNK:
            flush()
        held.append(k)
        size += len(text) + 1
    flush()
    return np.concatenate(values) if values else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(counts)])


def window_hashes(words: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, first word within the text) of each window of ``length`` words that lies in one text."""
    n = np.diff(offsets)
    windows = np.maximum(n - length + 1, 0)
    text = np.repeat(np.arange(len(n)), windows)
    first = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    at = first + offsets[:-1][text]
    # a sum over `length` words by Horner steps is cheaper than long power tables
    value = np.zeros(len(at), np.uint64)
    for j in range(length):
        value *= np.uint64(_WORD_BASE)
        value += words[at + j]
    return mix(value), text, first


def anchors(words: np.ndarray, offsets: np.ndarray, length: int, width: int) -> np.ndarray:
    """For each window of ``length`` words, the least hash among its runs of ``width`` words.

    Equal windows have equal anchors, and neighbouring windows mostly share one. The hashes are
    independent of those of ``window_hashes``.
    """
    n = np.diff(offsets)
    if len(words) < length:
        return np.zeros(0, np.uint32)
    total = np.zeros(len(words) - width + 1, np.uint32)
    mixed = (words >> np.uint64(32)).astype(np.uint32)
    for j in range(width):
        total *= np.uint32(0x9E3779B1)
        total += mixed[j : len(mixed) - width + 1 + j]
    total ^= total >> np.uint32(15)
    total *= np.uint32(0x85EBCA6B)
    total ^= total >> np.uint32(13)
    span = length - width + 1
    least, have = total, 1
    while have < span:  # doubling: the least of `have` neighbours becomes that of up to twice as many
        step = min(have, span - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    windows = np.maximum(n - length + 1, 0)
    starts = np.repeat(offsets[:-1], windows)
    return least[starts + np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)]


def shingle_hashes(texts: list[bytes], width: int, separators: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's word shingles in order, and offsets by text; fewer words than ``width`` make one shingle."""
    value, offsets = word_hashes(texts, separators)
    n = np.diff(offsets)
    hashes, _, _ = window_hashes(value, offsets, width)
    counts = np.maximum(n - width + 1, 0)
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):  # told apart by their length
        parts = np.split(hashes, np.cumsum(counts)[:-1])
        for k in short:
            whole, _, _ = window_hashes(value[offsets[k] : offsets[k + 1]], np.array([0, n[k]]), int(n[k]))
            parts[k] = mix(whole + np.uint64(n[k]))
        hashes = np.concatenate(parts)
        counts[short] = 1
    return hashes, np.concatenate([[0], np.cumsum(counts)])
