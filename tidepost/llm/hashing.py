"""Vectorised hashes of words and word n-grams, over slices of bounded size."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words are what stands between ASCII white space.
WHITE_SPACE = np.zeros(256, bool)
WHITE_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Words are runs of ASCII letters and digits and of any other characters beyond ASCII.
PUNCTUATION = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])

M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
LONG_WORD = 256
PART_BYTES = 1 << 20


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * M1
    values = (values ^ (values >> np.uint64(29))) * M2
    return values ^ (values >> np.uint64(32))


def hash_words(data: bytes, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``data`` and where they start."""
    codes = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(codes) + 2, bool)
    inside[1:-1] = ~separators[codes]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, lengths = edges[0::2], edges[1::2] - edges[0::2]
    padded = np.frombuffer(data + bytes(8), np.uint8)
    eights = np.ndarray((len(codes) + 1,), "<u8", padded, strides=(1,))
    out = lengths.astype(np.uint64) * M2
    active = np.arange(len(starts))
    for k in range(0, min(int(lengths.max(initial=0)), LONG_WORD), 8):
        active = active[lengths[active] > k]
        left = np.minimum(lengths[active] - k, 8).astype(np.uint64)
        chunk = eights[starts[active] + k] & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * left))
        out[active] = mixed(out[active] ^ chunk)
    for i in np.flatnonzero(lengths > LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : starts[i] + lengths[i]])
    return out, starts


def text_words(data: bytes, separators: np.ndarray) -> np.ndarray:
    """Word hashes of one text of any length, read in parts that end at a space or line end."""
    parts, at = [], 0
    while at < len(data):
        end = len(data)
        if end - at > PART_BYTES:
            ends = [x for x in (data.find(b" ", at + PART_BYTES), data.find(b"\n", at + PART_BYTES)) if x >= 0]
            end = min(ends, default=end)
        parts.append(hash_words(data[at:end], separators)[0])
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def words_by_text(texts: list[bytes], separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of several texts in a row, and the bounds of each text in them."""
    if len(texts) == 1:
        words = text_words(texts[0], separators)
        return words, np.array([0, len(words)])
    words, starts = hash_words(b"\n".join(texts), separators)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return words, np.concatenate([[0], np.searchsorted(starts, ends)])


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every ``n`` consecutive words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = (out + words[k : len(words) - n + 1 + k]) * M1
        out ^= out >> np.uint64(31)
    return mixed(out)
