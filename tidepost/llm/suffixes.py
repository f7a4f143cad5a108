"""Suffix arrays by two-stage sorting, for the texts of one task.

Only suffixes smaller than their successors are sorted directly. All others are induced: buckets
of first bytes are scanned in order, and each suffix found hands its predecessor, if that is the
larger of the two, to the end of the predecessor's bucket. Common prefixes of neighbours follow.
"""

from __future__ import annotations

import numpy as np

END = 0


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols (bytes plus one, each text followed by ``END``), starts and ends of the texts."""
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)
    symbols = np.frombuffer(b"\0".join([*texts, b""]), np.uint8).astype(np.int16) + 1
    symbols[starts + lengths] = END
    return symbols, starts, starts + lengths


def smaller_than_next(symbols: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one that starts a symbol later; true at an end."""
    step = np.sign(np.diff(symbols, append=np.int16(32767)))
    step[symbols == END] = 1
    decided = np.where(step != 0, np.arange(len(step)), len(step))
    nearest = np.minimum.accumulate(decided[::-1])[::-1]
    return step[np.minimum(nearest, len(step) - 1)] > 0


def suffix_array(texts: list[bytes], wanted: np.ndarray) -> np.ndarray:
    """Sorted starts in :func:`join_texts` of the first ``wanted[i]`` suffixes of each text.

    Equal suffixes of different texts are neighbours in the order of their texts.
    """
    symbols, starts, ends = join_texts(texts)
    data = b"\0".join([*texts, b""])
    small = smaller_than_next(symbols)
    # Inducing needs the successors up to the next directly sorted suffix.
    at = np.arange(len(symbols))
    next_small = np.minimum.accumulate(np.where(small, at, len(at))[::-1])[::-1]
    last = next_small[np.minimum(starts + np.maximum(wanted, 1) - 1, ends)]
    part = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(part, starts, 1)
    np.add.at(part, last + 1, -1)
    used = np.cumsum(part[:-1]) > 0
    text_of = np.repeat(np.arange(len(texts)), ends - starts + 1)
    direct = np.flatnonzero(used & small)
    by_symbol = direct[np.argsort(symbols[direct], kind="stable")]
    bounds = np.searchsorted(symbols[by_symbol], np.arange(258))
    stop = ends[text_of]
    pending: list[list[np.ndarray]] = [[] for _ in range(257)]
    order = []

    def hand_on(found: np.ndarray) -> None:
        before = found[found > 0] - 1
        before = before[used[before] & ~small[before]]
        to = symbols[before]
        by = np.argsort(to, kind="stable")
        before, to = before[by], to[by]
        edges = np.flatnonzero(np.diff(to, prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            pending[to[a]].append(before[a:b])

    for symbol in range(257):
        while pending[symbol]:  # runs of one symbol come back to their own bucket
            wave = np.concatenate(pending[symbol])
            pending[symbol] = []
            order.append(wave)
            hand_on(wave)
        own = by_symbol[bounds[symbol] : bounds[symbol + 1]].tolist()
        if own:
            stops = stop[own].tolist()
            keys = [data[i:j] for i, j in zip(own, stops, strict=True)]
            ranked = np.array(own)[sorted(range(len(own)), key=keys.__getitem__)]
            order.append(ranked)
            hand_on(ranked)
    found = np.concatenate(order) if order else np.zeros(0, np.int64)
    return found[found - starts[text_of[found]] < wanted[text_of[found]]]


def common_prefixes(texts: list[bytes], order: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of each suffix in ``order`` with the one before, at most ``most``."""
    symbols, starts, ends = join_texts(texts)
    text_of = np.repeat(np.arange(len(texts)), ends - starts + 1)
    data = np.frombuffer(b"\0".join([*texts, b""]) + bytes(most + 8), np.uint8)
    eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    left, right = order[:-1], order[1:]
    limit = np.minimum(np.minimum(ends[text_of[left]] - left, ends[text_of[right]] - right), most)
    out = limit.copy()
    active = np.arange(len(left))
    for k in range(0, most, 8):
        active = active[limit[active] > k]
        if not len(active):
            break
        apart = eights[left[active] + k] ^ eights[right[active] + k]
        stop = apart != 0
        lowest = apart[stop] & (~apart[stop] + np.uint64(1))
        same = (np.log2(lowest.astype(np.float64)) // 8).astype(np.int64)
        out[active[stop]] = np.minimum(limit[active[stop]], k + same)
        active = active[~stop]
    return np.concatenate([[0], out]) if len(order) else np.zeros(0, np.int64)
