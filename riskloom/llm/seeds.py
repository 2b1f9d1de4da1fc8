"""Minimisers of byte windows: where equal strings of ``LENGTH`` bytes must meet."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A window of LENGTH bytes is represented by the one of its GRAM-byte strings that hashes lowest.
LENGTH, GRAM = 50, 24
_BASE = 0x9E3779B97F4A7C15
_MIX = 0xD6E8FEB86659FD93


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes that begin at each place."""
    h1 = data.astype(np.uint64) + np.uint64(1)
    h2 = h1[:-1] * _power(1) + h1[1:]
    h4 = h2[:-2] * _power(2) + h2[2:]
    h8 = h4[:-4] * _power(4) + h4[4:]
    h16 = h8[:-8] * _power(8) + h8[8:]
    h = h16[:-8] * _power(8) + h8[16:]
    h ^= h >> np.uint64(29)
    h *= np.uint64(_MIX)
    h ^= h >> np.uint64(32)
    return h


def windows_by_seed(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text number, first window, last window + 1, place of the lowest gram, its hash) of each run
    of windows that share their lowest gram. Every window of every text is in exactly one run."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, none.astype(np.uint64)
    hashes = gram_hashes(data)
    # the place in the low half breaks ties to the left
    low = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    span = LENGTH - GRAM + 1
    width = 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    place = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)  # by window start
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(place)]
    valid = np.arange(len(place)) + LENGTH <= (begins + sizes)[owner]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    new |= ~valid
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(place))
    real = valid[starts]
    starts, ends = starts[real], ends[real]
    who = owner[starts]
    grams = place[starts]
    return who, starts - begins[who], ends - begins[who], grams - begins[who], hashes[grams]


def blocks(texts: list[bytes], size: int = 1 << 20):
    """``windows_by_seed`` over blocks of texts, long ones in parts that share LENGTH - 1 bytes."""
    some: list[bytes] = []
    number: list[int] = []
    shift: list[int] = []
    held = 0

    def found():
        who, first, last, gram, hashes = windows_by_seed(some)
        at = np.array(shift, np.int64)[who]
        return np.array(number, np.int64)[who], first + at, last + at, gram + at, hashes

    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), size):
            part = text[at : at + size + LENGTH - 1]
            some.append(part)
            number.append(i)
            shift.append(at)
            held += len(part)
            if held >= size:
                yield found()
                some, number, shift, held = [], [], [], 0
    if some:
        yield found()
