"""BagMinHash signatures of word shingles: unbiased for weighted Jaccard similarity.

A text is the multiset of its five-word shingles, a shingle's weight the times it occurs. Weights are discretised
at the whole numbers, and the levels are grouped into dyadic blocks [0,1), [1,2), [2,4), [4,8), ...
Every (shingle, block) has a Poisson process of its own whose rate is the block's length; each point
carries a time, a component of the signature and a level in the block. A point counts where its
level lies below the shingle's weight, so texts with different weights see thinned versions of the
same process. A component of the signature is the earliest counting point, and two texts agree in it with probability
equal to the sum of minimum weights over the sum of maximum weights.

Points come in order of time, so a process is dropped as soon as its next point is later than the
latest component found so far; all processes of a text advance together as arrays.
"""

from __future__ import annotations

from functools import cache

import numpy as np

from cargolens.llm.common import utf8

SHINGLE = 5
BANDS, ROWS = 25, 5  # at similarity 0.8 a pair shares no band with probability 5e-5
COMPONENTS = BANDS * ROWS
SKETCH = -(-COMPONENTS // 7)  # numbers of a sketch

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def unit(bits: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1] from 64 random bits."""
    return ((bits >> np.uint64(11)).astype(float) + 1) * 2.0 ** -53


@cache
def powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 2^bits powers of an odd base modulo 2^64, and of its inverse."""
    base = int(GOLDEN)
    return tuple(np.multiply.accumulate(np.concatenate(
        [np.ones(1, np.uint64), np.full((1 << bits) - 1, b, np.uint64)]))
        for b in (base, pow(base, -1, 1 << 64)))


def word_hashes(text: str | bytes | None) -> np.ndarray:
    """64-bit hashes of a text's words, which end at the six ASCII white space characters."""
    raw = text if isinstance(text, bytes) else utf8(text or "")
    data = np.frombuffer(raw, np.uint8)
    inside = (data != 32) & ((data < 9) | (data > 13))
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    up, down = powers(max(16, len(data).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def shingle_hashes(hashes: np.ndarray) -> np.ndarray:
    """Hashes of all runs of five words; a shorter text is one run."""
    width = min(SHINGLE, len(hashes))
    n = len(hashes) - width + 1
    out = np.full(n, np.uint64(width))
    for k in range(width):
        out = mixed(out * GOLDEN + hashes[k:k + n])
    return out


def processes(shingles: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Owner, seed, low end, length and weight limit of every process of some texts."""
    owner = np.repeat(np.arange(len(shingles)), [len(s) for s in shingles])
    flat = np.concatenate(shingles)
    order = np.lexsort((flat, owner))
    flat, owner = flat[order], owner[order]
    first = np.flatnonzero(np.concatenate(
        [[True], (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])]))
    weight = np.diff(np.append(first, len(flat)))
    flat, owner = flat[first], owner[first]
    parts, low, length = [], 0, 1
    while len(flat):
        salt = np.uint64((int(GOLDEN) * (low + 1)) & (2 ** 64 - 1))
        parts.append((owner, mixed(flat + salt), np.full(len(flat), float(low)),
                      np.full(len(flat), float(length)), weight.astype(float)))
        low, length = low + length, low + length
        more = weight > low
        flat, owner, weight = flat[more], owner[more], weight[more]
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def signatures(shingles: list[np.ndarray], size: int = COMPONENTS) -> np.ndarray:
    """64-bit components of the signatures of some multisets of hashes, none of them empty."""
    out = np.zeros((len(shingles), size), np.uint64)
    # Small multisets need many points of each process, so they draw several at once.
    for least, most, points in ((0, 16, 64), (16, 128, 8), (128, 1 << 62, 1)):
        own = [k for k, s in enumerate(shingles) if least <= len(s) < most]
        if own:
            out[own] = together([shingles[k] for k in own], size, points)
    return out


def together(shingles: list[np.ndarray], size: int, points: int) -> np.ndarray:
    owner, seed, low, length, limit = processes(shingles)
    best = np.full(len(shingles) * size, np.inf)
    mark = np.zeros(len(shingles) * size, np.uint64)
    time, step = np.zeros(len(seed)), 0
    while len(seed):
        latest = best.reshape(-1, size).max(1)
        serial = np.arange(step, step + points, dtype=np.uint64) * np.uint64(3)
        state = seed[:, None] + serial * GOLDEN
        times = time[:, None] + np.cumsum(-np.log(unit(mixed(state))), 1) / length[:, None]
        draw = mixed(state + GOLDEN)
        counts = times < latest[owner][:, None]
        tall = np.flatnonzero(low + length > limit)  # blocks that reach above the weight
        if len(tall):
            level = low[tall, None] + unit(mixed(state[tall] + GOLDEN + GOLDEN)) * length[tall, None]
            counts[tall] &= level <= limit[tall, None]
        row, _ = np.nonzero(counts)
        when, what = times[counts], draw[counts]
        at = owner[row] * size + ((what >> np.uint64(33)) % np.uint64(size)).astype(np.int64)
        np.minimum.at(best, at, when)
        earliest = when == best[at]
        mark[at[earliest]] = what[earliest]
        time, step = times[:, -1], step + points
        going = time < best.reshape(-1, size).max(1)[owner]
        owner, seed, low, length, limit, time = (
            x[going] for x in (owner, seed, low, length, limit, time))
    # The point itself is the component; its time may differ in the last bit between batches.
    return mark.reshape(-1, size)


def bands(components: np.ndarray) -> np.ndarray:
    """A 64-bit hash per text and band; the band's number is part of it."""
    table = components.reshape(-1, BANDS, ROWS)
    out = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(table), 1))
    for k in range(ROWS):
        out = mixed(out * GOLDEN + table[:, :, k])
    return out


def sketches(components: np.ndarray) -> np.ndarray:
    """Eight bits of every component, seven components to a number, so that numbers stay positive."""
    small = np.zeros((len(components), SKETCH * 7), np.uint64)
    small[:, :components.shape[1]] = components & np.uint64(255)
    return (small.reshape(-1, SKETCH, 7) << np.arange(0, 56, 8, dtype=np.uint64)).sum(
        2, dtype=np.uint64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted arrays, as multisets."""
    if not len(a) or not len(b):
        return 0.0
    left, left_n = np.unique(a, return_counts=True)
    right, right_n = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(left, right, assume_unique=True, return_indices=True)
    shared = int(np.minimum(left_n[i], right_n[j]).sum())
    return shared / (len(a) + len(b) - shared)
