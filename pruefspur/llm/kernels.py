"""Vector arithmetic on the texts of one Arrow batch, used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

U = np.uint64
#: Odd multipliers and the seed of the byte table; any fixed values do.
_BYTE_STEP, _WORD_STEP, _GOLDEN = U(0x9E6C63D0876A9A47), U(0xD6E8FEB86659FD93), U(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes hashed at once; a cut falls on white space, so a longer word stays whole.
PIECE = 1 << 21
SHINGLE = 5


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _step(k: int) -> np.uint64:
    return U(k * int(_GOLDEN) & 0xFFFFFFFFFFFFFFFF)


def _powers(step: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    if n:
        out[0] = 1
        out[1:] = step
        np.multiply.accumulate(out, out=out)
    return out


def _piece_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and hash of each word of a piece that ends in white space."""
    inside = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    length = ends - starts
    place = np.arange(len(data)) - np.repeat(
        np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(data)]]))
    )
    powers = _powers(_BYTE_STEP, int(length.max()) + 1)
    value = _BYTES[data] * powers[np.minimum(place, len(powers) - 1)]
    value[~inside] = 0
    return starts, mix(np.add.reduceat(value, starts) + length.astype(np.uint64))


def words(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (bytes but ASCII white space), and the bounds of each text's words."""
    joined = b"\n".join(texts) + b"\n"
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    data = np.frombuffer(joined, np.uint8)
    starts, hashes, at = [], [], 0
    while at < len(data):
        stop = min(len(data), at + PIECE)
        while not _SPACE[data[stop - 1]]:
            stop += 1
        s, h = _piece_words(data[at:stop])
        starts.append(s + at)
        hashes.append(h)
        at = stop
    bounds = np.searchsorted(np.concatenate(starts), begins)
    return np.concatenate(hashes), bounds


def shingle_sets(texts: Sequence[str | None], size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Per text the sorted hashes of its distinct word shingles: the contract's set.  A text of fewer
    words has its whole word sequence as its one shingle, one without words none."""
    hashes, bounds = words([(t or "").encode("utf-8", "surrogatepass").lower() for t in texts])
    factors = _powers(_WORD_STEP, size)
    n = max(0, len(hashes) - size + 1)
    rolled = np.zeros(n, np.uint64)
    for k in range(size):
        rolled += hashes[k : n + k] * factors[k]
    rolled = mix(rolled)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= size:
            yield np.unique(rolled[a : b - size + 1])
        elif b > a:
            short = hashes[a:b] * factors[: b - a]
            yield mix(np.add.reduce(short, keepdims=True) + _step(int(b - a)))
        else:
            yield np.empty(0, np.uint64)


def super_minhash(sets: Sequence[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures, a row per set.

    Element x goes to a random permutation of the m slots; the slot at rank j gets the value
    ``j + r`` with r below 1.  Ranks of one element are correlated, which lowers the variance.  All
    elements take rank 0, then rank 1, and so on; a set stops as soon as each of its slots holds a
    value below the next rank, since no later value can be smaller.
    """
    top = U(m) << U(32)
    out = np.full((len(sets), m), top, np.uint64)
    if not sets:
        return out
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    x = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    order = np.tile(np.arange(m, dtype=np.uint16 if m > 256 else np.uint8), (len(x), 1))
    for j in range(m):
        if not len(x):
            break
        rand = mix(x + _step(j + 1))
        at = np.arange(len(x))
        k = j + (((rand >> U(32)) * U(m - j)) >> U(32)).astype(np.int64)
        slot = order[at, k]
        order[at, k] = order[:, j]
        np.minimum.at(flat, owner * m + slot, (U(j) << U(32)) | (rand & U(0xFFFFFFFF)))
        open_sets = out.max(axis=1) >= U(j + 1) << U(32)
        live = open_sets[owner]
        if not live.all():
            x, owner, order = x[live], owner[live], order[live]
    return out


def spans_of(sizes: Sequence[int], limit: int) -> Iterator[tuple[int, int]]:
    """Runs of neighbours whose sizes sum up to a limit, one at least."""
    a, total = 0, 0
    for b, n in enumerate(sizes):
        if b > a and total + n > limit:
            yield a, b
            a, total = b, 0
        total += n
    if a < len(sizes):
        yield a, len(sizes)
