"""Vectorised hashing of words, shingles and windows for the text operators.

Everything works on the UTF-8 bytes of an Arrow batch, so a task hashes many
documents with a few numpy calls and never builds one Python string per word.
Hashes are 64 bits wide and depend on nothing but the content, so they agree on
every executor and in every run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes hashed in one go; bounds the scratch arrays to about 40 MB.
BLOCK = 1 << 20
SPACES = (9, 10, 11, 12, 13, 32)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _table(lower: bool) -> np.ndarray:
    table = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
    if lower:
        table[65:91] = table[97:123]
    return table


BYTE_HASH = _table(False)
_WORD_BYTES = {flag: _table(flag) for flag in (False, True)}

#: Modulus of the rolling hashes: a prime, so no family of texts collides whatever the base.
PRIME = np.uint64((1 << 61) - 1)
_M31, _M30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_S61, _S31, _S30, _ONE = (np.uint64(k) for k in (61, 31, 30, 1))
BASE = 0x0D6E8FEB86659FD9


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME, for x < 2**63."""
    x = (x & PRIME) + (x >> _S61)
    return np.where(x >= PRIME, x - PRIME, x)


def multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME, for a and b up to PRIME."""
    a1, a0, b1, b0 = a >> _S31, a & _M31, b >> _S31, b & _M31
    middle = a1 * b0 + a0 * b1
    return _reduced(((a1 * b1) << _ONE) + (middle >> _S30) + ((middle & _M30) << _S31) + a0 * b0)


def powers(n: int, base: int) -> np.ndarray:
    """1, base, base**2, ... modulo PRIME; n at least, by doubling."""
    out = np.ones(1, dtype=np.uint64)
    while len(out) < n:
        out = np.concatenate((out, multiply(out, np.full(len(out), pow(base, len(out), int(PRIME)), dtype=np.uint64))))
    return out


_POWERS: list[np.ndarray] = []


def power_tables(n: int) -> list[np.ndarray]:
    """The base's powers and their inverses, n of each at least."""
    if not _POWERS or n > len(_POWERS[0]):
        n = max(n, 1 << 14)
        _POWERS[:] = powers(n, BASE), powers(n, pow(BASE, -1, int(PRIME)))
    return _POWERS


def running(values: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial in the base, modulo PRIME; one longer than ``values``."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    terms = multiply(values & PRIME, power_tables(len(values) + 1)[0][: len(values)])
    high = np.cumsum(terms >> _S31, dtype=np.uint64)
    total[1:] = _reduced((high >> _S30) + ((high & _M30) << _S31) + np.cumsum(terms & _M31, dtype=np.uint64))
    return total


def range_hashes(total: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of values[first:last] from ``running(values)``: equal contents, equal hashes."""
    return mix(multiply(_reduced(total[last] + PRIME - total[first]), power_tables(len(total))[1][first]))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each row begins (n + 1 offsets); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, at


def blocks(offsets: np.ndarray, limit: int = BLOCK):
    """Row ranges whose texts hold at most ``limit`` bytes together; a longer text stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def _hash_words(raw: np.ndarray, edges: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """A word's hash is the sum of one random number for each (byte, place in the word)."""
    space = IS_SPACE[raw]
    before = np.empty_like(space)
    before[0] = True
    before[1:] = space[:-1]
    before[edges[edges < len(raw)]] = True
    inside = np.flatnonzero(~space)
    first = np.flatnonzero(before[inside])
    if not len(first):
        return first, np.zeros(0, np.uint64)
    place = (np.arange(len(inside)) - np.repeat(first, np.diff(first, append=len(inside)))).astype(np.uint64)
    values = mix(_WORD_BYTES[lower][raw[inside]] + place * _ODD)
    return inside[first], mix(np.add.reduceat(values, first))


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of consecutive rows starts, and its hash.

    Words are runs of other bytes than ASCII white space and never cross rows.
    ``offsets`` are the rows' edges in ``raw``. A very long text is cut at white
    space, so scratch memory doesn't follow its length.
    """
    first, last = int(offsets[0]), int(offsets[-1])
    starts, hashes, at = [], [], first
    while at < last:
        to = min(at + BLOCK, last)
        if to < last:
            gap = np.flatnonzero(IS_SPACE[raw[at:to]])
            inner = int(gap[-1]) + 1 if len(gap) else 0
            if not inner:
                more = np.flatnonzero(IS_SPACE[raw[to:last]])
                inner = to - at + (int(more[0]) if len(more) else last - to)
            to = at + inner
        s, h = _hash_words(raw[at:to], offsets - at if at == first else offsets[(offsets >= at) & (offsets < to)] - at, lower)
        starts.append(s + at)
        hashes.append(h)
        at = to
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def shingle_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive values; of all values, if there are fewer."""
    if not len(values):
        return values
    k = min(k, len(values))
    n = len(values) - k + 1
    out = np.full(n, k, dtype=np.uint64) * _ODD
    for i in range(k):
        out = mix(out * np.uint64(3) + values[i : i + n])
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, in log2(width) passes."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out
