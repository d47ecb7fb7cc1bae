"""Whole-array text helpers for Arrow batches: chunks of rows, word bounds and
64-bit hashes of byte ranges, all in numpy.

Rows are handled in chunks of bounded bytes (a longer text is a chunk of its
own and is never cut), so a task's memory does not follow the batch size.
Words are runs of ``[^\\x20\\x09-\\x0D]`` over the UTF-8 bytes; that equals the
same class over code points, as UTF-8 uses no byte below 0x80 inside a longer
sequence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
CHUNK_ROWS = 1 << 14
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), elementwise."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Chunk:
    """Rows ``first .. first + n`` of a batch; ``buf`` has their bytes one after
    the other, row ``r`` at ``bounds[r] .. bounds[r + 1]``."""

    first: int
    buf: np.ndarray
    bounds: np.ndarray

    @property
    def n(self) -> int:
        return len(self.bounds) - 1

    def lengths(self) -> np.ndarray:
        return np.diff(self.bounds)


def chunks(texts: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Row ranges of a string or binary column; a null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if len(texts) == 0:
        return
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, values = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = min(max(at + 1, int(np.searchsorted(bounds, bounds[at] + max_bytes, "right")) - 1), at + CHUNK_ROWS)
        yield Chunk(at, data[bounds[at] : bounds[end]], bounds[at : end + 1] - bounds[at])
        at = end


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Sums that :func:`range_hash` takes differences of."""
    out = np.empty(len(buf) + 1, np.uint64)
    out[0] = 0
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _power(len(buf) + 1)[0][: len(buf)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes ``start .. end`` of each range; equal bytes have
    equal hashes wherever they stand."""
    return mix((sums[end] - sums[start]) * _power(len(sums))[1][start])


def long_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray, least: int = 256) -> np.ndarray:
    """``hashes`` with those of ranges of ``least`` bytes or more replaced by BLAKE2: sums of powers
    modulo 2^64 coincide for some long ranges of two bytes in a regular order."""
    out = hashes.copy()
    for i in np.flatnonzero(end - start >= least):
        out[i] = int.from_bytes(blake2b(buf[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return out


@dataclass
class Words:
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray  # first[r] .. first[r + 1]: the words of row r


def words(chunk: Chunk) -> Words:
    """Bounds of every word of the chunk; a word never crosses rows."""
    inside = ~SPACE[chunk.buf]
    n = len(inside)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(chunk.n + 1, np.int64))
    edge = np.zeros(n + 1, bool)
    edge[chunk.bounds] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:n]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = np.searchsorted(start, chunk.bounds)
    return Words(start, end, np.repeat(np.arange(chunk.n), np.diff(first)), first)


def tally(mask: np.ndarray) -> np.ndarray:
    """Running count: ``tally(mask)[b] - tally(mask)[a]`` is the count in a .. b."""
    return np.concatenate([[0], np.cumsum(mask)])


WORDLIKE = np.zeros(256, bool)
WORDLIKE[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


def bare_words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, row)`` of the words without ASCII punctuation at their
    ends; words of punctuation only are left out."""
    w = words(chunk)
    solid = np.flatnonzero(WORDLIKE[chunk.buf])
    a, b = np.searchsorted(solid, w.start), np.searchsorted(solid, w.end)
    some = b > a
    return solid[a[some]], solid[b[some] - 1] + 1, w.row[some]


def windows(values: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``k`` values of one row: positions and hashes."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(row[:n] == row[k - 1 :])
    total = np.zeros(len(at), np.uint64)
    factor = 1
    for j in range(k):
        total += values[at + j] * np.uint64(factor)
        factor = factor * 0xD1342543DE82EF95 % (1 << 64)
    return at, mix(total)


def shingles(chunk: Chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, hash)`` of every run of ``k`` lower-cased words, in text order;
    a row with 1 to ``k - 1`` words has one shingle of all of them."""
    w = words(chunk)
    low = LOWER[chunk.buf]
    h = long_hash(low, w.start, w.end, range_hash(prefix_hash(low), w.start, w.end))
    at, values = windows(h, w.row, k)
    rows = w.row[at]
    count = np.diff(w.first)
    for r in np.flatnonzero((count > 0) & (count < k)):
        total = int(h[w.first[r] : w.first[r + 1]].sum()) + int(count[r])
        values = np.append(values, mix(np.array([total * _INVERSE % (1 << 64)], np.uint64)))
        rows = np.append(rows, r)
    order = np.argsort(rows, kind="stable")
    return rows[order], values[order]
