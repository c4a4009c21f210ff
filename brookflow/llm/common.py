"""Shared helpers: the shared folder, written stages, and vectorised text hashing.

The hashing works on the UTF-8 buffer of whole Arrow string columns, in blocks
of bounded size, so that no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookflow.runtime import delete_dir, new_dir, release, shared_dir, staged  # noqa: F401  shared with the rest of the library

#: Bytes of text that are hashed at once. A longer text makes a block of its own, which is hashed in windows of this size.
BLOCK_BYTES = 1 << 20

_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id's decimal text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (splitmix64's finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def mix32(x: np.ndarray, out: np.ndarray, tmp: np.ndarray) -> np.ndarray:
    """A bijection of 32-bit words (murmur3's finaliser), without new arrays."""
    np.right_shift(x, np.uint32(16), out=tmp)
    np.bitwise_xor(x, tmp, out=out)
    np.multiply(out, np.uint32(0x85EBCA6B), out=out)
    np.right_shift(out, np.uint32(13), out=tmp)
    np.bitwise_xor(out, tmp, out=out)
    np.multiply(out, np.uint32(0xC2B2AE35), out=out)
    np.right_shift(out, np.uint32(16), out=tmp)
    np.bitwise_xor(out, tmp, out=out)
    return out


#: Odd multiplier of the rolling polynomial and its inverse modulo 2**64.
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:  # doubling: p^(k+done) = p^k * p^done
        step = _U(pow(base, done, 1 << 64))
        take = min(done, n - done)
        out[done : done + take] = out[:take] * step
        done += take
    return out


_cache: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    have = _cache.get(base)
    if have is None or len(have) < n:
        have = _cache[base] = _powers(base, max(n, BLOCK_BYTES + 1))
    return have[:n]


#: Byte classes. LOWER folds A-Z. WHITE is the blank and \t\n\v\f\r. PUNCT adds all other ASCII that is neither letter nor digit.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
PUNCT = np.zeros(256, bool)
PUNCT[:128] = [not chr(c).isalnum() for c in range(128)]


def _window_hashes(data: np.ndarray, sep: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, begins) of the words of data; a word also ends where a text does (cut)."""
    n = len(data)
    inside = ~sep
    begins = inside.copy()
    begins[1:] &= sep[:-1]
    begins[cut] |= inside[cut]
    w0 = np.flatnonzero(begins)
    stop = inside.copy()
    stop[:-1] &= sep[1:]
    stop[cut - 1] |= inside[cut - 1]
    w1 = np.flatnonzero(stop) + 1
    with np.errstate(over="ignore"):
        summed = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[LOWER[data]] * _power_table(_P, n), out=summed[1:])
        h = (summed[w1] - summed[w0]) * _power_table(_P_INV, n)[w0]
        return mix64(h + (w1 - w0).astype(np.uint64)), w0


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, separators: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of texts data[starts[i]:ends[i]], A-Z folded, and each text's first word.

    Texts are adjacent. A word is a longest run of bytes that aren't separators.
    The bytes are taken in windows that end behind a separator or a text, so that
    a very long text takes little more than its words' hashes; only a single word that is longer widens a window.
    Returns (hashes, first): the words of text i are hashes[first[i]:first[i + 1]].
    """
    n = len(data)
    if n == 0:
        return np.empty(0, np.uint64), np.zeros(len(starts) + 1, np.int64)
    hashes, begins, at = [], [], 0
    while at < n:
        size = 2 * BLOCK_BYTES
        while True:
            to = min(at + size, n)
            sep = separators[data[at:to]]
            if to == n:
                break
            last = np.flatnonzero(sep)
            cut = starts[np.searchsorted(starts, at, side="right") : np.searchsorted(starts, to, side="right")]
            end = max(at + int(last[-1]) + 1 if len(last) else 0, int(cut[-1]) if len(cut) else 0)
            if end > at:
                to, sep = end, sep[: end - at]
                break
            size *= 2
        cut = starts[np.searchsorted(starts, at, side="right") : np.searchsorted(starts, to, side="left")] - at
        h, w0 = _window_hashes(data[at:to], sep, cut)
        hashes.append(h)
        begins.append(w0 + at)
        at = to
    w0 = np.concatenate(begins)
    return np.concatenate(hashes), np.append(np.searchsorted(w0, starts), len(w0))


def text_blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, starts, ends) of runs of rows of a string column, null as empty, in blocks of about BLOCK_BYTES."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if large else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, side="right")) - 1
        to = min(n, max(at + 1, to))
        yield at, to, data[offsets[at] : offsets[to]], offsets[at:to] - offsets[at], offsets[at + 1 : to + 1] - offsets[at]
        at = to


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of `size` words; a text with fewer words has its whole sequence as one.

    Returns (hashes, first) as word_hashes does; a text without words has none.
    """
    counts = np.diff(first)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_first = np.concatenate([[0], np.cumsum(made)])
    if out_first[-1] == 0:
        return np.empty(0, np.uint64), out_first
    at = np.repeat(first[:-1] - out_first[:-1], made) + np.arange(out_first[-1])
    with np.errstate(over="ignore"):
        total = np.zeros(len(at), np.uint64)
        padded = np.concatenate([words, np.zeros(size, np.uint64)])
        length = np.repeat(np.minimum(counts, size), made)
        for k in range(size):
            term = mix64(padded[at + k] + _U((k + 1) * 0xA0761D6478BD642F & (1 << 64) - 1))
            total += term if k == 0 else np.where(length > k, term, _U(0))
        return mix64(total + length.astype(np.uint64)), out_first
