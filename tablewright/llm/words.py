"""Words, lines and windows of whole Arrow string columns as numpy arrays.

A word is `[^\\x20\\x09-\\x0D]+`, so words can be cut in the UTF-8 bytes: every separator is one byte
and never part of another character.  Nothing here is done per row: positions come from masks over
the bytes of many texts at once, and hashes of any byte range from one running sum,

    S[i] = sum over j < i of table[byte j] * B**j  (mod 2**64),
    hash(a, b) = (S[b] - S[a]) / B**a,

with a random 64-bit value per byte.  Runs of words are hashed in the same way over the hashes of
words.  Rows are taken in slices of about `SLICE` bytes, at least one row, so memory follows the
longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IN_WORD = np.ones(256, bool)
IN_WORD[list(_SPACES)] = False
_U = np.uint64
_RANDOM = np.random.default_rng(20240501).integers(0, 2**64, 256, dtype=np.uint64)
_FOLDED = _RANDOM.copy()
_FOLDED[65:91] = _RANDOM[97:123]
_BYTE_BASE, _WORD_BASES = 0x9E3779B97F4A7C15, (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse, modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE + 1)
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            pair.append(np.multiply.accumulate(p))
        have = _POWERS[base] = (pair[0], pair[1])
    return have[0][:n], have[1][:n]


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all bits."""
    h = h ^ _U(salt)
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class Texts(NamedTuple):
    """Bytes of consecutive texts; text i is data[bounds[i]:bounds[i + 1]]."""

    data: np.ndarray
    bounds: np.ndarray


class Words(NamedTuple):
    """Byte ranges of all words; those of text i are first[i]:first[i + 1]."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int, Texts]]:
    """Row ranges of a string column with their bytes; null is the empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    if not wide and not pa.types.is_string(column.type):
        column, wide = column.cast(pa.large_string()), True
    kind = np.int64 if wide else np.int32
    n = len(column)
    if n == 0:
        return
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, hi, Texts(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def words(texts: Texts, kind: np.ndarray = IN_WORD) -> Words:
    """Maximal runs of bytes for which `kind` is true, inside each text."""
    inside = kind[texts.data]
    n = len(inside)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return Words(empty, empty, np.zeros(len(texts.bounds), np.int64))
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = texts.bounds[(texts.bounds > 0) & (texts.bounds < n)]
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    start = np.flatnonzero(begins)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, texts.bounds))


def running(values: np.ndarray) -> np.ndarray:
    """Sums of all prefixes, the empty one first."""
    out = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=out[1:])
    return out


def byte_table(salt: int, fold: bool = False) -> np.ndarray:
    """Another random value per byte, for a hash independent of the usual one."""
    table = np.random.default_rng([20240501, salt]).integers(0, 2**64, 256, dtype=np.uint64)
    if fold:
        table[65:91] = table[97:123]
    return table


def byte_sums(data: np.ndarray, fold: bool = False, table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sums from which `range_hash` takes the hash of any byte range; `fold` takes A-Z for a-z."""
    if table is None:
        table = _FOLDED if fold else _RANDOM
    power, inverse = _powers(_BYTE_BASE, len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * power[:-1], out=sums[1:])
    return sums, inverse


def take_ranges(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of `flat` one behind the other, and their bounds there."""
    bounds = running(length)
    at = np.arange(bounds[-1]) + np.repeat(start - bounds[:-1], length)
    return flat[at], bounds


def range_hash(sums: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total, inverse = sums
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = False) -> np.ndarray:
    """64-bit hashes of byte ranges."""
    return range_hash(byte_sums(data, fold), start, end)


_SECOND = byte_table(13)


def two_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of byte ranges, 128 bits together."""
    return hash_ranges(data, start, end), range_hash(byte_sums(data, table=_SECOND), start, end)


class Distinct(NamedTuple):
    """Places of the first of each kind, the kind of every range, and the hashes of the kinds."""

    place: np.ndarray
    kind: np.ndarray
    one: np.ndarray
    two: np.ndarray


def distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Distinct:
    """Byte ranges by kind; ranges that agree in the first hash only are kinds of their own."""
    one, two = two_hashes(data, start, end)
    _, place, kind = np.unique(one, return_index=True, return_inverse=True)
    odd = np.flatnonzero(two[place][kind] != two)
    if len(odd):
        kind[odd] = len(place) + np.arange(len(odd))
        place = np.concatenate([place, odd])
    return Distinct(place, kind, one[place], two[place])


def owners(first: np.ndarray) -> np.ndarray:
    """Text number of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def run_sums(hashes: np.ndarray, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Sums from which `run_hash` takes the hash of any run of words."""
    power, inverse = _powers(_WORD_BASES[lane], len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes, lane * 0x2545F4914F6CDD1D) * power[:-1], out=sums[1:])
    return sums, inverse


run_hash = range_hash  # the same, over the sums of `run_sums`


def window_starts(first: np.ndarray, length: int) -> np.ndarray:
    """Positions of all words that begin a run of `length` words of their text."""
    n = int(first[-1])
    if n == 0:
        return np.zeros(0, np.int64)
    room = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    return np.flatnonzero(room >= length)


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n words lie in one of the runs."""
    change = np.bincount(starts, minlength=n + 1) - np.bincount(starts + length, minlength=n + 1)[: n + 1]
    return np.cumsum(change[:n]) > 0


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
