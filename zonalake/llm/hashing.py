"""Vectorised hashes of bytes, words and word shingles.

A byte string hashes to the sum of T[byte] * B^position modulo 2^64, with a table T of random odd
numbers, so that any substring's hash follows from two prefix sums. Words are `[^\\x20\\x09-\\x0D]+`
with A-Z lowered. All values are mixed before use, so any bit of them can serve.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

U64 = np.uint64
SHINGLE = 5
#: Powers of a base that a worker keeps: 16 MB for each base.
KEPT = 1 << 20

_rng = np.random.default_rng(20240611)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_TABLES = [_rng.integers(0, 2**63, 256, dtype=U64) * U64(2) + U64(1) for _ in _BASES]
_PLACES = _rng.integers(0, 2**63, SHINGLE, dtype=U64) * U64(2) + U64(1)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWERED = _TABLES[0].copy()
_LOWERED[ord("A") : ord("Z") + 1] = _LOWERED[ord("a") : ord("z") + 1]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over the whole word."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _tables(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    tables = []
    for value in (_BASES[base], pow(_BASES[base], -1, 2**64)):
        steps = np.full(size, U64(value))
        steps[0] = 1
        tables.append(np.cumprod(steps))
    return tables[0], tables[1]


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first `n` powers of a base and of its inverse. Tables of up to KEPT powers stay in the worker;
    those for a longer text go with it."""
    if n > KEPT:
        return _tables(base, n)
    if base not in _powers or len(_powers[base][0]) < n:
        _powers[base] = _tables(base, max(1 << 16, 1 << (n - 1).bit_length()))
    up, down = _powers[base]
    return up[:n], down[:n]


def prefix_sums(data: np.ndarray, base: int = 0, table: np.ndarray | None = None) -> np.ndarray:
    """Sums of table[byte] * base^position before each position, and of all."""
    up, _ = powers(base, len(data))
    sums = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum((_TABLES[base] if table is None else table)[data] * up, out=sums[1:])
    return sums


def substring_hashes(
    sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = 0
) -> np.ndarray:
    """Hashes of data[start:end]; equal strings agree wherever they stand."""
    _, down = powers(base, len(sums))
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


@dataclass
class Shingled:
    """Shingle hashes of several texts, one after the other; bounds[i]:bounds[i + 1] are text i's."""

    hashes: np.ndarray
    bounds: np.ndarray


def _shingle_group(texts: Sequence[bytes]) -> Shingled:
    data = np.frombuffer(b" " + b" ".join(texts) + b" ", dtype=np.uint8)
    space = IS_SPACE[data]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    words = substring_hashes(prefix_sums(data, 0, _LOWERED), starts, ends)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    first = np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths))))
    n_words = np.diff(first)
    n_shingles = np.where(n_words >= SHINGLE, n_words - SHINGLE + 1, np.minimum(n_words, 1))
    bounds = np.concatenate(([0], np.cumsum(n_shingles)))
    out = np.empty(bounds[-1], dtype=U64)
    if len(words) >= SHINGLE:
        runs = sum(
            words[i : len(words) - SHINGLE + 1 + i] * _PLACES[i] for i in range(1, SHINGLE)
        ) + words[: len(words) - SHINGLE + 1] * _PLACES[0]
        text_of = np.repeat(np.arange(len(texts)), n_words)
        whole = text_of[: len(runs)] == text_of[SHINGLE - 1 :]
        into = np.repeat(n_words >= SHINGLE, n_shingles)
        out[into] = mixed(runs[whole])
    for i in np.flatnonzero((n_words > 0) & (n_words < SHINGLE)):
        few = words[first[i] : first[i + 1]]
        total = (few * _PLACES[: len(few)]).sum(dtype=U64) + U64(len(few))
        out[bounds[i]] = mixed(np.array([total], dtype=U64))[0]
    return Shingled(out, bounds)


def shingles(texts: Sequence[bytes], group_bytes: int = 1 << 20) -> Iterator[tuple[int, Shingled]]:
    """Shingle hashes of all texts, in order and with repeats, for groups of texts.

    Yields the number of the first text of each group. A text with fewer words than a shingle has
    its whole word sequence as one; a text without words has none.
    """
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > group_bytes:
            yield begin, _shingle_group(texts[begin:i])
            begin, size = i, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, _shingle_group(texts[begin:])


def utf8(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes; null counts as empty."""
    import pyarrow as pa

    return [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]
