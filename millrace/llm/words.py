"""Words of Arrow text batches as numpy arrays of hashes, for the operators that run in Python.

A batch is handled as one run of bytes: no Python object is made per word, and
memory stays in proportion to a slice of a few MB whatever the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at a time.
SLICE = 1 << 19
#: Odd constants of the two polynomial hashes of a word.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def fold_table(separators: bytes) -> np.ndarray:
    """Byte table: A-Z to a-z, separators to 0, all else unchanged.

    A NUL that separates nothing becomes 255, a byte that UTF-8 never has.
    """
    table = np.arange(256, dtype=np.uint8)
    table[0] = 255
    table[65:91] += 32
    table[list(separators)] = 0
    return table


def cut_table(separators: bytes) -> np.ndarray:
    """The same without folding."""
    table = fold_table(separators)
    table[65:91] = np.where(table[65:91], np.arange(65, 91), 0)
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of 64-bit words; returns a new array."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept for later calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE + 1), base, dtype=np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying; a null has no bytes."""
    column = column.cast(pa.large_string())
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def hash_words(column: pa.Array, table: np.ndarray, n_hashes: int = 1) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, hashes, starts, ends, bytes) of the words of a string column.

    ``offsets[i]:offsets[i+1]`` are the words of row i; starts and ends are places
    in ``bytes``. A word is a maximal run of bytes that ``table`` doesn't map to 0,
    cut at the ends of a row, and hashed after folding by ``table``.
    """
    data, at = buffers(column)
    cuts = np.zeros(len(data) + 1, dtype=bool)
    cuts[at] = True
    starts, ends, hashes = [], [], [[] for _ in range(n_hashes)]
    lo = int(at[0]) if len(at) else 0
    stop = int(at[-1]) if len(at) else 0
    while lo < stop:
        hi = min(lo + SLICE, stop)
        while hi < stop and not cuts[hi] and table[data[hi]]:  # not inside a word
            hi += 1
        b = table[data[lo:hi]]
        word = b != 0
        first = word.copy()
        first[1:] &= ~word[:-1] | cuts[lo + 1 : hi]
        last = word.copy()
        last[:-1] &= ~word[1:] | cuts[lo + 1 : hi]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        if len(s):
            for k in range(n_hashes):
                p = powers(BASES[k], len(b))
                # h = sum of byte * base^place from the word's start: running sums less what came before,
                # scaled back by the inverse power, which exists because the base is odd
                run = np.zeros(len(b) + 1, dtype=np.uint64)
                np.cumsum(b.astype(np.uint64) * p, out=run[1:])
                back = powers(pow(BASES[k], -1, 1 << 64), len(b))
                hashes[k].append(mix((run[e] - run[s]) * back[s] + (e - s).astype(np.uint64)))
            starts.append(s + lo)
            ends.append(e + lo)
        lo = hi
    joined = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    starts, ends = joined(starts, np.int64), joined(ends, np.int64)
    return np.searchsorted(starts, at), [joined(h, np.uint64) for h in hashes], starts, ends, data


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n consecutive words; empty when there are fewer."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out = (out ^ h[k : len(h) - n + 1 + k]) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(32)
    return mix(out)


def slices(batches: Iterable[pa.RecordBatch], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about ``most`` bytes, so that what is made from one stays small."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * most / max(most, batch.nbytes)))
        for i in range(0, batch.num_rows, rows):
            yield batch if rows >= batch.num_rows else pa.RecordBatch.from_arrays(
                [pa.concat_arrays([c.slice(i, rows)]) for c in batch.columns], schema=batch.schema
            )


def _gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of the stretches of ``data`` that begin at ``starts``, one behind the other."""
    at = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=at[1:])
    return at, data[np.arange(at[-1]) + np.repeat(starts - at[:-1], sizes)]


def numbered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Numbers that are equal where the words' bytes are, and the different words by number."""
    at, flat = _gathered(data, starts, ends - starts)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(flat)])
    encoded = words.dictionary_encode()
    return encoded.indices.to_numpy().astype(np.int64), encoded.dictionary


def join_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> pa.Array:
    """The words of each row joined by one blank; ``at[i]:at[i + 1]`` are those of row i."""
    if not len(starts):
        return pa.array([""] * (len(at) - 1), pa.string())
    sizes = ends - starts
    sizes[:-1] += 1  # and the byte behind it, which becomes the blank
    offsets, flat = _gathered(data, starts, sizes)
    flat[offsets[1:-1] - 1] = 32
    last = np.zeros(len(starts), bool)
    last[at[1:][at[1:] > at[:-1]] - 1] = True
    last[-1] = False  # has no byte behind it
    keep = np.ones(len(flat), bool)
    keep[offsets[1:][last] - 1] = False
    sizes -= last
    ends_at = np.r_[0, np.cumsum(sizes)][at]
    return pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(ends_at)), pa.py_buffer(flat[keep])]).cast(pa.string())
