"""Words and digests of whole texts inside Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Odd multipliers of the word combination and of the final mixing (fixed values).
SPREAD = np.uint64(0x9E3779B97F4A7C15)
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)
WIDTH = 5


def byte_texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def words_of(data: bytes) -> list[bytes]:
    """A-Z lower-cased words; ``bytes.split`` cuts at exactly 0x20 and 0x09-0x0D."""
    return data.lower().split()


def word_keys(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(30))) * MIX_A
    keys = (keys ^ (keys >> np.uint64(27))) * MIX_B
    return keys ^ (keys >> np.uint64(31))


def shingle_keys(data: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit keys of the word shingles.

    A text of fewer than ``width`` words has its whole sequence as its one shingle; a
    text without words has none.
    """
    words = word_keys(words_of(data))
    if len(words) == 0:
        return words
    take = min(width, len(words))
    last = len(words) - take + 1
    keys = words[:last].copy()
    for k in range(1, take):
        keys = keys * SPREAD + words[k : last + k]
    return np.unique(mixed(keys + np.uint64(take)))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == 0:
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def batches_of(frames: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """Cut batches down, so that what is derived from one stays small."""
    for frame in frames:
        for start in range(0, frame.num_rows, rows):
            yield frame.slice(start, rows)
