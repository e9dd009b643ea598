"""Words, shingles and their 64-bit hashes, inside tasks.

Texts are handled as UTF-8 bytes: words are runs of bytes other than the six
ASCII white-space characters, A-Z lower-cased. A NULL text is an empty text.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Words whose hash is remembered per task; beyond that the memory starts anew.
REMEMBERED = 300_000

_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def process_memory(key: str, make):
    """What a Python worker keeps from one task to the next."""
    store = sys.modules.setdefault("_llm_process_memory", types.ModuleType("_llm_process_memory")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def forget() -> None:
    """Drop what tasks of another operator have left in a Python worker, which may outlive its use by many stages."""
    sys.modules.pop("_llm_process_memory", None)


class WordHashes(dict):
    """Hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def split_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def hash_words(words: list[bytes], memory: WordHashes | None = None) -> np.ndarray:
    """Hashes of words; without a memory each is computed, which is quicker where many words are rare."""
    return np.fromiter(map(memory.__getitem__ if memory is not None else xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits."""
    x = values + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash per run of ``size`` words; all words as one run if there are fewer, none without words."""
    size = min(size, len(hashes))
    if not size:
        return hashes
    n = len(hashes) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = mix(out ^ hashes[k:k + n], k)
    return out


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles in rising order."""
    return np.unique(shingles(hashes, size))


def rows_of(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Rows one by one; only a slice of a batch is held as Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            yield from zip(*(part.column(c).to_pylist() for c in columns), strict=True)


def gathered(batches: Iterator[pa.RecordBatch], rows: int = 20_000, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in fewer batches, each of which costs some time to hand over."""
    held: list[pa.RecordBatch] = []
    n = held_bytes = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        held_bytes += batch.nbytes
        if n >= rows or held_bytes >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n, held_bytes = [], 0, 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return values.view(np.int64)
