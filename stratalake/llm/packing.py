"""Best-fit packing of token pieces into sequences, by patterns of lengths.

The histogram of piece lengths, at most one number per length, decides it all:

1. patterns of two and three lengths that fill a sequence exactly are enumerated, the
   pairs at once, the triples by column generation: all of them are priced by what
   the fit lacks, and the best for each longest length join it, round after round;
2. repeat counts are fitted to the histogram by non-negative least squares, in which a
   length's error counts relative to its pieces, and rounded down, so that no more pieces of a length are used than there are;
3. what is left is packed by best fit in falling order of length, on counts.

The plan maps the n-th piece of a length to a sequence and an offset. Its size
depends on the sequence length alone, not on the number of documents.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.tables import written
from stratalake.llm.tokens import chunk_tokenizer, vocabulary

SEQUENCE = 2048
#: Rounds in which patterns of three lengths join the fit, and steps of the fit in each and at the end.
ROUNDS, ROUND_STEPS, FIT_STEPS = 24, 30, 300


@dataclass
class Plan:
    """Slots: pieces ``rank .. rank + count`` of a length go to sequences ``sequence ..`` at ``offset``."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces; slots are sorted by length and first rank."""
        width = int(self.rank.max(initial=0)) + int(rank.max(initial=0)) + 2
        slot = np.searchsorted(self.length * width + self.rank, length * width + rank, "right") - 1
        return self.sequence[slot] + rank - self.rank[slot], self.offset[slot]


def exact_pairs(counts: np.ndarray, size: int) -> np.ndarray:
    """All pairs of lengths that occur and sum up to ``size``, one row each, the longer one first."""
    there = np.flatnonzero(counts)
    there = there[there < size]
    pairs = np.stack([size - there, there], axis=1)
    return pairs[(pairs[:, 0] >= pairs[:, 1]) & (counts[pairs[:, 0]] > 0)]


def best_triples(counts: np.ndarray, size: int, value: np.ndarray) -> np.ndarray:
    """Of all triples of lengths that occur and sum up to ``size``, for each longest length the one with the most value, if it is positive."""
    there = np.flatnonzero(counts)
    there = there[there < size]
    short = there[there <= size // 3]
    if not len(short):
        return np.zeros((0, 3), np.int64)
    a, c = there[:, None], short[None, :]
    b = size - a - c
    fits = (a >= b) & (b >= c)
    fits &= counts[np.maximum(b, 0)] > 0
    worth = np.where(fits, value[a] + value[np.maximum(b, 0)] + value[c], 0)
    best = worth.argmax(axis=1)
    rows = np.flatnonzero(worth[np.arange(len(there)), best] > 0)
    return np.stack([there[rows], size - there[rows] - short[best[rows]], short[best[rows]]], axis=1)


class Fit:
    """Repeat counts x >= 0 of patterns whose lengths come close to the histogram, by multiplicative steps."""

    def __init__(self, counts: np.ndarray):
        self.target, self.weight = counts.astype(float), 1.0 / np.maximum(counts, 1.0)
        self.patterns: list[np.ndarray] = []
        self.x: list[np.ndarray] = []

    def add(self, patterns: np.ndarray, start: float) -> None:
        if len(patterns):
            self.patterns.append(patterns)
            self.x.append(self.target[patterns].min(axis=1) * start + 1e-6)

    def used(self) -> np.ndarray:
        total = np.zeros(len(self.target))
        for p, own in zip(self.patterns, self.x, strict=True):
            for column in p.T:
                total += np.bincount(column, own, len(total))
        return total

    def step(self) -> None:
        now, want = self.used() * self.weight, self.target * self.weight
        self.x = [own * want[p].sum(axis=1) / (now[p].sum(axis=1) + 1e-12) for p, own in zip(self.patterns, self.x, strict=True)]

    def lacking(self) -> np.ndarray:
        """The value of one more piece of each length: what the gradient of the squares says."""
        return (self.target - self.used()) * self.weight


def fitted_patterns(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], float]]:
    """Patterns and repeat counts, the most repeated first."""
    fit = Fit(counts)
    fit.add(exact_pairs(counts, size), 0.25)
    known: set[tuple[int, ...]] = set()
    for _ in range(ROUNDS):
        for _ in range(ROUND_STEPS if fit.patterns else 0):
            fit.step()
        new = [t for t in map(tuple, best_triples(counts, size, fit.lacking()).tolist()) if t not in known]
        if not new:
            break
        known.update(new)
        fit.add(np.array(new), 0.1)
    for _ in range(FIT_STEPS if fit.patterns else 0):
        fit.step()
    found = [(tuple(row), n) for p, x in zip(fit.patterns, fit.x, strict=True) for row, n in zip(p.tolist(), x.tolist(), strict=True)]
    return sorted(found, key=lambda f: (-f[1], f[0]))


def plan_packing(counts: np.ndarray, size: int = SEQUENCE) -> Plan:
    """``counts[length]`` pieces of each length from 1 to ``size``; the index 0 is not used."""
    counts = counts.astype(np.int64).copy()
    given = np.zeros(len(counts), np.int64)
    slots: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def put(length: int, n: int, sequence: int, offset: int) -> None:
        slots.append((length, int(given[length]), n, sequence, offset))
        given[length] += n
        counts[length] -= n

    if counts[size]:
        n = int(counts[size])
        put(size, n, sequences, 0)
        sequences += n
    for pattern, repeats in fitted_patterns(counts, size):
        n = min(int(repeats), *(int(counts[length]) // pattern.count(length) for length in pattern))
        if n > 0:
            offset = 0
            for length in pattern:
                put(length, n, sequences, offset)
                offset += length
            sequences += n
    spaces: list[int] = []  # rising
    bins: dict[int, list[tuple[int, int]]] = {}  # space: first sequence, how many
    for length in range(size - 1, 0, -1):
        while counts[length]:
            at = bisect_left(spaces, length)
            if at == len(spaces):
                n = int(counts[length])
                put(length, n, sequences, 0)
                left, first = size - length, sequences
                sequences += n
            else:
                space = spaces[at]
                first, there = bins[space].pop()
                n = min(there, int(counts[length]))
                put(length, n, first, size - space)
                left = space - length
                if there > n:
                    bins[space].append((first + n, there - n))
                if not bins[space]:
                    del bins[space]
                    spaces.pop(at)
            if left:
                if left not in bins:
                    insort(spaces, left)
                bins.setdefault(left, []).append((first, n))
    table = np.array(sorted(slots), np.int64).reshape(-1, 5)
    return Plan(table[:, 0], table[:, 1], table[:, 3], table[:, 4], sequences)


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def _pieces(path: str, size: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = chunk_tokenizer(path)
        part = TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        last = np.array([end], np.uint32).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                out: list[list] = [[], [], [], [], [], []]
                for doc_id, ids in zip(rows.column("doc_id").to_pylist(), tokenizer.encode(rows.column("text").to_pylist()),
                                       strict=True):
                    ids += last
                    for piece, byte in enumerate(range(0, len(ids), 4 * size)):
                        own = ids[byte:byte + 4 * size]
                        n = len(own) // 4
                        for column, value in zip(out, (doc_id, piece, byte // 4, n, zlib.crc32(own), seen[n]), strict=True):
                            column.append(value)
                        seen[n] += 1
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                columns = [pa.array(x, k) for x, k in zip(out, kinds, strict=True)]
                columns.insert(5, pa.array(np.full(len(out[0]), part, np.int32)))
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    return run


def pack(docs: DataFrame, size: int = SEQUENCE, path: str | None = None, end: int = 0) -> DataFrame:
    """Pieces of all rows of ``docs (doc_id, text)`` and their places in sequences of at most ``size`` tokens.

    ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: a document
    is its ids and the id ``end``; only a document that is longer than a sequence
    is cut. A NULL or empty text is the id ``end`` alone. Rows with a NULL or
    repeated doc_id are packed like any other. Sequences are numbered from 0
    and filled from offset 0 without gaps. Ranks of pieces among those of their
    length come from counts per task, so no length is gathered anywhere.
    """
    path = path or vocabulary()
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    pieces = written(plain.mapInArrow(_pieces(path, size, end), _PIECES), "pieces")
    per_part = written(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(size + 1, np.int64)
    for row in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    plan = plan_packing(counts, size)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = plan.place(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = pieces.join(bases, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.expr("base + nth as rank"))
    return ranked.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def sequences(docs: DataFrame, places: DataFrame, path: str | None = None, end: int = 0) -> DataFrame:
    """``sequence_id, ids``: the packed sequences themselves, for documents with distinct ids and their ``places``."""
    path = path or vocabulary()
    asked = places.groupBy("doc_id").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("parts"))
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(asked, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = chunk_tokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                for parts, ids in zip(rows.column("parts").to_pylist(), tokenizer.encode(rows.column("text").to_pylist()),
                                      strict=True):
                    ids = np.frombuffer(ids + np.array([end], np.uint32).tobytes(), np.uint32).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p["sequence_id"] for p in parts], pa.int64()), pa.array([p["offset"] for p in parts], pa.int64()),
                         pa.array([ids[p["start"]:p["start"] + p["length"]] for p in parts], pa.list_(pa.int32()))],
                        names=["sequence_id", "offset", "ids"])

    parts = plain.mapInArrow(run, "sequence_id long, offset long, ids array<int>")
    return parts.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))
