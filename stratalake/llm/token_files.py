"""Token files: all documents' ids one after the other, with Elias-Fano coded boundaries.

A file is a Parquet file whose rows are segments of about ``SEGMENT_IDS`` ids of
successive documents, so that Spark commits, retries and reads them on any
store: the ids as little-endian numbers of 2 or 4 bytes, the documents' ids,
and the boundaries between documents within the segment. Of n boundaries up to u
each costs 2 + log2(u / n) bits; samples of the upper bits' ones let ``select``
find the i-th boundary without a table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.tables import scratch_folder
from stratalake.llm.tokens import chunk_tokenizer, vocabulary

SEGMENT_IDS = 1 << 20
#: Every so many ones of the upper bits the place is stored.
SAMPLED = 256
_HEADER = np.dtype([("count", "<u8"), ("low_bits", "<u4"), ("upper_bytes", "<u4")])


@dataclass(frozen=True)
class EliasFano:
    """A rising sequence of numbers: low bits side by side, upper bits in unary."""

    count: int
    low_bits: int
    low: np.ndarray
    upper: np.ndarray
    samples: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        values = values.astype(np.int64)
        low_bits = max(0, int(np.log2(max(1, int(values[-1]) // n)))) if n else 0
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        ones = (values >> low_bits) + np.arange(n)
        upper = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        upper[ones] = 1
        return cls(n, low_bits, np.packbits(bits.astype(np.uint8).ravel(), bitorder="little"),
                   np.packbits(upper, bitorder="little"), ones[::SAMPLED].astype("<u4"))

    def tobytes(self) -> bytes:
        head = np.array((self.count, self.low_bits, len(self.upper)), _HEADER)
        return head.tobytes() + self.upper.tobytes() + self.samples.tobytes() + self.low.tobytes()

    @classmethod
    def frombytes(cls, data: bytes) -> EliasFano:
        head = np.frombuffer(data, _HEADER, 1)[0]
        n, at = int(head["count"]), _HEADER.itemsize
        upper = np.frombuffer(data, np.uint8, int(head["upper_bytes"]), at)
        at += len(upper)
        samples = np.frombuffer(data, "<u4", -(-n // SAMPLED), at)
        return cls(n, int(head["low_bits"]), np.frombuffer(data, np.uint8, -1, at + samples.nbytes), upper, samples)

    def select(self, i: int) -> int:
        """The i-th number: from the nearest sample, then over the bytes after it."""
        at, left = int(self.samples[i // SAMPLED]), i % SAMPLED
        byte, skip = at // 8, at % 8
        while True:
            window = self.upper[byte:byte + 64]
            ones = np.flatnonzero(np.unpackbits(window, bitorder="little")[skip:])
            if len(ones) > left:
                at = 8 * byte + skip + int(ones[left])
                break
            left -= len(ones)
            byte, skip = byte + len(window), 0
        first = i * self.low_bits
        low = np.unpackbits(self.low[first // 8:(first + self.low_bits + 7) // 8], bitorder="little")
        low = low[first % 8:first % 8 + self.low_bits].astype(np.int64)
        return ((at - i) << self.low_bits) + int((low << np.arange(self.low_bits)).sum())

    def values(self) -> np.ndarray:
        upper = np.flatnonzero(np.unpackbits(self.upper, bitorder="little"))[:self.count] - np.arange(self.count)
        low = np.unpackbits(self.low, bitorder="little")[:self.count * self.low_bits].reshape(self.count, -1)
        return (upper << self.low_bits) + (low.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)


_SEGMENT = "part int, segment int, n_docs long, n_ids long, width int, boundaries binary, doc_ids binary, no_id binary, ids binary"


def _segments(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = chunk_tokenizer(path)
        part, number = TaskContext.get().partitionId(), 0
        last = np.array([end], np.uint32).tobytes()
        docs, parts, n = [], [], 0

        def row():
            ids = np.frombuffer(b"".join(parts), np.uint32)
            width = 2 if ids.max(initial=0) < 1 << 16 else 4
            starts = np.cumsum([0, *(len(p) // 4 for p in parts)])
            values = (
                part, number, len(docs), len(ids), width, EliasFano.of(starts).tobytes(),
                np.array([d or 0 for d in docs], "<i8").tobytes(), np.array([d is None for d in docs]).tobytes(),
                ids.astype("<u2" if width == 2 else "<u4").tobytes(),
            )
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 4)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, kinds, strict=True)],
                names=["part", "segment", "n_docs", "n_ids", "width", "boundaries", "doc_ids", "no_id", "ids"])

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                rows = batch.slice(at, 128)
                for doc_id, ids in zip(rows.column("doc_id").to_pylist(), tokenizer.encode(rows.column("text").to_pylist()),
                                       strict=True):
                    docs.append(doc_id)
                    parts.append(ids + last)
                    n += len(ids) // 4 + 1
                    if n >= SEGMENT_IDS:
                        yield row()
                        docs, parts, n, number = [], [], 0, number + 1
        if docs:
            yield row()

    return run


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, end: int = 2) -> None:
    """Writes all rows of ``docs (doc_id, text)`` in rising order of doc_id, NULL ids first.

    A document is its ids and the id ``end``; a NULL or empty text is ``end``
    alone. Other columns are not looked at; no rows give no files with rows. A very long text is encoded whole. Rows that share a doc_id follow each
    other, in an order that only their texts decide. No segment cuts a document.
    """
    path = path or vocabulary()
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    order = [F.col("doc_id"), F.xxhash64("text"), F.col("text")]
    ordered = plain.repartitionByRange(*order[:2]).sortWithinPartitions(*order)  # rows of one doc_id may be dealt out too
    ordered.mapInArrow(_segments(path, end), _SEGMENT).write.option("compression", "zstd").parquet(folder)


def _counted_before(segments: DataFrame, column: str) -> DataFrame:
    """``part, segment, base``: the sum of a column over all segments before each one. Windows are by writing task, then over one row of each."""
    heads = segments.select("part", "segment", column)
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = heads.groupBy("part").agg(F.sum(column).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before.orderBy("part")), F.lit(0)).alias("part_base"))
    own = F.coalesce(F.sum(column).over(before.partitionBy("part").orderBy("segment")), F.lit(0))
    return heads.withColumn("own_base", own).join(parts, "part").select("part", "segment", F.expr("part_base + own_base as base"))


def document(spark: SparkSession, folder: str, number: int) -> tuple[int | None, list[int]] | None:
    """``doc_id, ids`` of the document at a place in the files' order, from 0; None beyond the last one.

    Two selects on the boundaries of the one segment that holds it give its place among the ids; nothing else is decoded.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                s = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                i, bounds = number - s["base"], EliasFano.frombytes(s["boundaries"])
                ids = np.frombuffer(s["ids"], "<u2" if s["width"] == 2 else "<u4")[bounds.select(i):bounds.select(i + 1)]
                doc_id = None if s["no_id"][i] else int(np.frombuffer(s["doc_ids"], "<i8", 1, 8 * i)[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id], pa.int64()), pa.array([ids.tolist()], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    segments = spark.read.parquet(folder)
    holding = _counted_before(segments, "n_docs").where(F.col("base") <= number)
    found = segments.join(holding, ["part", "segment"]).where(F.col("base") + F.col("n_docs") > number)
    row = found.mapInArrow(run, "doc_id long, ids array<long>").first()
    return (row["doc_id"], row["ids"]) if row else None


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files; ``start`` counts the ids before it.

    Ids are checked where they are read; only counts per segment are shuffled.
    The one step without partitions adds up one row per writing task.
    """
    segments = spark.read.parquet(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                s = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                bounds = EliasFano.frombytes(s["boundaries"]).values()
                ids = np.frombuffer(s["ids"], "<u2" if s["width"] == 2 else "<u4").astype("<u4").tobytes()
                doc_ids = np.frombuffer(s["doc_ids"], "<i8")
                cuts = (4 * bounds).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(doc_ids), s["part"], np.int32)), pa.array(np.full(len(doc_ids), s["segment"], np.int32)),
                     pa.array(doc_ids, mask=np.frombuffer(s["no_id"], bool)), pa.array(bounds[:-1]), pa.array(np.diff(bounds)),
                     pa.array([zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.int64())],
                    names=["part", "segment", "doc_id", "within", "n_tokens", "ids_crc32"])

    rows = segments.mapInArrow(run, "part int, segment int, doc_id long, within long, n_tokens long, ids_crc32 long")
    bases = _counted_before(segments, "n_ids")
    return rows.join(bases, ["part", "segment"]).select("doc_id", F.expr("base + within as start"), "n_tokens", "ids_crc32")


def token_file_rows(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes the files below ``folder`` (a scratch folder if there is none) and reads them back."""
    folder = folder or scratch_folder(docs.sparkSession, "token-files")
    write_token_files(docs, folder)
    return read_documents(docs.sparkSession, folder)
