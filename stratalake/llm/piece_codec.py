"""SentencePiece encoding and decoding through a table of distinct chunks.

Where no piece of the vocabulary holds a white-space marker after another
character, pieces cannot cross the markers: the ids of a text are those of its
marked words, one after the other. Each task segments a distinct marked word
once and puts ids together again by position. Vocabularies that allow more are
encoded text by text with the library.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

from stratalake.llm.words import process_memory

MARK = "▁"
#: Chunks that a worker remembers, and the longest that is.
REMEMBERED, LONGEST = 500_000, 100
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


def vocabulary() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


class PieceCodec:
    """Ids of texts as decimal numbers joined by commas, and their decoded texts."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.begins = np.array([p.startswith(MARK) for p in pieces])
        lone = self.model.piece_to_id(MARK)
        self.by_chunks = (
            not any(MARK in p.lstrip(MARK) for p in pieces) and lone != self.model.unk_id()
            and self.model.encode("a") == self.model.encode("a a")[:1 + len(self.model.encode("a")) // 2]
            and self.model.decode(self.model.encode(" a")) == " a"
        )
        self.number = [str(k).encode() for k in range(len(pieces))]
        self.ids: dict[str, bytes] = {}
        self.odd: dict[str, str] = {}  # chunks that decode to something else
        self.lone = self.number[lone]

    def _text(self, ids: list[int]) -> bytes:
        return b",".join(map(self.number.__getitem__, ids))

    def _learn(self, keys: list[str]) -> None:
        """A key is a chunk without its first marker, which the library adds itself."""
        plain = [k for k in keys if k and MARK not in k]
        done: set[str] = set()
        for at in range(0, len(plain), 500):
            part = plain[at:at + 500]
            ids = np.array(self.model.encode(" ".join(part)), np.int64)
            first = np.flatnonzero(self.begins[ids])
            if len(first) != len(part):
                continue
            decoded = self.model.decode(ids.tolist()).split(" ")
            if len(decoded) != len(part):
                continue
            cuts = [*first.tolist(), len(ids)]
            whole = ids.tolist()
            for k, (key, text) in enumerate(zip(part, decoded, strict=True)):
                self.ids[key] = self._text(whole[cuts[k]:cuts[k + 1]])
                if text != key:
                    self.odd[key] = text
            done.update(part)
        for key in keys:
            if key not in done:
                ids = self.model.encode(key)
                self.ids[key] = self._text(ids) if key else self.lone
                text = self.model.decode(ids) if key else ""
                if text != key.replace(MARK, " "):
                    self.odd[key] = text

    def codes(self, texts: list[str | None]) -> Iterator[tuple[bytes, str]]:
        """Joined ids and decoded text of each text."""
        for text in texts:
            if not text:
                yield b"", ""
                continue
            if not self.by_chunks:
                ids = self.model.encode(text)
                yield self._text(ids), self.model.decode(ids)
                continue
            simple = text[0] != " " and text[-1] != " " and "  " not in text and MARK not in text
            if simple:
                keys = text.split(" ")
            else:
                keys = [c[1:] for c in _CHUNK.findall(MARK + text.replace(" ", MARK))]
            new = {k for k in keys if k not in self.ids}
            if new:
                self._learn(sorted(new))
            code = b",".join(map(self.ids.__getitem__, keys))
            if not simple:
                decoded = self.model.decode([int(k) for k in code.split(b",")])
            elif self.odd and not self.odd.keys().isdisjoint(keys):
                decoded = " ".join(self.odd.get(k, k) for k in keys)
            else:
                decoded = text
            yield code, decoded
            for k in new:
                if len(k) > LONGEST:
                    self.ids.pop(k, None)
                    self.odd.pop(k, None)
            if len(self.ids) > REMEMBERED:
                self.ids.clear()
                self.odd.clear()


def codec(path: str) -> PieceCodec:
    return process_memory(f"pieces {path}", lambda: PieceCodec(path))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded``: each row's ids and what they decode to."""
    path = path or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = batch.slice(at, 64)
                found = list(pieces.codes(rows.column("text").to_pylist()))
                ids = [np.array(code.split(b",") if code else [], np.int32) for code, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array([d for _, d in found], pa.string())],
                    names=["doc_id", "ids", "decoded"])

    return _plain(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each row's ids and decoded text, without moving either.

    ``docs`` has ``doc_id`` and ``text``; other columns are not looked at. A NULL
    text is empty and has no ids. Rows are independent: repeated rows and rows
    with a NULL id give a row each. Texts of any length are encoded whole.
    """
    path = path or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                n, ids, decoded = [], [], []
                for code, text in pieces.codes(rows.column("text").to_pylist()):
                    n.append(code.count(b",") + 1 if code else 0)
                    ids.append(hashlib.sha256(code).hexdigest())
                    decoded.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _plain(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _plain(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text")
