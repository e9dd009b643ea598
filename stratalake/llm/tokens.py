"""Token ids of texts with the ``tokenizers`` library, inside tasks."""

from __future__ import annotations

import os

import numpy as np
import public_tokenizers

from stratalake.llm.words import process_memory

#: Chunks whose ids a Python worker remembers, some 200 bytes each; beyond that the memory starts anew.
REMEMBERED = 1_400_000
#: New chunks that are looked for before they are encoded.
TOGETHER = 90_000


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    return public_tokenizers.path(name)


class ChunkTokenizer:
    """Ids as little-endian unsigned 32-bit bytes, equal to those of whole texts.

    Made for vocabularies that drop white space and mark the ends of words with
    ``</w>``: no token then crosses white space, so a text's ids are those of its
    chunks between ASCII white space, and each distinct chunk is encoded once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}

    def _each(self, chunks: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [np.array(e.ids, np.uint32).tobytes() for e in found]

    def _learn(self, chunks: list[bytes]) -> None:
        """Words, with or without one sign at the end, are encoded many at a time and told apart by the ends of words."""
        if len(self.known) + len(chunks) > REMEMBERED:
            self.known.clear()
        texts = [c.decode("utf-8", "surrogatepass") for c in chunks]
        words, counts, others = [], [], []
        for chunk, text in zip(chunks, texts, strict=True):
            if text.isalpha():
                words.append((chunk, text))
                counts.append(1)
            elif text[-1] in ".,;:!?" and text[:-1].isalpha():
                words.append((chunk, text))
                counts.append(2)
            else:
                others.append((chunk, text))
        for k in range(0, len(words), 500):
            part, ends = words[k:k + 500], np.cumsum(counts[k:k + 500])
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(t for _, t in part)], add_special_tokens=False)[0].ids,
                           np.uint32)
            last = np.flatnonzero(self.ends[ids]) + 1
            if len(last) != ends[-1]:  # letters that fall apart when normalized
                others += part
                continue
            whole, at = ids.tobytes(), 0
            for (chunk, _), end in zip(part, (4 * last[ends - 1]).tolist(), strict=True):
                self.known[chunk] = whole[at:end]
                at = end
        for k in range(0, len(others), 500):
            part = others[k:k + 500]
            self.known.update(zip((c for c, _ in part), self._each([t for _, t in part]), strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        chunks = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
        known = self.known
        out = []
        start = 0
        while start < len(chunks):  # as many texts at once as the memory can hold
            new: dict[bytes, None] = {}
            stop = start
            while stop < len(chunks) and len(new) < TOGETHER:
                new.update((c, None) for c in chunks[stop] if c not in known)
                stop += 1
            if new:
                if len(known) + len(new) > REMEMBERED:
                    known.clear()
                    new = dict.fromkeys(c for own in chunks[start:stop] for c in own)
                self._learn(list(new))
            out += [b"".join(map(known.__getitem__, own)) for own in chunks[start:stop]]
            start = stop
        return out


def chunk_tokenizer(path: str) -> ChunkTokenizer:
    return process_memory(f"tokenizer {path}", lambda: ChunkTokenizer(path))
