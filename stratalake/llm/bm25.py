"""Exact top-k by BM25: an inverted index in shards, pruned by block maxima, merged by global statistics.

A shard indexes some thousand documents, ordered by length: for each term its
documents and frequencies. Documents of a shard form blocks. Terms that are in
many of a shard's documents prune nothing; what they give is added up outright,
for a group of queries and all documents at once. For the other terms of a query,
the greatest possible contribution in each block, added to the block's best sum
so far, gives an upper bound per block; blocks are taken in falling order of their
bounds, and no block whose bound is below the k-th best score so far is looked
into. Where lists are thin, so that a block has few postings of a term, bounds take
longer than the postings that they save, which are then added up too; only documents
not below the k-th best block are ranked. Bounds and scores use document frequencies and mean length of the whole
corpus, so a shard's best k are a superset of its share of the global best k.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.tables import written
from stratalake.llm.words import WordHashes, hash_words, rows_of

K1, B = 1.2, 0.75
#: A shard holds at most so many documents, and is closed beyond so many postings.
SHARD_DOCS, SHARD_POSTINGS = 16_384, 6_000_000
BLOCK = 64
#: Terms in at least one of so many documents of a shard are added up outright.
FREQUENT = 16
#: Other lists with at most so many postings per term and block, in all a query's, are added up without bounds.
THIN = 4
#: Queries that travel together.
QUERIES_TOGETHER = 256
#: Scores count to so many decimals; equal ones are ordered by doc_id.
DECIMALS = 6
_SLACK = 2 * 10.0**-DECIMALS

#: Terms are runs of ASCII letters and digits and of characters beyond ASCII, A-Z in lower case.
_TERMS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: str | None, memory: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms in rising order of their hashes, and how often each occurs."""
    words = text.encode("utf-8", "surrogatepass").translate(_TERMS).split() if text else []
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    counts = Counter(words)
    terms = hash_words(list(counts), memory)
    order = np.argsort(terms)
    return terms[order], np.fromiter(counts.values(), np.int64, len(counts))[order]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memory, number = WordHashes(), 0
    part = TaskContext.get().partitionId()
    docs: list[tuple[int, np.ndarray, np.ndarray]] = []
    postings = 0

    def shard():
        docs.sort(key=lambda d: (int(d[2].sum()), d[0]))
        terms = np.concatenate([t for _, t, _ in docs])
        counts = np.concatenate([c for _, _, c in docs])
        owner = np.repeat(np.arange(len(docs)), [len(t) for _, t, _ in docs])
        order = np.lexsort((owner, terms))
        kinds, first = np.unique(terms[order], return_index=True)
        values = (
            (part << 32) + number, len(docs), int(counts.sum()), kinds.tobytes(),
            np.append(first, len(terms)).astype(np.int32).tobytes(), owner[order].astype(np.uint16).tobytes(),
            counts[order].astype(np.int32).tobytes(), np.array([c.sum() for _, _, c in docs], np.int64).tobytes(),
            np.array([d for d, _, _ in docs], np.int64).tobytes(),
        )
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(values, [pa.int64()] * 3 + [pa.binary()] * 6, strict=True)], names=_SHARD)

    for doc_id, text in rows_of(batches, "doc_id", "text"):
        docs.append((doc_id, *terms_of(text, memory)))
        postings += len(docs[-1][1])
        if len(docs) >= SHARD_DOCS or postings >= SHARD_POSTINGS:
            yield shard()
            docs.clear()
            number, postings = number + 1, 0
    if docs:
        yield shard()


_SHARD = ["shard", "n_docs", "n_terms", "terms", "starts", "owners", "counts", "lengths", "doc_ids"]
_SHARD_SCHEMA = ("shard long, n_docs long, n_terms long, terms binary, starts binary, owners binary, counts binary, "
                 "lengths binary, doc_ids binary")


def build_index(docs: DataFrame) -> DataFrame:
    """The shards of all rows of ``docs (doc_id, text)`` with an id, written below the shared folder."""
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id is not null")
    return written(plain.mapInArrow(_shards, _SHARD_SCHEMA), "shards")


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for terms, starts in rows_of(batches, "terms", "starts"):
        yield pa.RecordBatch.from_arrays(
            [np.frombuffer(terms, np.int64), np.diff(np.frombuffer(starts, np.int32)).astype(np.int64)], names=["term", "df"])


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memory = WordHashes()
    for query_id, text in rows_of(batches, "query_id", "text"):
        terms, counts = terms_of(text, memory)
        yield pa.RecordBatch.from_arrays(
            [np.full(len(terms), query_id, np.int64), terms.view(np.int64), counts], names=["query_id", "term", "times"])


def ragged(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers ``first[i] .. first[i] + count[i]``, one range after the other."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - count), count)


class Shard:
    """A shard made ready for queries of one corpus."""

    def __init__(self, terms, starts, owners, counts, lengths, doc_ids, mean_length: float):
        self.terms, self.starts = np.frombuffer(terms, np.uint64), np.frombuffer(starts, np.int32).astype(np.int64)
        self.owners = np.frombuffer(owners, np.uint16).astype(np.int64)
        tf, length = np.frombuffer(counts, np.int32), np.frombuffer(lengths, np.int64)
        self.doc_ids = np.frombuffer(doc_ids, np.int64)
        self.worth = tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[self.owners] / mean_length))
        block = self.owners // BLOCK
        new = np.ones(len(block), bool)
        new[1:] = block[1:] != block[:-1]
        new[self.starts[:-1]] = True
        self.runs = np.append(np.flatnonzero(new), len(block))  # postings of one term in one block
        self.run_block = block[self.runs[:-1]]
        self.run_most = np.maximum.reduceat(self.worth, self.runs[:-1]) if len(block) else np.zeros(0)
        self.term_runs = np.searchsorted(self.runs, self.starts)
        self.blocks, self.edges = -(-len(self.doc_ids) // BLOCK), np.arange(0, len(self.doc_ids), BLOCK)
        df = np.diff(self.starts)
        self.row = np.full(len(df), -1)  # of the frequent terms' table
        often = np.flatnonzero(df * FREQUENT >= len(self.doc_ids))
        self.row[often] = np.arange(len(often))
        self.table = np.zeros((len(often), len(self.doc_ids)))
        for r, t in enumerate(often):
            own = slice(self.starts[t], self.starts[t + 1])
            self.table[r, self.owners[own]] = self.worth[own]

    def find(self, terms: np.ndarray) -> np.ndarray:
        """Places of terms, -1 for those that the shard does not have."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.searchsorted(self.terms, terms).clip(max=len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def best(self, places: list[np.ndarray], weights: list[np.ndarray], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query the ids and rounded scores of its k best documents with a score over zero."""
        often = np.zeros((len(places), len(self.table)))
        for q, (at, weight) in enumerate(zip(places, weights, strict=True)):
            row = np.where(at >= 0, self.row[at], -1) if len(self.row) else np.full(len(at), -1)
            often[q, row[row >= 0]] = weight[row >= 0]
        sums = often @ self.table
        for q, (at, weight) in enumerate(zip(places, weights, strict=True)):
            rest = at >= 0
            rest[rest] = self.row[at[rest]] < 0
            yield self._best(sums[q], at[rest], weight[rest], k)

    def _best(self, total: np.ndarray, at: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        first, last = self.starts[at], self.starts[at + 1]
        size = last - first
        if size.sum() <= THIN * (self.term_runs[at + 1] - self.term_runs[at]).sum():
            if len(at):
                own = [slice(a, b) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                worth = np.concatenate([self.worth[o] for o in own]) * np.repeat(weights, size)
                total = total + np.bincount(np.concatenate([self.owners[o] for o in own]), worth, len(total))
            most = np.maximum.reduceat(total, self.edges)
            limit = self._kth(most if len(most) >= k else total, k)
            docs = np.flatnonzero((total > 0) & (total >= limit))
            scores = total[docs]
        else:
            docs, scores = self._pruned(total, at, weights, k)
        scores = scores.round(DECIMALS)
        best = np.lexsort((self.doc_ids[docs], -scores))[:k]
        return self.doc_ids[docs[best]], scores[best]

    @staticmethod
    def _kth(scores: np.ndarray, k: int) -> float:
        """What a document must have, before rounding, to be among the k best if some have ``scores``."""
        return np.partition(scores, len(scores) - k)[len(scores) - k] - _SLACK if len(scores) >= k else -np.inf

    def _pruned(self, total: np.ndarray, at: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents, the k best among them, and their scores, by bounds of blocks."""
        count = self.term_runs[at + 1] - self.term_runs[at]
        runs, weight = ragged(self.term_runs[at], count), np.repeat(weights, count)
        bound = np.maximum.reduceat(total, self.edges)
        bound = bound + np.bincount(self.run_block[runs], self.run_most[runs] * weight, self.blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        docs, scores = np.zeros(0, np.int64), np.zeros(0)
        done, take = 0, 2 + -(-2 * k // BLOCK)
        while done < len(order):
            if len(scores) >= k:
                limit = self._kth(scores, k)
                take = int((bound[order[done:]] >= limit).sum())  # bounds fall
                if not take:
                    break
            chosen = np.zeros(self.blocks, bool)
            chosen[order[done:done + take]] = True
            use = chosen[self.run_block[runs]]
            size = self.runs[runs[use] + 1] - self.runs[runs[use]]
            postings = ragged(self.runs[runs[use]], size)
            more = np.bincount(self.owners[postings], self.worth[postings] * np.repeat(weight[use], size), len(self.doc_ids))
            found = ragged(np.flatnonzero(chosen) * BLOCK, np.minimum(BLOCK, len(total) - np.flatnonzero(chosen) * BLOCK))
            score = total[found] + more[found]
            docs, scores = np.concatenate([docs, found[score > 0]]), np.concatenate([scores, score[score > 0]])
            done += take
        best = scores >= self._kth(scores, k)
        return docs[best], scores[best]


_GROUP = ["query_ids", "vocabulary", "idf", "starts_of_queries", "term_numbers", "times"]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A group of queries with each of its terms once."""
    for queries, in rows_of(batches, "queries"):
        terms = np.concatenate([np.array(q["terms"], np.int64) for q in queries])
        idf = np.concatenate([np.array(q["idf"], np.float64) for q in queries])
        vocabulary, first, number = np.unique(terms.view(np.uint64), return_index=True, return_inverse=True)
        values = (
            np.array([q["query_id"] for q in queries], np.int64), vocabulary, idf[first],
            np.cumsum([0, *(len(q["terms"]) for q in queries)]).astype(np.int32), number.astype(np.int32),
            np.concatenate([np.array(q["times"], np.int32) for q in queries]),
        )
        yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in values], names=_GROUP)


def _searched(k: int, mean_length: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = None, None
        columns = ("shard", *_SHARD[3:], *_GROUP)
        for batch in batches:
            for row in range(batch.num_rows):
                own, *payload = (batch.column(c)[row].as_py() for c in columns)
                payload, group = payload[:len(_SHARD) - 3], payload[len(_SHARD) - 3:]
                if group[0] is None:  # a shard comes before its queries
                    shard, number = Shard(*payload, mean_length), own
                    continue
                if own != number:
                    raise ValueError("queries without their shard")
                kinds = (np.int64, np.uint64, np.float64, np.int32, np.int32, np.int32)
                query_ids, vocabulary, idf, starts, numbers, times = (np.frombuffer(x, t) for x, t in zip(group, kinds, strict=True))
                place = shard.find(vocabulary)
                each = [slice(a, b) for a, b in zip(starts, starts[1:], strict=False)]
                best = shard.best([place[numbers[e]] for e in each], [idf[numbers[e]] * times[e] for e in each], k)
                ids, docs, scores = zip(*(
                    (np.full(len(found), q), found, score) for q, (found, score) in zip(query_ids, best, strict=True)), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [np.concatenate(x) for x in (ids, docs, scores)], names=["query_id", "doc_id", "score"])

    return run


def top_k(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id, rank, doc_id, score``: the k best documents of each of ``queries (query_id, text)``.

    The score is the sum over the query's words, repeated words counting as often,
    of idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean length)), with
    idf = ln(1 + (N - df + 0.5) / (df + 0.5)), rounded to ``DECIMALS``; equal
    scores rank by doc_id. Only documents that share a term with the query are
    found, so a query without terms (NULL or empty text) has no rows. Documents
    with NULL or empty texts count in N and in the mean length. Rows with a NULL
    id are left out; a repeated doc_id counts and is found once per row, a
    repeated query_id is one query of both texts. Other columns are not looked at.
    """
    spark = docs.sparkSession
    index = build_index(docs)
    size = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, mean_length = size[0] or 0, max((size[1] or 0) / max(1, size[0] or 0), 1e-9)
    plain = queries.select(F.col("query_id").cast("long"), F.col("text").cast("string")).where("query_id is not null")
    asked = written(plain.mapInArrow(_query_terms, "query_id long, term long, times long"), "asked")
    df = index.select("terms", "starts").mapInArrow(_document_frequencies, "term long, df long")
    df = df.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    idf = F.log1p((F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = asked.groupBy("query_id", "term").agg(F.sum("times").alias("times")).join(
        written(df, "df").withColumn("idf", idf), "term")
    each = weighed.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("term", "times", "idf"))).alias("t")).select(
        F.struct("query_id", F.col("t.term").alias("terms"), F.col("t.times").alias("times"), F.col("t.idf").alias("idf")).alias("query"))
    each = written(each, "queries")
    groups = max(1, -(-each.count() // QUERIES_TOGETHER))
    together = each.groupBy(F.pmod(F.xxhash64("query.query_id"), F.lit(groups)).alias("group")).agg(
        F.collect_list("query").alias("queries"))
    together = written(together.mapInArrow(_packed, ", ".join(f"{c} binary" for c in _GROUP)), "together")
    # every group of queries goes to every shard: a stated set of queries against all rows, in blocks
    nothing = lambda names: [F.lit(None).cast("binary").alias(c) for c in names]
    sent = index.select("shard").crossJoin(together).select("shard", *nothing(_SHARD[3:]), *_GROUP)
    shards = index.select("shard", *_SHARD[3:], *nothing(_GROUP))
    met = shards.union(sent).repartition("shard").sortWithinPartitions("shard", F.col("query_ids").isNotNull())
    found = met.mapInArrow(_searched(k, mean_length), "query_id long, doc_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "doc_id", "score")
