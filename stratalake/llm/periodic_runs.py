"""Runs of repeated word sequences, found as maximal pairs of a text's suffixes.

Words q apart are equal over a stretch exactly if the suffixes at its start and q words
on agree for the stretch's length less q. So a run of period q is a maximal pair: two
suffixes at distance q that differ in the word to their left and in the first word after
what they share. A text's repeated suffixes are sorted by prefix doubling, and its tree of
LCP intervals is gone through from the bottom up. Each interval holds the places of what
its suffixes share, in lists by the word to their left; where two children meet, places of
different lists at a distance that the length allows are runs as they stand, and nothing
needs to be extended.

What keeps it from listing all pairs: places of one string of length n at most n/2 apart
are evenly spaced, as they lie in one periodic stretch, so all but the first have the same
word to the left. A place's partners are therefore in the lists of at most three
neighbours. Smaller children are merged into larger ones. Time is O(n log² n), output is at
most a share of the text's length, and the same text is never compared with another.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.words import rows_of

#: Words of whole texts that are sorted together; a longer text is sorted alone.
TOGETHER = 1 << 18
#: Bytes of texts that are returned at once.
RETURNED = 32 << 20

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

Run = tuple[int, int, int]


def _repeated_suffixes(ids: np.ndarray, ends: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share at least ``floor`` words with another of their text, in sorted order, and the number of
    words each shares with the next one (0 where that is less than ``floor``).

    ``ids`` are word numbers, different between texts; ``ends`` is the end of each place's
    text. Places of equal prefixes of 1, 2, 4 … words get equal ranks; a place whose prefix
    is unique is not sorted any further.
    """
    n = len(ids)
    places = np.argsort(ids, kind="stable")
    slots, keys, rank, first_level = np.arange(n), ids[places].astype(np.int64), np.zeros(n + 1, np.int32), floor.bit_length() - 1
    levels: list[np.ndarray] = []
    kept = np.zeros(0, np.int64)
    pos = places
    while len(slots):
        new = np.ones(len(slots), bool)
        new[1:] = keys[1:] != keys[:-1]
        rank = rank.copy()
        rank[pos] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))] + 1
        levels.append(rank)
        slots = slots[~new | ~np.append(new[1:], True)]
        if len(levels) - 1 == first_level:
            kept = slots
        pos = places[slots]
        after = pos + (1 << (len(levels) - 1))
        keys = rank[pos].astype(np.int64) * (n + 1) + np.where(after < ends[pos], rank[np.minimum(after, n)], 0)
        order = np.argsort(keys, kind="stable")
        pos, keys = pos[order], keys[order]
        places[slots] = pos
    suffixes = places[kept]
    if not len(suffixes):
        return suffixes, suffixes
    left, right = suffixes[:-1].copy(), suffixes[1:].copy()
    shared = np.zeros(len(left), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        same = levels[level][left] == levels[level][right]
        step = np.where(same, 1 << level, 0)
        shared += step
        left += step
        right += step
    shared[shared < floor] = 0
    return suffixes, np.append(shared, 0)


class _Interval:
    """What the suffixes of an LCP interval have in common, ``length`` words, stands at ``places``; ``lists`` has these by left word."""

    __slots__ = ("length", "places", "lists")

    def __init__(self, length: int, place: int, left: int):
        self.length, self.places, self.lists = length, [place], {left: [place]}


def _add(into: list[int], more: list[int]) -> None:
    if len(more) * 16 < len(into):
        for place in more:
            insort(into, place)
    else:
        into += more
        into.sort()


def _meet(length: int, one: _Interval, other: _Interval, left: list[int], least: int, times: int, found: list[Run]) -> _Interval:
    """Two children of an interval of ``length`` words as one; adds the runs that their places form to ``found``."""
    small, large = (one, other) if len(one.places) < len(other.places) else (other, one)
    reach, places, lists = length // (times - 1), large.places, large.lists
    for i in small.places:
        low = bisect_left(places, i - reach)
        high = bisect_right(places, i + reach, low)
        if low == high:
            continue
        at = bisect_left(places, i, low, high)
        near = {left[places[low]], left[places[high - 1]], left[places[max(at - 1, low)]], left[places[min(at, high - 1)]]}
        near.discard(left[i])
        for word in near:
            same = lists[word]
            for j in same[bisect_left(same, i - reach):bisect_right(same, i + reach)]:
                period = abs(i - j)
                if period + length >= least:
                    found.append((min(i, j), period + length, period))
    _add(places, small.places)
    for word, more in small.lists.items():
        if word in lists:
            _add(lists[word], more)
        else:
            lists[word] = more
    return large


def _maximal_pairs(suffixes: list[int], shared: list[int], left: list[int], least: int, times: int) -> list[Run]:
    """``(start, length, period)`` of all maximal pairs that are long enough for their distance."""
    found: list[Run] = []
    stack: list[_Interval] = []
    for place, after in zip(suffixes, shared, strict=True):
        node = _Interval(0, place, left[place])
        while stack and stack[-1].length > after:
            top = stack.pop()
            node = _meet(top.length, top, node, left, least, times, found)
        if stack and stack[-1].length == after:
            top = stack.pop()
            node = _meet(after, top, node, left, least, times, found)
        if after:
            node.length = after
            stack.append(node)
    return found


def runs_of_texts(texts: list[list[bytes]], least: int = 24, times: int = 3) -> list[list[Run]]:
    """The runs of each text's words, by start, then period."""
    floor = least - least // times  # the fewest words that the two suffixes of a run can share
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    ids = np.zeros(int(sizes.sum()), np.int64)
    used = 0
    for start, words in zip(starts.tolist(), texts, strict=True):
        numbers: defaultdict[bytes, int] = defaultdict(count(used).__next__)
        ids[start:start + len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        used += len(numbers)
    runs: list[list[Run]] = [[] for _ in texts]
    if not used:
        return runs
    left = np.empty(len(ids), np.int64)
    left[1:] = ids[:-1]
    left[starts[sizes > 0]] = -1  # nothing stands there
    suffixes, shared = _repeated_suffixes(ids, np.repeat(starts + sizes, sizes), floor)
    if not len(suffixes):
        return runs
    smallest: dict[tuple[int, int], int] = {}  # of one stretch's periods the others are multiples
    for start, length, period in _maximal_pairs(suffixes.tolist(), shared.tolist(), left.tolist(), least, times):
        known = smallest.get((start, length))
        smallest[start, length] = period if known is None else min(known, period)
    owners = np.searchsorted(starts, np.array([s for s, _ in smallest], np.int64), side="right") - 1
    for (start, length), period, owner in zip(smallest, smallest.values(), owners.tolist(), strict=True):
        runs[owner].append((start - int(starts[owner]), length, period))
    for own in runs:
        own.sort(key=lambda r: (r[0], r[2]))
    return runs


def without_repetitions(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words but those that a run contains after its first period."""
    if not runs:
        return words
    step = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]


def collapse_runs(docs: DataFrame, least: int = 24, times: int = 3) -> DataFrame:
    """``doc_id, runs, text`` per row of ``docs (doc_id, text)``.

    Words are separated by the six ASCII white-space characters. A run is a stretch of at
    least ``least`` words and ``times`` (2 or more) times its smallest period, words a period
    apart being equal, that no word on either side goes on. ``runs`` has start (word number
    from 0), length and period of each, by start, then period. ``text`` is what is left,
    joined by single spaces, when each word goes that a run contains after that run's first
    period. Words are compared as bytes, not by hashes.

    A NULL or empty text, and one without words, has no runs and an empty text. Rows with a
    NULL doc_id and rows that share a doc_id are rows like others. No rows give no rows. A
    very long text is worked on whole by the task that reads it, with some 100 bytes a word
    per doubling of the longest repeated passage. Other columns are not looked at.
    """
    if times < 2 or least < times:
        raise ValueError("a run has at least two periods, and at least one word in each")

    def collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        size = 0

        def found() -> Iterator[tuple]:
            texts = [words for _, words in waiting]
            for (doc_id, words), runs in zip(waiting, runs_of_texts(texts, least, times), strict=True):
                yield doc_id, runs, b" ".join(without_repetitions(words, runs))

        def results() -> Iterator[tuple]:
            nonlocal size
            for doc_id, text in rows_of(batches, "doc_id", "text"):
                words = text.split() if text else []
                if waiting and size + len(words) > TOGETHER:
                    yield from found()
                    waiting.clear()
                    size = 0
                waiting.append((doc_id, words))
                size += len(words)
            yield from found()

        rows: list[tuple] = []
        held = 0
        for row in results():
            rows.append(row)
            held += len(row[2])
            if held > RETURNED or len(rows) >= 5000:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)

    read = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return read.mapInArrow(collapsed, f"doc_id long, runs {RUNS}, text binary").withColumn("text", F.col("text").cast("string"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(r) for _, r, _ in rows])]).astype(np.int32)
    flat = np.array([run for _, r, _ in rows for run in r], np.int64).reshape(-1, 3)
    runs = pa.ListArray.from_arrays(
        pa.array(offsets), pa.StructArray.from_arrays([pa.array(flat[:, k].copy()) for k in range(3)], fields=list(_RUN)))
    return pa.RecordBatch.from_arrays(
        [pa.array([i for i, _, _ in rows], pa.int64()), runs, pa.array([t for _, _, t in rows], pa.binary())],
        names=["doc_id", "runs", "text"])


# -- the query ----------------------------------------------------------------

def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, with a periodic end planted in one text of ten.

    h is the CRC-32 of the doc_id's decimal text and g = h // 10. Where 10 divides h, each
    word from a = g mod n on becomes word a + (i - a) mod p, with p = 1 + (n - a) // (3 + g mod 8).
    Rows with a NULL doc_id stay as they are.
    """
    read = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).withColumn(
        "h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    hit = F.coalesce(F.col("h") % 10 == 0, F.lit(False))

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = []
                for h, text in rows_of([part], "h", "text"):
                    words, g = text.split() if text else [], h // 10
                    if words:
                        a = g % len(words)
                        p = 1 + (len(words) - a) // (3 + g % 8)
                        words = words[:a] + [words[a + k % p] for k in range(len(words) - a)]
                    texts.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.binary())], names=["doc_id", "text"])

    planted = read.where(hit).mapInArrow(plant, "doc_id long, text binary")
    return read.where(~hit).select("doc_id", "text").union(planted)


def digest(collapsed: DataFrame) -> DataFrame:
    """Number of runs, the one with the greatest exact exponent, and digests of all runs and of the text left."""
    greatest = F.array_sort("runs", lambda x, y: (
        F.when(x["length"] * y["period"] > y["length"] * x["period"], -1)
        .when(x["length"] * y["period"] < y["length"] * x["period"], 1)
        .when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1)
        .when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0)))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    best = F.get("greatest", F.lit(0))
    return collapsed.withColumn("greatest", greatest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("get(greatest, 0).length * 1000 div get(greatest, 0).period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))
