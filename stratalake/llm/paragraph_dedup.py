"""Substring dedup: passages that repeat across documents are removed from all but the first.

Two kinds of paragraphs are looked at:

- lines of at least ``MIN_WORDS`` words. Their MinHash over five-word shingles
  has ``BANDS`` bands of ``ROWS`` rows (a pair of similarity 0.8 shares a band
  with a chance of 0.999); lines that share a band are verified by exact Jaccard
  and clustered by connected components.
- windows of ``WINDOW`` words, for passages that begin or end inside a line.
  They start where the hash of a window is the least of ``REACH`` successive
  ones, so any passage of more than ``MIN_WORDS`` words, wherever it stands, has
  the same window in every copy. Their single band is the whole content. Equal
  windows that follow each other at even distance, as in words repeated over and
  over, are one row, and are compared with those of the first document in order.
  Windows that follow each other alike in two documents form runs; a run is
  verified word by word and extended to both sides as far as the words agree.

Members of a bucket are first compared with its first one. Then lines of a bucket
that are in different clusters are compared across those; and windows around
which a document does not agree with that first one give all passages of
``MIN_WORDS`` words that hold them, which are grouped by content.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.components import components
from stratalake.llm.tables import removed, written
from stratalake.llm.words import forget, gathered, hash_words, mix, rows_of, shingle_set, shingles, signed, split_words

#: A passage is removed if it has at least so many words.
MIN_WORDS = 50
WINDOW, REACH = 20, 31
BANDS, ROWS, SHINGLE, SIMILARITY = 10, 3, 5, 0.8
#: Lines of a bucket that are compared in one group.
BLOCK = 256

_ODD = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64), 101) | np.uint64(1)
_WORD = re.compile(r"[^ \t-\r]+")


def _extreme(values: np.ndarray, length: int, choose) -> np.ndarray:
    """Minimum or maximum of each ``length`` successive values, by doubling."""
    done, out = 1, values
    while 2 * done <= length:
        out = choose(out[:-done], out[done:])
        done *= 2
    return choose(out[:len(out) - (length - done)], out[length - done:]) if length > done else out


def _content(hashes: np.ndarray, length: int, seed: int) -> np.ndarray:
    """A hash of each ``length`` successive words, by doubling."""
    part, size, out, done = mix(hashes, seed), 1, None, 0
    while True:
        if length & size:
            n = len(hashes) - done - size + 1
            out = part[done:done + n] if out is None else mix(out[:n] ^ (part[done:done + n] << np.uint64(1)), seed + 1 + size)
            done += size
        if done == length:
            return out
        part, size = mix(part[:-size] ^ (part[size:] << np.uint64(1)), seed + 100 + size), 2 * size


def window_starts(hashes: np.ndarray, left: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the chosen windows and their content hashes.

    ``left`` says how many words its text has from each place on, if several texts follow each other.
    """
    if len(hashes) < WINDOW + REACH - 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if left is None:
        left = np.arange(len(hashes), 0, -1)
    content = _content(hashes, WINDOW, 1000)
    least = _extreme(content, REACH, np.minimum)
    least = np.where(left[:len(least)] >= WINDOW + REACH - 1, least, np.uint64(0))  # none that reaches into the next text
    pad = np.zeros(REACH - 1, np.uint64)
    chosen = _extreme(np.concatenate([pad, least, pad]), REACH, np.maximum) == content
    chosen = np.flatnonzero(chosen & (left[:len(content)] >= WINDOW))
    return chosen, content[chosen]


def stretches(at: np.ndarray, key: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal windows of a text that follow each other, ``every`` so many words: number of the first one, how many, and ``every`` (0: one)."""
    gap = np.diff(at, prepend=at[:1])
    gap[1:][(key[1:] != key[:-1]) | (text[1:] != text[:-1]) | (gap[1:] > REACH)] = 0
    before = np.concatenate([gap[:1], gap[:-1]])
    head = np.flatnonzero((gap == 0) | (before > 0) & (gap != before))
    times = np.diff(head, append=len(at))
    return head, times, np.where(times > 1, gap[np.minimum(head + 1, len(at) - 1)], 0)


def _windows_of(start: np.ndarray, n: np.ndarray, every: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of stretches: which stretch's, the how manieth of it, and where it starts."""
    times = _times(n, every)
    row = np.repeat(np.arange(len(start)), times)
    k = np.arange(len(row)) - (np.cumsum(times) - times)[row]
    return row, k, start[row] + k * every[row]


def _times(n: np.ndarray, every: np.ndarray) -> np.ndarray:
    return (n - WINDOW) // np.maximum(every, 1) + 1


def long_lines(text: str) -> list[tuple[int, int]]:
    """First word and number of words of each line, and of each paragraph between blank lines, of at least ``MIN_WORDS`` words."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass") + b"\n\n", np.uint8)
    space = (raw == 32) | (raw >= 9) & (raw <= 13)
    before = np.cumsum(~space & np.append(True, space[:-1]))[raw == 10]  # words up to each line's end
    found, at, top = {}, 0, 0
    for end in before.tolist():
        for start in (at, top) if end > at else (top,):
            if end - start >= MIN_WORDS and (start == at or end == at):
                found[start, end - start] = None
        top = top if end > at else end
        at = end
    return list(found)


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """Keys of the bands, one row per set of shingles."""
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    flat = mix(np.concatenate(sets), 301)
    least = np.stack([np.minimum.reduceat(flat * odd, starts) for odd in _ODD], axis=1).reshape(len(sets), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sets), BANDS))
    for row in range(ROWS):
        keys = mix(keys ^ least[:, :, row], 310 + row)
    return keys


def _keys(texts: list[tuple[int, np.ndarray, list[tuple[int, int]]]]) -> pa.RecordBatch:
    """Windows and lines of texts (id, hashes of words, lines), all at once: a numpy call costs as much as a short text's work."""
    hashes = np.concatenate([own for _, own, _ in texts])
    ids, n = np.array([t[0] for t in texts], np.int64), np.array([len(t[1]) for t in texts])
    top, text = np.cumsum(n) - n, np.repeat(np.arange(len(texts)), n)
    at, key = window_starts(hashes, (top + n)[text] - np.arange(len(hashes)))
    head, times, every = stretches(at, key, text[at])
    at, key = at[head], key[head]
    doc, start, length = ids[text[at]], at - top[text[at]], WINDOW + (times - 1) * every
    line = np.zeros(len(at), bool)
    if lines := [(k, *line) for k, t in enumerate(texts) for line in t[2]]:
        owner, first, size = np.array(lines).T
        spans = list(zip((top[owner] + first).tolist(), size.tolist(), strict=True))
        part = shingles(hashes, SHINGLE)
        # a band of its own for equal lines
        whole = [xxhash.xxh64_intdigest(hashes[a:a + k].tobytes(), 320) for a, k in spans]
        own = np.column_stack([band_keys([part[a:a + k - SHINGLE + 1] for a, k in spans]), np.array(whole, np.uint64)])
        key = np.concatenate([key, own.ravel()])
        doc, start, length = (
            np.concatenate([x, np.repeat(y, own.shape[1])]) for x, y in ((doc, ids[owner]), (start, first), (length, size)))
        line = np.arange(len(key)) >= len(every)
        every = np.concatenate([every, np.zeros(len(key) - len(every), np.int64)])
    return pa.RecordBatch.from_arrays(
        [signed(key), doc, start.astype(np.int32), length.astype(np.int32), pa.array(every.astype(np.int32), mask=line)],
        names=["key", "doc_id", "start", "n", "every"])


def _paragraphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    texts, held = [], 0
    for doc_id, text in rows_of(batches, "doc_id", "text"):
        words = split_words(text)
        if len(words) < MIN_WORDS:
            continue
        hashes = hash_words(words)
        texts.append((doc_id, hashes, long_lines(text)))
        held += len(hashes)
        if held > 100_000:
            yield _keys(texts)
            texts, held = [], 0
    if texts:
        yield _keys(texts)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of a document that follow each other as they do in the other document, as one run with room on both sides."""
    for batch in batches:
        windows = batch.column("windows")
        doc = np.repeat(batch.column("doc_id").to_numpy(), np.diff(windows.offsets.to_numpy()))
        if not len(doc):
            continue
        start, n, every, hub_doc, hub_start, hub_n, hub_every = (windows.flatten().field(c).to_numpy() for c in _STRETCH)
        row, k, start = _windows_of(start, n, every)
        # in order with those of the other document, again from its first one if it has fewer
        k = np.where((every == hub_every)[row], k % _times(hub_n, hub_every)[row], 0)
        doc, hub_doc, hub_start = doc[row], hub_doc[row], hub_start[row] + k * hub_every[row]
        order = np.lexsort((start, start - hub_start, hub_doc, doc))
        doc, hub_doc, start, shift = doc[order], hub_doc[order], start[order], (start - hub_start)[order]
        goes_on = (np.diff(doc) == 0) & (np.diff(hub_doc) == 0) & (np.diff(shift) == 0) & (np.diff(start) <= REACH)
        first = np.flatnonzero(np.append(True, ~goes_on))
        lo, hi = start[first], start[np.append(first[1:], len(start)) - 1] + WINDOW
        doc, hub_doc, shift = doc[first], hub_doc[first], shift[first]
        room = np.minimum(REACH, np.minimum(lo, lo - shift))
        rows = (lo - room, hi + REACH, hub_doc, lo - room - shift, hi + REACH - shift, room, hi - lo)
        kinds = (pa.int32(), pa.int32(), pa.int64(), *[pa.int32()] * 4)
        yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), *map(pa.array, rows, kinds)], names=_RUN)


_STRETCH = ["start", "n", "every", "hub_doc", "hub_start", "hub_n", "hub_every"]
_RUN = ["doc_id", "lo", "hi", "hub_doc", "hub_lo", "hub_hi", "room", "n"]
_RUN_SCHEMA = "doc_id long, lo int, hi int, hub_doc long, hub_lo int, hub_hi int, room int, n int"


def islands(parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Parts of a text that overlap, as one."""
    out: list[list[int]] = []
    for lo, hi in sorted(parts):
        if out and lo < out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word hashes of the asked-for parts of texts; parts that overlap are given once, together."""
    rows, held = [], 0
    names = ["island_doc", "island_lo", "island_hi", "island"]
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
    for doc_id, text, parts in _with_parts(batches):
        words = split_words(text)
        for lo, hi in islands(parts):
            rows.append((doc_id, lo, hi, hash_words(words[lo:hi]).astype(np.uint32).tobytes()))
            held += hi - lo
            if held > 500_000 or len(rows) >= 10_000:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows, strict=True), kinds)), names=names)
                rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows, strict=True), kinds)), names=names)


def _with_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, list[tuple[int, int]]]]:
    for batch in batches:
        ends = batch.column("parts").offsets.to_numpy()
        lo, hi = (batch.column("parts").values.field(c).to_numpy() for c in ("lo", "hi"))
        for (doc_id, text), a, b in zip(rows_of([batch], "doc_id", "text"), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            yield doc_id, text, list(zip(lo[a:b].tolist(), hi[a:b].tolist(), strict=True))


def _with_words(rows: DataFrame, parts: DataFrame, doc_id: str, lo: str, hi: str, words: str) -> DataFrame:
    """The rows with the word hashes of a part of a text, out of the island that it is in."""
    inside = (F.col(doc_id) == F.col("island_doc")) & (F.col(lo) >= F.col("island_lo")) & (F.col(hi) <= F.col("island_hi"))
    cut = F.substring("island", 4 * (F.col(lo) - F.col("island_lo")) + 1, 4 * (F.col(hi) - F.col(lo)))
    return rows.join(parts, inside).select(*rows.columns, cut.alias(words))


def shingle_sets(lines: list[bytes]) -> list[np.ndarray]:
    """The shingle set of each line, given as hashes of its words."""
    words = [np.frombuffer(line, np.uint32) for line in lines]
    starts = np.cumsum([0, *map(len, words)]).tolist()
    flat = shingles(np.concatenate([*words, np.zeros(0, np.uint32)]).astype(np.uint64), SHINGLE)
    return [np.unique(flat[at:at + len(w) - SHINGLE + 1]) if len(w) >= SHINGLE else shingle_set(w.astype(np.uint64), SHINGLE)
            for w, at in zip(words, starts, strict=False)]


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Exact Jaccard of two sets of shingles."""
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common >= SIMILARITY * (len(x) + len(y) - common) and common > 0


def _alike(rows: pa.RecordBatch) -> pa.RecordBatch:
    """How far the aligned parts of runs agree around the run itself, ``n`` words after ``room`` words; runs that do not are left out."""
    (x, at_x, n_x), (y, at_y, n_y) = (_words_of(rows.column(c)) for c in ("words", "hub_words"))
    lo, hi, hub_lo, room, n = (rows.column(c).to_numpy() for c in ("lo", "hi", "hub_lo", "room", "n"))
    m = np.minimum(n_x, n_y)
    keep = np.flatnonzero(m >= room + n)
    m, room, n, lo, hi, hub_lo, n_x = m[keep], room[keep], n[keep], lo[keep], hi[keep], hub_lo[keep], n_x[keep]
    begin, row = np.cumsum(m) - m, np.repeat(np.arange(len(m)), m)
    place = np.arange(len(row)) - begin[row]
    other = x[at_x[keep][row] + place] != y[at_y[keep][row] + place]
    inner = (place >= room[row]) & (place < (room + n)[row])
    agree = np.add.reduceat((inner & ~other).astype(np.int64), begin) if len(m) else m
    first = np.maximum.reduceat(np.where(other & (place < room[row]), place + 1, 0), begin) if len(m) else m
    last = np.minimum.reduceat(np.where(other & (place >= (room + n)[row]), place, m[row]), begin) if len(m) else m
    ended = (last == n_x) & (n_x < hi - lo)
    same_to = pa.array(np.where(ended, 1 << 30, lo + last).astype(np.int32), mask=agree < n)
    good = agree / n >= SIMILARITY
    none = pa.nulls(len(m), pa.int32())
    found = [pa.array((lo + first).astype(np.int32)), pa.array((lo + last).astype(np.int32)), rows.column("hub_doc").take(pa.array(keep)),
             pa.array((lo - hub_lo).astype(np.int32)), same_to, none, none]
    return pa.RecordBatch.from_arrays([rows.column("doc_id").take(pa.array(keep)), *found], names=list(_VERIFIED)).filter(pa.array(good))


def _words_of(column: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words of a column, and each row's first one and number of words."""
    values = column.to_pylist()
    n = np.array([len(v) // 4 for v in values], np.int64)
    return np.frombuffer(b"".join(values), np.uint32), np.cumsum(n) - n, n


def _similar_lines(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Pairs of similar lines."""
    a, b = (rows.column(c).to_pylist() for c in ("words", "hub_words"))
    unlike = [k for k in range(len(a)) if a[k] != b[k]]
    good = np.array([len(x) > 0 for x in a], bool)
    good[unlike] = [similar(x, y) for x, y in zip(shingle_sets([a[k] for k in unlike]), shingle_sets([b[k] for k in unlike]), strict=True)]
    none = pa.nulls(len(a), pa.int32())
    found = [rows.column(c) for c in ("doc_id", "lo", "hi", "hub_doc")]
    return pa.RecordBatch.from_arrays([*found, none, none, rows.column("hub_lo"), rows.column("hub_hi")], names=list(_VERIFIED)).filter(pa.array(good))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verified runs and lines, which have ``hub_lo, hub_hi`` instead of ``shift, same_to``.

    ``same_to`` is the end of a run without any other word, or beyond all words at the text's end.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            rows = batch.slice(at, 2000)
            line = rows.column("room").is_null()
            yield _alike(rows.filter(pc.invert(line)))
            yield _similar_lines(rows.filter(line))


_VERIFIED = {"doc_id": "long", "first": "int", "last": "int", "hub_doc": "long", "shift": "int", "same_to": "int", "hub_lo": "int", "hub_hi": "int"}


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Content of each passage of ``MIN_WORDS`` words around the asked-for windows, as 128 bits; equal ones that overlap are given together."""
    for doc_id, text, asked in rows_of(batches, "doc_id", "text", "asked"):
        hashes = hash_words(split_words(text))
        if len(hashes) < MIN_WORDS:
            continue
        starts = np.unique(_windows_of(*np.array([(a["start"], a["n"], a["every"]) for a in asked], np.int64).T)[2])
        at = np.unique((starts[:, None] - np.arange(MIN_WORDS - WINDOW + 1)).ravel())
        at = at[(at >= 0) & (at <= len(hashes) - MIN_WORDS)]
        one, two = (_content(hashes, MIN_WORDS, seed)[at] for seed in (2000, 3000))
        order = np.lexsort((at, two, one))
        one, two, at = one[order], two[order], at[order]
        goes_on = (one[1:] == one[:-1]) & (two[1:] == two[:-1]) & (np.diff(at) <= MIN_WORDS)
        head = np.flatnonzero(np.append(True, ~goes_on)[:len(at)])
        one, two, first, last = one[head], two[head], at[head], at[np.append(head[1:], len(at))[:len(head)] - 1] + MIN_WORDS
        for k in range(0, len(head), 50_000):
            part = slice(k, k + 50_000)
            yield pa.RecordBatch.from_arrays(
                [signed(one[part]), signed(two[part]), pa.array(np.full(len(first[part]), doc_id, np.int64)),
                 pa.array(first[part].astype(np.int32)), pa.array(last[part].astype(np.int32))], names=["one", "two", "doc_id", "first", "last"])


def _similar_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between similar lines of different clusters and documents."""
    kinds = {"doc_id": pa.int64(), "lo": pa.int32(), "hi": pa.int32()}
    for batch in batches:
        ends = batch.column("members").offsets.to_numpy()
        at = 0
        while at < batch.num_rows:  # buckets of some thousand members at a time
            stop = max(at + 1, int(np.searchsorted(ends, ends[at] + 8192, "right")) - 1)
            part = batch.slice(at, stop - at)
            found = _similar_members(part, (ends[at:stop + 1] - ends[at]).tolist())
            nodes = [pa.StructArray.from_arrays([pa.array(x[:, k].copy()).cast(kind) for k, kind in enumerate(kinds.values())], names=list(kinds))
                     for x in found]
            yield pa.RecordBatch.from_arrays(nodes, names=["a", "b"])
            at = stop


def _similar_members(buckets: pa.RecordBatch, ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Both nodes of the links of buckets, whose members end at ``ends``."""
    members = buckets.column("members").flatten()
    sets = shingle_sets(members.field("words").to_pylist())
    sizes, block = np.array(list(map(len, sets)), np.int64), members.field("block").to_numpy()
    component, one, other = (
        np.stack([members.field(c).field(f).to_numpy() for f in ("doc_id", "lo", "hi")], axis=1) for c in ("component", "one", "other"))
    a, b = [np.zeros((0, 3), np.int64)], [np.zeros((0, 3), np.int64)]
    for (low, high), start, end in zip(rows_of([buckets], "low", "high"), ends[:-1], ends[1:], strict=True):
        there = np.flatnonzero(sizes[start:end] > 0) + start
        first, second = there[block[there] == low], there[block[there] == high]
        for i in first.tolist():
            j = second[second > i] if low == high else second
            j = j[(component[j] != component[i]).any(axis=1) & (np.minimum(sizes[j], sizes[i]) >= SIMILARITY * np.maximum(sizes[j], sizes[i]))]
            if not len(j):
                continue
            # equal lines stand for each other
            use_one, use_other = one[j, 0] != one[i, 0], one[j, 0] != other[i, 0]
            x = np.where((use_one | ~use_other)[:, None], one[i], other[i])
            y = np.where((use_one | use_other)[:, None], one[j], other[j])
            flat = np.concatenate([sets[k] for k in j.tolist()])
            at = np.minimum(np.searchsorted(sets[i], flat), sizes[i] - 1)
            common = np.add.reduceat((sets[i][at] == flat).astype(np.int64), np.cumsum(sizes[j]) - sizes[j])
            near = (x[:, 0] != y[:, 0]) & (common > 0) & (common >= SIMILARITY * (sizes[j] + sizes[i] - common))
            a.append(x[near])
            b.append(y[near])
    return np.concatenate(a), np.concatenate(b)


_NODE = "struct<doc_id: long, lo: int, hi: int>"


def _across(lines: DataFrame, labels: DataFrame, parts: DataFrame) -> DataFrame:
    """Links ``a, b`` of similar lines of buckets that hold lines of different clusters.

    Buckets with the same members count once; words join them only after that.
    """
    at = lambda node, new: labels.select(F.col("node").alias(node), F.col("component").alias(new))
    nodes = lines.select("key", F.struct("doc_id", "lo", "hi").alias("node"), F.expr(
        "named_struct('doc_id', hub_doc, 'lo', hub_lo, 'hi', hub_hi)").alias("hub"))
    placed = nodes.join(at("node", "c"), "node", "left").join(at("hub", "c_hub"), "hub", "left").select(
        "key", "node", "hub", F.coalesce("c", "node").alias("c"), F.coalesce("c_hub", "hub").alias("c_hub"))
    placed = written(placed, "placed")
    open_keys = written(placed.where("c <> c_hub").select("key").distinct(), "open")
    inside = placed.join(open_keys, "key", "left_semi")
    inside = written(inside.select("key", "node", "c").union(inside.select("key", "hub", "c_hub")).distinct(), "inside")
    known = _with_words(inside.select("node").distinct().select("*", "node.*"), parts, "doc_id", "lo", "hi", "words")
    known = written(known.select("node", "words", F.xxhash64("words").alias("digest")), "known")
    members = inside.join(known.select("node", "digest"), "node").groupBy("key", F.col("c").alias("component"), "digest").agg(
        F.min("node").alias("one"), F.max("node").alias("other"))
    members = written(members, "members")
    removed(placed, open_keys, inside)
    content = members.groupBy("key").agg(
        F.bit_xor(F.xxhash64("component", "digest", "one", "other")).alias("content"), F.count("*").alias("n"))
    once = content.groupBy("content", "n").agg(F.min("key").alias("key"))
    blocks = once.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("one", F.lit(3)), F.col("blocks")).cast("int"))
    dealt = dealt.join(known.select(F.col("node").alias("one"), "words"), "one")
    split = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    grouped = split.groupBy("key", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high")).agg(
        F.collect_list(F.struct("component", "one", "other", "words", "block")).alias("members"))
    found = written(grouped.mapInArrow(lambda batches: gathered(_similar_in_blocks(batches)), f"a {_NODE}, b {_NODE}").distinct(), "across")
    removed(members, known)
    return found


def _longer_with_others(texts: DataFrame, windows: DataFrame, runs: DataFrame) -> DataFrame:
    """``doc_id, first, last`` of passages that repeat an earlier document other than the window's first one.

    A window is settled where every passage of ``MIN_WORDS`` words that holds it is the same in
    that first document. All the others of a bucket give their passages, its first one does too.
    """
    settled = runs.where("same_to is not null").select(
        F.col("doc_id").alias("d"), F.col("hub_doc").alias("h"), F.col("shift").alias("s"), F.col("first").alias("f"), "same_to")
    end = F.col("start") + F.col("n") - WINDOW + MIN_WORDS
    around = (F.col("f") <= F.greatest(F.col("start") - (MIN_WORDS - WINDOW), F.lit(0))) & (F.col("same_to") >= end)
    rest = windows.join(settled, (F.col("doc_id") == F.col("d")) & (F.col("hub_doc") == F.col("h")) & (
        F.col("start") - F.col("hub_start") == F.col("s")) & around, "left_anti")
    rest = written(rest.select("doc_id", *_STRETCH).distinct(), "rest")
    held = rest.groupBy("hub_doc", "hub_start").agg(
        F.max(F.struct("hub_n", "hub_every")).alias("hub"), F.count("*").alias("rows"), F.max("n").alias("longest"),
        F.max(F.col("doc_id") != F.col("hub_doc")).alias("others"))
    several = f"(rows > 1 or longest > {WINDOW} or hub.hub_n > {WINDOW})"
    held = written(held.where(f"{several} and others").select("hub_doc", "hub_start", "hub.*"), "held")
    asked = rest.join(held.select("hub_doc", "hub_start"), ["hub_doc", "hub_start"]).select("doc_id", "start", "n", "every").union(held)
    asked = asked.groupBy("doc_id").agg(F.collect_set(F.struct("start", "n", "every")).alias("asked"))
    passages = texts.join(asked, "doc_id").mapInArrow(
        lambda batches: gathered(_passages(batches)), "one long, two long, doc_id long, first int, last int").distinct()
    earliest = F.first("doc_id").over(Window.partitionBy("one", "two").orderBy("doc_id"))
    found = written(passages.withColumn("hub", earliest).where("doc_id <> hub").select("doc_id", "first", "last"), "passages")
    removed(rest, held)
    return found


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, first, last``: word positions (last exclusive) that repeat an earlier document's words.

    Earlier is the smaller (doc_id, position). Spans of one document may overlap
    and may be shorter than ``MIN_WORDS``; ``without_spans`` settles both.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id is not null")
    keyed = texts.mapInArrow(_paragraphs, "key long, doc_id long, start int, n int, every int")
    by_key = Window.partitionBy("key").orderBy("doc_id", "start", F.desc("n"))
    shared = keyed.withColumn("hub", F.first(F.struct("doc_id", "start", "n", "every")).over(by_key)).where(
        "doc_id <> hub.doc_id or start <> hub.start")
    shared = written(
        shared.select(F.when(F.col("every").isNull(), F.col("key")).alias("key"), "doc_id", "start", "n", "every", F.col("hub.doc_id").alias("hub_doc"),
                      F.col("hub.start").alias("hub_start"), F.col("hub.n").alias("hub_n"), F.col("hub.every").alias("hub_every")), "shared")
    windows = shared.where("every is not null and hub_every is not null")
    runs = (
        windows.where("doc_id <> hub_doc").groupBy("doc_id")
        .agg(F.collect_set(F.struct(*_STRETCH)).alias("windows"))
        .mapInArrow(_runs, _RUN_SCHEMA)
    )
    lines = shared.where("every is null and hub_every is null").select(
        "key", "doc_id", F.col("start").alias("lo"), F.expr("start + n as hi"), "hub_doc",
        F.col("hub_start").alias("hub_lo"), F.expr("hub_start + hub_n as hub_hi"))
    pairs = written(runs.union(lines.where("doc_id <> hub_doc").drop("key").distinct().select(
        "*", F.lit(None).cast("int").alias("room"), F.lit(None).cast("int").alias("n"))), "pairs")
    asked = pairs.select("doc_id", "lo", "hi").union(pairs.select("hub_doc", "hub_lo", "hub_hi")).union(
        lines.where("doc_id = hub_doc").select("doc_id", "lo", "hi")).union(
        lines.where("doc_id = hub_doc").select("hub_doc", "hub_lo", "hub_hi")).distinct()
    asked = asked.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("parts"))
    parts = texts.join(asked, "doc_id").mapInArrow(lambda batches: gathered(_slices(batches)), "island_doc long, island_lo int, island_hi int, island binary")
    parts = written(parts.dropDuplicates(["island_doc", "island_lo"]), "parts")
    both = _with_words(_with_words(pairs, parts, "doc_id", "lo", "hi", "words"), parts, "hub_doc", "hub_lo", "hub_hi", "hub_words")
    verified = both.mapInArrow(lambda batches: gathered(_verified(batches)), ", ".join(f"{c} {kind}" for c, kind in _VERIFIED.items()))
    verified = written(verified, "verified")
    removed(pairs)

    same_runs = verified.where("hub_lo is null")
    longer = _longer_with_others(texts, windows, same_runs)
    run_spans = same_runs.select("doc_id", "first", "last").union(longer)
    links = verified.where("hub_lo is not null").select(
        F.expr("named_struct('doc_id', doc_id, 'lo', first, 'hi', last)").alias("a"),
        F.expr("named_struct('doc_id', hub_doc, 'lo', hub_lo, 'hi', hub_hi)").alias("b"))
    clusters = components(links)
    more = _across(lines, clusters, parts)
    removed(shared, parts)
    if not more.isEmpty():
        removed(clusters)
        clusters = components(links.union(more))
    removed(more)
    line_spans = clusters.where("node.doc_id <> component.doc_id").select(
        F.col("node.doc_id").alias("doc_id"), F.col("node.lo").alias("first"), F.col("node.hi").alias("last"))
    return run_spans.union(line_spans)


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one; those of at least ``MIN_WORDS`` words."""
    out: list[list[int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out if b - a >= MIN_WORDS]


def without_spans(text: str, spans: list[tuple[int, int]]) -> tuple[str, int]:
    """The text without those words, and how many were removed.

    Where words were, one line break stays if there was one on either side, or
    one space; nothing at the ends of the text. All else stays as it is.
    """
    words = [m.span() for m in _WORD.finditer(text)]
    kept, at, removed = "", 0, 0
    for first, last in spans:
        last = min(last, len(words))
        if first >= last:
            continue
        start, end = words[first][0], words[last - 1][1]
        before = text[at:start]
        head = before.rstrip(" \t\n\v\f\r")
        after = text[end:words[last][0]] if last < len(words) else text[end:]
        broken = "\n" in before[len(head):] + after
        kept += head
        if kept and last < len(words):
            kept += "\n" if broken else " "
        at, removed = end + len(after), removed + last - first
    return kept + text[at:], removed


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, removed, cuts = [], [], []
        ends = batch.column("repeated_spans").offsets.to_numpy().tolist()
        first, last = (batch.column("repeated_spans").values.field(c).to_pylist() for c in ("first", "last"))
        for (text,), a, b in zip(rows_of([batch], "text"), ends[:-1], ends[1:], strict=True):
            cut = merged_spans(list(zip(first[a:b], last[a:b], strict=True)))
            text, n = without_spans(text, cut) if cut else (text, 0)
            texts.append(text)
            removed.append(n)
            cuts.append([{"first": a, "last": b} for a, b in cut])
        place = batch.schema.get_field_index
        batch = batch.set_column(place("text"), batch.schema.field("text"), pa.array(texts, batch.schema.field("text").type))
        span = batch.schema.field("repeated_spans")
        batch = batch.set_column(place("repeated_spans"), span, pa.array(cuts, span.type))
        yield batch.append_column("removed_words", pa.array(removed, pa.int64()))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with its text cut, and ``repeated_spans`` (word positions cut) and ``removed_words``.

    All columns of ``docs`` but ``doc_id`` and ``text`` are carried along; those
    named like the two new columns are replaced. Words are runs of anything but
    ASCII white space and are compared with A-Z in lower case. A NULL text or a
    row with a NULL id stays as it is, as do texts of fewer than ``MIN_WORDS``
    words. Repeats inside one document stay. Rows that share a doc_id are taken
    for one document and are all cut at the spans found for it.
    """
    spans = repeated_spans(docs).groupBy("doc_id").agg(
        F.collect_set(F.struct("first", "last")).alias("repeated_spans"))
    kept = docs.drop("repeated_spans", "removed_words").withColumn("text", F.col("text").cast("string"))
    joined = kept.join(spans, kept["doc_id"].cast("long") == spans["doc_id"], "left").select(
        *[kept[c] for c in kept.columns], "repeated_spans")
    schema = T.StructType([*joined.schema.fields, T.StructField("removed_words", T.LongType())])
    return joined.mapInArrow(_cut, schema)
