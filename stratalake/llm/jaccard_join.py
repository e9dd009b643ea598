"""Similarity join of texts by the Jaccard similarity of their word shingles, with PartEnum signatures.

Two sets whose Jaccard similarity is at least g and of which the larger has at
most r elements differ in at most k = floor(2 r (1 - g) / (1 + g)) elements.
Sizes are cut into bands; for each band the domain of shingles is dealt out to
parts. With n1 = floor(k / 2) + 1 first-level parts of n2 second-level parts each,
some first-level part holds at most one of the differing elements, so all but one
of its second-level parts are equal in both sets. Each set therefore emits, for
every first-level part, one signature for every choice of n2 - 1 second-level
parts, and linked sets share a signature. Small sets are often of similar make
without being linked, so bands up to ``SMALL`` have n2 = 8, larger ones n2 = 3; a
signature rests on some ten elements. A set takes part in its own band and, when a
larger partner may be in the next band, in that one as well.

In bands above ``SMALL`` a signature of parts without any element is left out, as
it says nothing and would be shared by unrelated sets. As the parts are dealt by a
hash, a linked pair shares a dozen signatures at the least on average, each of
them empty with a chance below 1 in 1,000: losing all is less likely than a
collision of the 64-bit hashes that stand for shingles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.components import components
from stratalake.llm.tables import removed, written
from stratalake.llm.words import forget, gathered, hash_words, mix, rows_of, shingle_set, signed, split_words

#: Bands of sizes grow by this factor.
BAND_GROWTH = 1.35
#: Largest set of the bands with more second-level parts.
SMALL = 300
#: Counters of a sketch: how many shingles of a set fall into each of so many cells, and of finer ones, modulo 4.
CELLS, FINE = 96, 512
#: Members of a bucket that are compared with as many others at a time.
BLOCK = 256


def band_of(size: int) -> tuple[int, int]:
    """Number and largest size of the band of a set's size; sizes from 1."""
    number, top = 0, 1
    while size > top:
        number, top = number + 1, max(top + 1, int(top * BAND_GROWTH))
    return number, top


def next_band(number: int, top: int) -> tuple[int, int]:
    return number + 1, max(top + 1, int(top * BAND_GROWTH))


def differing(top: int, percent: int) -> int:
    """How many elements linked sets of at most ``top`` elements may differ in."""
    return 2 * top * (100 - percent) // (100 + percent)


def band_signatures(dealt: np.ndarray, worth: np.ndarray, number: int, top: int, percent: int) -> np.ndarray:
    """The signatures of a set in one band; a place and a value per element."""
    k = differing(top, percent)
    n1 = k // 2 + 1
    n2 = (3 if top > SMALL else 8) if k else 1  # without differing elements the whole set is its signature
    sums = np.zeros(n1 * n2, np.uint64)
    np.add.at(sums, (dealt % np.uint64(n1 * n2)).astype(np.int64), worth)
    sums = sums.reshape(n1, n2)
    base = mix(np.arange(n1, dtype=np.uint64) + np.uint64(number * 1_000_003), 17)
    part = np.arange(n2, dtype=np.uint64)
    own = mix(sums ^ mix(part, 19), 20)
    rest = own.sum(axis=1)[:, None] - (own if k else np.uint64(0))  # all parts but one, for each one
    found = mix(base[:, None] ^ rest ^ mix(part, 23), 24)
    if top > SMALL:
        filled = sums != 0
        return found[filled.sum(axis=1)[:, None] > (filled if k else 0)]
    return found.ravel()


def set_signatures(values: np.ndarray, percent: int) -> np.ndarray:
    if not len(values):
        return values
    dealt, worth = mix(values, 11), mix(values, 13)
    number, top = band_of(len(values))
    found = [band_signatures(dealt, worth, number, top, percent)]
    while True:
        number, top_next = next_band(number, top)
        if 100 * len(values) < percent * (top + 1):  # no partner is that large
            return np.unique(np.concatenate(found))
        found.append(band_signatures(dealt, worth, number, top_next, percent))
        top = top_next


def sketch_of(values: np.ndarray) -> bytes:
    """Counts per cell. Neither kind's distance ever exceeds the number of elements in which two sets differ.

    The fine cells tell sets of some hundred elements apart, the others larger ones.
    """
    place = mix(values, 41)
    counts = np.bincount((place % np.uint64(CELLS)).astype(np.int64), minlength=CELLS).clip(0, 255).astype(np.uint8)
    fine = np.bincount((place >> np.uint64(40)).astype(np.int64) % FINE, minlength=FINE).astype(np.uint8).reshape(-1, 4) & 3
    return counts.tobytes() + (fine << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8).tobytes()


def cells_of(sketches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The counts of sketches, a row each."""
    raw = np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, CELLS + FINE // 4)
    fine = raw[:, CELLS:, None] >> np.array([0, 2, 4, 6], np.uint8) & 3
    return raw[:, :CELLS].astype(np.int16), fine.reshape(len(raw), FINE).astype(np.int8)


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of rows of fine counts, each round the circle of four."""
    d = np.abs(a - b)
    return np.minimum(d, 4 - d).sum(axis=-1, dtype=np.int32)


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, np.ndarray]]:
    forget()
    for doc_id, text in rows_of(batches, "doc_id", "text"):
        yield doc_id, shingle_set(hash_words(split_words(text)), size)


def _summaries(size: int):
    def run(batches):
        ids, sizes, digests, sketches = [], [], [], []
        for doc_id, values in _sets(batches, size):
            ids.append(doc_id)
            sizes.append(len(values))
            digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
            sketches.append(sketch_of(values))
            if len(ids) == 2000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, sizes, digests, sketches)], names=names)
                ids, sizes, digests, sketches = [], [], [], []
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, sizes, digests, sketches)], names=names)

    names = ["doc_id", "n_shingles", "digest", "sketch"]
    return run


def _signatures(size: int, percent: int):
    def run(batches):
        ids, found, n = [], [], 0
        for doc_id, values in _sets(batches, size):
            own = set_signatures(values, percent)
            ids.append(np.full(len(own), doc_id, np.int64))
            found.append(own)
            n += len(own)
            if n > 200_000:
                yield pa.RecordBatch.from_arrays([signed(np.concatenate(found)), np.concatenate(ids)], names=names)
                ids, found, n = [], [], 0
        if n:
            yield pa.RecordBatch.from_arrays([signed(np.concatenate(found)), np.concatenate(ids)], names=names)

    names = ["signature", "doc_id"]
    return run


def _whole_sets(size: int):
    def run(batches):
        ids, sets, n = [], [], 0
        for doc_id, values in _sets(batches, size):
            ids.append(doc_id)
            sets.append(values)
            n += len(values)
            if n > 200_000:
                yield flushed(ids, sets)
                ids, sets, n = [], [], 0
        if ids:
            yield flushed(ids, sets)

    def flushed(ids, sets):
        starts = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(starts, signed(np.concatenate(sets)))], names=["doc_id", "shingles"])

    return run


def _near_sketches(percent: int):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                (a, fine_a), (b, fine_b) = (cells_of(part.column(c).to_pylist()) for c in ("sketch_a", "sketch_b"))
                sizes = part.column("n_a").to_numpy() + part.column("n_b").to_numpy()
                most = sizes * (100 - percent) // (100 + percent)
                keep = (np.abs(a - b).sum(axis=1) <= most) & (apart(fine_a, fine_b) <= most)
                yield part.select(["a", "b"]).filter(pa.array(keep))

    return run


def _near(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sizes and sketches let them be linked."""
    side = lambda s: sketches.select(
        F.col("doc_id").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    near = (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
        .mapInArrow(_near_sketches(percent), "a long, b long")
    )
    return written(near, "near")


def _exact(near: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are linked; ``near`` is removed."""
    needed = near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct()
    whole = texts.join(needed, "doc_id", "left_semi").mapInArrow(_whole_sets(size), "doc_id long, shingles array<long>")
    whole = written(whole, "sets")
    full = lambda s: whole.select(F.col("doc_id").alias(s), F.col("shingles").alias(f"shingles_{s}"))
    # 100 * common >= percent * (both - common), on sets that are not empty; two whole sets a row would be large batches for Python
    exact = f"{100 + percent} * size(array_intersect(shingles_a, shingles_b)) >= {percent} * (size(shingles_a) + size(shingles_b))"
    found = written(near.join(full("a"), "a").join(full("b"), "b").where(exact).select("a", "b"), "linked")
    removed(near, whole)
    return found


def jaccard_components(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    ``docs`` has ``doc_id`` (unique, not NULL: rows with a NULL id are left
    out) and ``text``; other columns are not looked at. Shingles are ``size``
    words; two documents link when 100 * intersection >= ``percent`` * union.
    Documents without words have no shingles and link with nothing. A document
    without links is its own component. No link is lost, whatever the groups'
    sizes:

    1. documents with equal sets are one class, represented by the smallest id;
    2. in every bucket of equal signatures each set is compared with the
       bucket's first one, which links all of most groups of near copies;
    3. buckets that after this still hold sets of different components have
       all pairs across those components compared.

    A repeated ``doc_id`` counts as one document per row and gives a row each,
    all with one component.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id is not null")
    summaries = written(
        texts.mapInArrow(_summaries(size), "doc_id long, n_shingles long, digest binary, sketch binary"), "summaries",
    )
    filled = summaries.where("n_shingles > 0")
    classes = written(filled.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    member = written(filled.select("doc_id", "digest").join(classes, "digest").select("doc_id", "rep"), "members")
    sketches = summaries.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    sketches = written(sketches.dropDuplicates(["doc_id", "digest"]).select("doc_id", "n_shingles", "sketch"), "sketches")
    removed(classes)

    signatures = texts.mapInArrow(_signatures(size, percent), "signature long, doc_id long")
    first = F.first("doc_id").over(Window.partitionBy("signature").orderBy("doc_id"))
    buckets = written(signatures.withColumn("hub", first).where("doc_id <> hub"), "buckets")
    pairs = written(buckets.select("doc_id", "hub").distinct(), "pairs")

    reps = lambda frame, column, new: frame.join(
        member.select(F.col("doc_id").alias(column), F.col("rep").alias(new)).distinct(), column)
    stars = reps(reps(pairs, "doc_id", "a"), "hub", "b").where("a <> b")
    stars = written(stars.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
    near = _near(stars, sketches, percent)
    removed(stars)
    links = _exact(near, texts, size, percent)
    same = member.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    labels = components(links.union(same))

    near = _across(pairs, buckets, member, labels, sketches, percent)
    removed(pairs, buckets, sketches)
    more = _exact(near, texts, size, percent)
    if not more.isEmpty():
        removed(labels)
        labels = components(links.union(more).union(same))
    removed(links, more, member)
    return summaries.join(labels.distinct(), summaries["doc_id"] == labels["node"], "left").select(
        summaries["doc_id"], "n_shingles", F.coalesce("component", summaries["doc_id"]).alias("component_id"),
    )


def _near_in_blocks(percent: int):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                members = batch.column("members")[row].values
                first = np.flatnonzero(members.field("block").to_numpy() == batch.column("low")[row].as_py())
                second = np.flatnonzero(members.field("block").to_numpy() == batch.column("high")[row].as_py())
                ids, group, sizes = (members.field(c).to_numpy() for c in ("rep", "component", "n_shingles"))
                cells, fine = cells_of(members.field("sketch").to_pylist())
                a, b = [], []
                for x in first:
                    y = second[(group[second] != group[x]) & (100 * np.minimum(sizes[second], sizes[x])
                                                              >= percent * np.maximum(sizes[second], sizes[x]))]
                    most = (sizes[y] + sizes[x]) * (100 - percent) // (100 + percent)
                    near = np.abs(cells[y] - cells[x]).sum(axis=1) <= most
                    y, most = y[near], most[near]
                    y = y[apart(fine[y], fine[x]) <= most]
                    a.append(np.maximum(ids[y], ids[x]))
                    b.append(np.minimum(ids[y], ids[x]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return run


def _across(
    pairs: DataFrame, buckets: DataFrame, member: DataFrame, labels: DataFrame, sketches: DataFrame, percent: int,
) -> DataFrame:
    """Pairs of representatives of different components that share a bucket and whose sketches let them be linked.

    Buckets with the same members count once. A bucket is compared in blocks of
    at most ``BLOCK`` members, pair of blocks by pair of blocks; only the pairs
    that may be linked leave a task.
    """
    named = written(
        member.join(labels.select(F.col("node").alias("doc_id"), "component"), "doc_id").distinct(), "named",
    )
    at = lambda c, new: named.select(F.col("doc_id").alias(c), F.col("component").alias(new))
    open_pairs = written(
        pairs.join(at("doc_id", "c_doc"), "doc_id").join(at("hub", "c_hub"), "hub").where("c_doc <> c_hub")
        .select("doc_id", "hub"), "open")
    open_buckets = written(buckets.join(open_pairs, ["doc_id", "hub"], "left_semi").select("signature").distinct(), "open")
    inside = buckets.join(open_buckets, "signature", "left_semi")
    inside = inside.select("signature", "doc_id").union(inside.select("signature", F.col("hub")).distinct())
    inside = written(inside.join(named, "doc_id").select("signature", "rep", "component").distinct(), "inside")
    removed(open_pairs, open_buckets, named)
    content = inside.groupBy("signature").agg(
        F.bit_xor(F.xxhash64("rep")).alias("content"), F.count("*").alias("n"))
    once = content.groupBy("content", "n").agg(F.min("signature").alias("signature"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    once = written(once.select("signature", blocks.alias("blocks")), "once")
    own = sketches.select(F.col("doc_id").alias("rep"), "n_shingles", "sketch")
    dealt = inside.join(once, "signature").withColumn("block", F.pmod(F.xxhash64("rep", F.lit(3)), F.col("blocks")).cast("int"))
    dealt = written(dealt.select("signature", "rep", "component", "blocks", "block").join(own, "rep"), "dealt")
    removed(inside, once)
    alone = dealt.where("blocks = 1").select("*", F.lit(0).alias("low"), F.lit(0).alias("high"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    split = dealt.where("blocks > 1").select("*", other).select(
        *dealt.columns, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    grouped = alone.union(split).groupBy("signature", "low", "high").agg(
        F.collect_list(F.struct("rep", "component", "n_shingles", "sketch", "block")).alias("members"))
    near = written(grouped.mapInArrow(lambda batches: gathered(_near_in_blocks(percent)(batches)), "a long, b long").distinct(), "across")
    removed(dealt)
    return near
