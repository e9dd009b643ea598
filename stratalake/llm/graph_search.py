"""Nearest neighbours by hierarchical navigable small-world graphs, one per shard.

Equal vectors are one class. Classes are dealt into shards by hash. A shard's graph has
layers: every vector is in the lowest, a share of 1/LINKS of each layer's in the next.
Layers are stored as flat arrays of neighbours, a row per vector, and the index is a table
with a row per vector. Vectors are added in batches that grow with the graph: each one
looks for its neighbours in the graph so far and in its own batch, keeps those that no kept
one is nearer to, and is linked both ways. A search goes down greedily from the top and
keeps the best ``beam`` vectors in the lowest layer. It is done for many queries in lock
step, so that numpy works on all their neighbours at once. The shards' best classes are
measured again in double precision and merged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.tables import written
from stratalake.llm.words import rows_of

#: Vectors a shard has, about; queries that meet a shard in one task, at most about.
PER_SHARD, ASKING = 16_384, 8_192
#: Neighbours kept in the upper layers; the lowest has twice as many.
LINKS = 16
#: Vectors kept while building and while searching.
BUILD_BEAM, BEAM = 64, 256
#: Vectors added or asked at a time.
BATCH = 512
#: Vectors of each row's beam that are followed at once.
FOLLOWED = 4


# -- the graph ----------------------------------------------------------------

def _distances(x: np.ndarray, rows: np.ndarray, q: np.ndarray, asking: np.ndarray) -> np.ndarray:
    """Squared distances of pairs, some at a time."""
    out = np.empty(len(rows), x.dtype)
    with np.errstate(over="ignore"):
        for at in range(0, len(rows), 1 << 11):
            part = slice(at, at + (1 << 11))
            d = x[rows[part]] - q[asking[part]]
            out[part] = np.einsum("ij,ij->i", d, d)
    return out


def _beam_search(x: np.ndarray, links: np.ndarray, q: np.ndarray, starts: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Per query the ``beam`` best vectors found from its start in one layer, nearest first, and squared distances.

    A query is done when it has followed all vectors of its beam. Places not filled are -1, at infinity.
    """
    n, many = len(x), len(q)
    ids, dist = np.full((many, beam), -1), np.full((many, beam), np.inf, x.dtype)
    followed = np.ones((many, beam), bool)
    ids[:, 0], dist[:, 0], followed[:, 0] = starts, _distances(x, starts, q, np.arange(many)), False
    seen = np.zeros(many * n, bool)
    seen[np.arange(many) * n + starts] = True
    active = np.arange(many)
    width = min(FOLLOWED, beam)
    while len(active):
        open_ = np.where(followed[active], np.inf, np.arange(beam))  # beams are sorted: the first open ones are the nearest
        picks = np.argpartition(open_, width - 1, axis=1)[:, :width]
        use = np.isfinite(np.take_along_axis(open_, picks, 1))
        rows = np.repeat(active, width).reshape(-1, width)[use]
        picks = picks[use]
        followed[rows, picks] = True
        near = links[ids[rows, picks]]
        pairs = (rows[:, None] * n + near)[near >= 0]
        pairs = np.sort(pairs[~seen[pairs]])
        pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])] if len(pairs) else pairs
        seen[pairs] = True
        asking, found = pairs // n, pairs % n
        measured = _distances(x, found, q, asking)
        better = measured < dist[asking, beam - 1]
        asking, found, measured = asking[better], found[better], measured[better]
        if len(asking):
            changed, first, counts = np.unique(asking, return_index=True, return_counts=True)
            row, column = np.repeat(np.arange(len(changed)), counts), np.arange(len(asking)) - np.repeat(first, counts)
            more_ids, more = np.full((len(changed), counts.max()), -1), np.full((len(changed), counts.max()), np.inf, x.dtype)
            more_ids[row, column], more[row, column] = found, measured
            all_dist = np.concatenate([dist[changed], more], axis=1)
            best = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
            dist[changed] = np.take_along_axis(all_dist, best, 1)
            ids[changed] = np.take_along_axis(np.concatenate([ids[changed], more_ids], axis=1), best, 1)
            followed[changed] = np.take_along_axis(np.concatenate([followed[changed], more_ids < 0], axis=1), best, 1)
        active = active[~followed[active].all(axis=1)]
    return ids, dist


def _diverse(x: np.ndarray, ids: np.ndarray, dist: np.ndarray, most: int) -> np.ndarray:
    """Of candidates sorted by distance, those that no kept one is nearer to than the vector itself; then the nearest others."""
    rows, width = ids.shape
    kept = np.full((rows, most), -1)
    for at in range(0, rows, 32):
        part = slice(at, at + 32)
        own, away = ids[part], dist[part]
        v = x[np.maximum(own, 0)]
        square = np.einsum("ijk,ijk->ij", v, v)
        between = square[:, :, None] + square[:, None, :] - 2 * (v @ v.transpose(0, 2, 1))
        chosen = np.zeros(own.shape, bool)
        nearest_kept = np.full(own.shape, np.inf)
        for k in range(width):
            take = (own[:, k] >= 0) & (chosen.sum(axis=1) < most) & (nearest_kept[:, k] > away[:, k])
            chosen[:, k] = take
            nearest_kept = np.where(take[:, None], np.minimum(nearest_kept, between[:, :, k]), nearest_kept)
        rank = np.where(own < 0, 3 * width, np.where(chosen, 0, width) + np.arange(width))
        order = np.argsort(rank, axis=1)[:, :most]
        kept[part, :order.shape[1]] = np.take_along_axis(own, order, 1)
    return kept


@dataclass
class Graph:
    """Vectors, the top layer each is in, and per layer a flat array of neighbours (-1: none).

    Links are followed by distances in single precision, where the vectors' size permits.
    """

    x: np.ndarray
    tops: np.ndarray
    layers: list[np.ndarray]

    @classmethod
    def of(cls, x: np.ndarray, chance: np.ndarray) -> Graph:
        """Built over vectors; ``chance`` in (0, 1] says how high up each goes. The first one is in all layers."""
        tops = np.floor(-np.log(chance) / np.log(LINKS)).astype(int)
        if len(x):
            tops[0] = tops.max()
        layers = [np.full((len(x), LINKS if layer else 2 * LINKS), -1, np.int32) for layer in range(int(tops.max(initial=0)) + 1)]
        graph = cls(_rounded(x, x), tops, layers)
        done = 1
        while done < len(x):
            stop = min(len(x), done + min(BATCH, done))
            graph._add(np.arange(done, stop))
            done = stop
        return graph

    def _add(self, new: np.ndarray) -> None:
        q, starts = self.x[new], np.zeros(len(new), int)
        square = np.einsum("ij,ij->i", q, q)
        between = np.maximum(square[:, None] + square[None, :] - 2 * q @ q.T, 0)
        np.fill_diagonal(between, np.inf)
        for layer in range(len(self.layers) - 1, -1, -1):
            belongs = np.flatnonzero(self.tops[new] >= layer)
            above = np.flatnonzero(self.tops[new] < layer)
            links = self.layers[layer]
            if len(above):
                starts[above] = _beam_search(self.x, links, q[above], starts[above], 1)[0][:, 0]
            if not len(belongs):
                continue
            ids, dist = _beam_search(self.x, links, q[belongs], starts[belongs], BUILD_BEAM)
            starts[belongs] = ids[:, 0]
            # the nearest of the same batch, which the graph does not hold yet
            same = between[np.ix_(belongs, belongs)]
            few = min(LINKS, len(belongs))
            near = np.argpartition(same, few - 1, axis=1)[:, :few]
            own = np.take_along_axis(same, near, 1)
            ids = np.concatenate([ids, np.where(np.isfinite(own), new[belongs][near], -1)], axis=1)
            dist = np.concatenate([dist, own], axis=1)
            order = np.argsort(dist, axis=1, kind="stable")
            chosen = _diverse(self.x, np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1), LINKS)
            links[new[belongs], :chosen.shape[1]] = chosen
            self._link_back(layer, np.repeat(new[belongs], chosen.shape[1])[chosen.ravel() >= 0], chosen[chosen >= 0])

    def _link_back(self, layer: int, sources: np.ndarray, targets: np.ndarray) -> None:
        links = self.layers[layer]
        known = (links[targets] == sources[:, None]).any(axis=1)
        sources, targets = sources[~known], targets[~known]
        order = np.argsort(targets, kind="stable")
        sources, targets = sources[order], targets[order]
        changed, first, counts = np.unique(targets, return_index=True, return_counts=True)
        if not len(changed):
            return
        more = np.full((len(changed), counts.max()), -1, np.int32)
        row = np.repeat(np.arange(len(changed)), counts)
        more[row, np.arange(len(targets)) - np.repeat(first, counts)] = sources
        every = np.concatenate([links[changed], more], axis=1)
        most = links.shape[1]
        full = (every >= 0).sum(axis=1) > most
        links[changed[~full]] = np.take_along_axis(every, np.argsort(every < 0, axis=1, kind="stable"), 1)[~full, :most]
        every, changed = every[full], changed[full]
        if len(changed):
            dist = _distances(self.x, np.maximum(every, 0).ravel(), self.x, np.repeat(changed, every.shape[1])).reshape(every.shape)
            dist[every < 0] = np.inf
            order = np.argsort(dist, axis=1, kind="stable")[:, :most + LINKS]
            links[changed] = _diverse(self.x, np.take_along_axis(every, order, 1), np.take_along_axis(dist, order, 1), most)

    def search(self, q: np.ndarray, beam: int) -> Iterator[tuple[slice, np.ndarray]]:
        """Parts of the queries, and the numbers of the up to ``beam`` vectors found for each (-1: none)."""
        x = _rounded(self.x, self.x)
        for at in range(0, len(q), BATCH):
            part = slice(at, at + BATCH)
            asking, starts = _rounded(q[part], x), np.zeros(len(q[part]), int)
            for links in self.layers[:0:-1]:
                starts = _beam_search(x, links, asking, starts, 1)[0][:, 0]
            yield part, _beam_search(x, self.layers[0], asking, starts, beam)[0]


def _rounded(v: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Vectors in the precision that suits ``x``, cut off where squares would overflow."""
    single = x.dtype == np.float32 or 1e-12 < np.abs(x).max(initial=0) < 1e12
    return np.clip(v, -1e15, 1e15).astype(np.float32) if single else np.clip(v, -1e150, 1e150)


def euclidean(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances between rows in double precision, also where squares overflow or vanish."""
    d = x - y
    with np.errstate(over="ignore"):
        plain = np.sqrt((d * d).sum(axis=1))
    top = np.abs(d).max(axis=1, initial=0)
    odd = (top > 1e150) | ((top > 0) & (top < 1e-150))
    if odd.any():
        plain[odd] = top[odd] * np.sqrt(((d[odd] / top[odd, None]) ** 2).sum(axis=1))
    return plain


# -- Spark --------------------------------------------------------------------

def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            raw = []
            for values, in rows_of([part], "embedding"):
                v = None if values is None or not values or None in values else np.array(values, np.float64) + 0.0
                raw.append(v.tobytes() if v is not None and np.isfinite(v).all() and v.any() else None)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array([None if r is None else len(r) // 8 for r in raw], pa.int32()),
                 pa.array([None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw], pa.binary()),
                 pa.array(raw, pa.binary())],
                names=["vec_id", "width", "digest", "vector"])


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.float64).reshape(-1, width)


_INDEX = "width int, shard int, number int, digest binary, vector binary, top int, links binary"


def build_index(classes: DataFrame) -> DataFrame:
    """The graphs of ``classes (width, shard, digest, vector)``: a row per vector with its number in the shard and its
    neighbours' numbers, one list of fixed length per layer, one after the other."""
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("digest", ignore_index=True)  # an order by hash, whatever the shuffle did
        x = _matrix(rows["vector"], int(rows["width"].iloc[0]))
        chance = (np.array([int.from_bytes(d[:6], "big") for d in rows["digest"].map(lambda d: d[::-1])]) + 1) / 2.0 ** 48
        graph = Graph.of(x, chance)
        tops = graph.tops.tolist()
        return pd.DataFrame({
            "width": rows["width"], "shard": rows["shard"], "number": np.arange(len(rows), dtype=np.int32),
            "digest": rows["digest"], "vector": rows["vector"], "top": np.array(tops, np.int32),
            "links": [b"".join(graph.layers[k][i].tobytes() for k in range(top + 1)) for i, top in enumerate(tops)]})

    return classes.select("width", "shard", "digest", "vector").groupBy("width", "shard").applyInPandas(build, _INDEX)


def _graph(rows: pd.DataFrame) -> Graph:
    rows = rows.sort_values("number", ignore_index=True)
    tops = rows["top"].to_numpy()
    layers = [np.full((len(rows), LINKS if k else 2 * LINKS), -1, np.int32) for k in range(int(tops.max()) + 1)]
    for i, (top, links) in enumerate(zip(tops.tolist(), rows["links"], strict=True)):
        flat = np.frombuffer(links, np.int32)
        layers[0][i] = flat[:2 * LINKS]
        for k in range(1, top + 1):
            layers[k][i] = flat[(k + 1) * LINKS:(k + 2) * LINKS]
    return Graph(_matrix(rows["vector"], int(rows["width"].iloc[0])), tops, layers)


def _groups_of(df: DataFrame, size: int) -> int:
    return max(1, -(-df.count() // size))


def search_index(index: DataFrame, queries: DataFrame, shards: int, k: int, beam: int = BEAM) -> DataFrame:
    """``asked, digest, score``: of each shard the ``k`` best classes found for each of ``queries (asked, width, vector)``.

    Every query visits every shard, once; a shard is read again for each ``ASKING`` queries or so.
    """
    parts = _groups_of(queries, ASKING)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asking = queries.select(
        "width", every(shards).alias("shard"), F.pmod(F.xxhash64("asked", F.lit(3)), F.lit(parts)).cast("int").alias("part"),
        "asked", F.col("vector").alias("sought"))
    asked = index.withColumn("part", every(parts))
    group = ["width", "shard", "part"]

    def search(nodes: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(nodes) or not len(rows):
            return pd.DataFrame({"asked": [], "digest": [], "score": []})
        graph = _graph(nodes)
        digests = nodes.sort_values("number")["digest"].to_numpy()
        q, names, out = _matrix(rows["sought"], graph.x.shape[1]), rows["asked"].to_numpy(), []
        for part, ids in graph.search(q, max(beam, k)):
            row, column = np.nonzero(ids >= 0)
            found = ids[row, column]
            score = euclidean(graph.x[found], q[part][row])
            order = np.lexsort((found, score, row))  # numbers follow the digests
            row, found, score = row[order], found[order], score[order]
            best = np.arange(len(row)) - np.searchsorted(row, row) < k
            out.append(pd.DataFrame({"asked": names[part][row[best]], "digest": digests[found[best]], "score": score[best]}))
        return pd.concat(out, ignore_index=True)

    return asked.select(*group, "number", "digest", "vector", "top", "links").groupBy(*group).cogroup(
        asking.groupBy(*group)).applyInPandas(search, "asked binary, digest binary, score double")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, beam: int = BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries (query_id, embedding)`` the ``k`` nearest rows found of
    ``vectors (vec_id, embedding)`` but those whose vec_id is the query's.

    Score is the Euclidean distance in double precision; ranks count from 1, nearest first, ties
    go to the smaller vec_id. Vectors that are NULL, empty, zero or hold NULL or non-finite
    components take no part, nor do rows with a NULL id; vectors of different lengths never
    meet. Equal vectors are found or missed together, in the order of their vec_ids.
    Rows of ``vectors`` that share a vec_id count each; rows of ``queries`` that share an id and a vector are
    one query, and with several vectors their results are ranked together. Empty tables give no rows. Other columns are not looked
    at. The index covers every row; what may be missed is what the graphs don't reach (see README for recall).
    """
    def usable(df: DataFrame, id_column: str) -> DataFrame:
        rows = df.select(F.col(id_column).cast("long").alias("vec_id"), F.col("embedding").cast("array<double>"))
        return rows.mapInArrow(_vectors, "vec_id long, width int, digest binary, vector binary").where(
            "vec_id is not null and digest is not null")

    rows = written(usable(vectors, "vec_id"), "vectors")
    asked = written(usable(queries, "query_id").select(F.col("vec_id").alias("query_id"), "width", "digest", "vector").distinct(), "queries")
    classes = rows.groupBy("width", "digest").agg(F.first("vector").alias("vector"))
    shards = _groups_of(rows, PER_SHARD)
    dealt = classes.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int"))
    index = written(build_index(dealt), "graphs")
    sought = written(
        asked.groupBy(F.col("digest").alias("asked")).agg(F.first("width").alias("width"), F.first("vector").alias("vector")), "sought")
    # one class more than asked for: the query's own class may hold nothing but the query
    found = search_index(index, sought, shards, k + 1, beam)
    best = Window.partitionBy("asked").orderBy("score", "digest")
    found = written(found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1).drop("place"), "found")
    # of a class, only the smallest ids can be among the nearest: k and those that are the query's own
    members = Window.partitionBy("digest", "vec_id").orderBy("vec_id")
    smallest = Window.partitionBy("digest").orderBy("vec_id")
    own = rows.select("digest", "vec_id").join(found.select("digest").distinct(), "digest")
    own = own.withColumn("copy", F.row_number().over(members)).where(F.col("copy") <= k).withColumn(
        "id_rank", F.dense_rank().over(smallest)).where(F.col("id_rank") <= k + 1)
    hits = asked.select("query_id", F.col("digest").alias("asked")).join(found, "asked").join(written(own, "members"), "digest").where(
        "vec_id <> query_id")
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return hits.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
