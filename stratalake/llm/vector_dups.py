"""Near-duplicate vectors by cosine, with product quantisation.

Equal vectors are one class. Classes are dealt into coarse inverted lists by the
nearest centroid; what is left of a vector after its centroid is coded per
subspace. A vector probes every list that its distance to the plane between that
list's centroid and its own lets hold a partner. There, distances to the members'
codes are added up from tables; members whose coded distance, less their own coding
error, is within the limit are compared exactly in double precision. Both steps are
bounds, so no pair is lost: the vectors of a pair are on different sides of the plane
between their lists' centroids, so one of them is at most half the limit from it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.components import components
from stratalake.llm.tables import written
from stratalake.llm.words import rows_of

#: Vectors that centroids are fitted to, at most about so many (chosen by hash); all vectors are indexed.
FITTED = 16_000
#: Aim for so many vectors a list, and at most so many lists.
PER_LIST, MOST_LISTS = 400, 1024
SUBSPACES, CODES = 16, 64
#: Members and probes of a list that meet in one group.
MEMBERS, PROBES = 1024, 2048


def _unit(values: list | None) -> np.ndarray | None:
    if values is None or not len(values) or any(v is None for v in values):
        return None
    v = np.array(values, np.float64)
    if not np.isfinite(v).all():
        return None
    top = np.abs(v).max()
    if not top > 0:
        return None
    v = v / top  # so that squares neither vanish nor overflow
    return v / np.sqrt((v * v).sum())


def _kmeans(x: np.ndarray, k: int, seed: int, steps: int = 12) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(steps):
        near = _nearest(x, centres)[0]
        counts = np.bincount(near, minlength=len(centres))
        sums = np.stack([np.bincount(near, column, len(centres)) for column in x.T], axis=1)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre and all distances."""
    square = (x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)[None, :] - 2 * x @ centres.T
    distance = np.sqrt(np.maximum(square, 0))
    return distance.argmin(axis=1), distance


def probes(distance: np.ndarray, near: np.ndarray, apart: np.ndarray, limit: float) -> np.ndarray:
    """Whether each vector probes each list: it is at most ``limit / 2`` from the plane between the list's centroid and
    its nearest one. ``distance`` is to all centroids, ``apart`` between them. Of two vectors of different lists at most
    ``limit`` apart, one probes the other's list."""
    square = distance ** 2
    return square - square[np.arange(len(near)), near][:, None] <= limit * apart[near] + 1e-9


@dataclass(frozen=True)
class Quantiser:
    centroids: np.ndarray
    codebooks: list[np.ndarray]  # per subspace: codes x width
    cuts: list[slice]

    def encode(self, residual: np.ndarray) -> np.ndarray:
        return np.stack([_nearest(residual[:, c], book)[0] for c, book in zip(self.cuts, self.codebooks, strict=True)],
                        axis=1).astype(np.uint8)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([book[codes[:, j]] for j, book in enumerate(self.codebooks)], axis=1)

    def distances(self, queries: np.ndarray, number: int, codes: np.ndarray) -> np.ndarray:
        """Distances from queries to the coded members of one list, from a table per query and subspace."""
        residual = queries - self.centroids[number]
        out = np.zeros((len(codes), len(queries)))
        for j, (c, book) in enumerate(zip(self.cuts, self.codebooks, strict=True)):
            out += np.ascontiguousarray(_nearest(residual[:, c], book)[1].T ** 2)[codes[:, j]]
        return np.sqrt(out).T


def fit_quantiser(x: np.ndarray, lists: int) -> Quantiser:
    width = x.shape[1]
    centroids = _kmeans(x, lists, 1)
    residual = x - centroids[_nearest(x, centroids)[0]]
    edges = np.linspace(0, width, min(SUBSPACES, width) + 1).astype(int)
    cuts = [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]
    return Quantiser(centroids, [_kmeans(residual[:, c], CODES, 2 + j) for j, c in enumerate(cuts)], cuts)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            units = [_unit(v) for v, in rows_of([part], "embedding")]
            raw = [None if u is None else u.tobytes() for u in units]
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array([0 if u is None else len(u) for u in units], pa.int32()),
                 pa.array([None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw], pa.binary()),
                 pa.array(raw, pa.binary())],
                names=["vec_id", "width", "digest", "unit"])


def _links(classes: DataFrame, width: int, cosine: float) -> tuple[DataFrame, DataFrame]:
    """Edges ``a, b`` that connect linked classes, and ``rep, n`` links to members of other classes."""
    own = classes.where(F.col("width") == width)
    count = own.count()
    fitted = own.where(F.pmod(F.xxhash64("rep"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, FITTED / count)) + 1)
    sample = np.stack([np.frombuffer(r["unit"], np.float64) for r in fitted.select("unit").orderBy("rep").limit(2 * FITTED).collect()] or
                      [np.eye(1, width)[0]])
    q = fit_quantiser(sample, max(1, min(MOST_LISTS, count // PER_LIST, len(sample))))
    limit = np.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9
    apart = _nearest(q.centroids, q.centroids)[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                x = np.frombuffer(b"".join(part.column("unit").to_pylist()), np.float64).reshape(-1, width)
                near, distance = _nearest(x, q.centroids)
                codes = q.encode(x - q.centroids[near])
                error = np.linalg.norm(x - q.centroids[near] - q.decode(codes), axis=1)
                asked = [np.flatnonzero(row).astype(np.int32) for row in probes(distance, near, apart, limit)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("rep"), part.column("n"), part.column("unit"), pa.array(near.astype(np.int32)),
                     pa.array(error), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(asked, pa.list_(pa.int32()))],
                    names=["rep", "n", "unit", "list", "error", "codes", "probes"])

    placed = written(own.select("rep", "n", "unit").mapInArrow(
        assign, "rep long, n long, unit binary, list int, error double, codes binary, probes array<int>"), "placed")
    probing = placed.withColumn("probed", F.explode("probes"))
    parts = placed.groupBy(F.col("list").alias("probed")).agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("member_parts")).join(
        probing.groupBy("probed").agg(F.ceil(F.count("*") / PROBES).cast("int").alias("probe_parts")), "probed")
    parts = F.broadcast(written(parts, "parts"))  # at most MOST_LISTS rows

    part_of = lambda n: F.pmod(F.xxhash64("rep", F.lit(5)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asking = ["rep", "n", "unit", "list"]
    members = placed.withColumn("probed", F.col("list")).join(parts, "probed").withColumn(
        "member_part", part_of("member_parts")).withColumn("probe_part", every("probe_parts"))
    probers = probing.join(parts, "probed").withColumn(
        "probe_part", part_of("probe_parts")).withColumn("member_part", every("member_parts"))
    group = ["probed", "member_part", "probe_part"]

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")
        right = right.rename(columns=lambda c: c.removeprefix("by_"))
        number = int(left["probed"].iloc[0])
        y, x = (np.frombuffer(b"".join(f["unit"]), np.float64).reshape(-1, width) for f in (left, right))
        codes = np.frombuffer(b"".join(left["codes"]), np.uint8).reshape(len(left), -1)
        y_id, x_id, y_n, x_n = left["rep"].to_numpy(), right["rep"].to_numpy(), left["n"].to_numpy(), right["n"].to_numpy()
        count: dict[int, int] = {}
        edges = []
        # whether a member probes the prober's list as well: then the pair counts once, for the smaller prober
        asks = np.zeros((len(y), len(q.centroids)), bool)
        asks[np.repeat(np.arange(len(y)), left["probes"].str.len()), np.concatenate(left["probes"].to_numpy())] = True
        for at in range(0, len(x), 256):
            rows = slice(at, at + 256)
            near = q.distances(x[rows], number, codes) <= limit + left["error"].to_numpy()[None, :] + 1e-9
            i, j = np.nonzero(near)
            i += at
            both = asks[j, right["list"].to_numpy()[i]]
            use = (x_id[i] != y_id[j]) & (~both | (x_id[i] < y_id[j]))
            i, j = i[use], j[use]
            use = np.concatenate([(x[i[k:k + 20_000]] * y[j[k:k + 20_000]]).sum(axis=1) for k in range(0, len(i), 20_000)]
                                 or [np.zeros(0)]) >= cosine
            i, j = i[use], j[use]
            if not len(i):
                continue
            for ids, other, weights in ((x_id[i], y_n[j], None), (y_id[j], x_n[i], None)):
                keys, place = np.unique(ids, return_inverse=True)
                for key, n in zip(keys.tolist(), np.bincount(place, other).astype(np.int64).tolist(), strict=True):
                    count[key] = count.get(key, 0) + n
            edges.append(_forest(x_id[i], y_id[j]))
        a, b = (np.concatenate(e) for e in zip(*edges, strict=True)) if edges else (np.zeros(0, np.int64),) * 2
        return pd.DataFrame({"a": np.concatenate([a, np.fromiter(count.keys(), np.int64, len(count))]),
                             "b": np.concatenate([b, np.full(len(count), -1)]),
                             "n": np.concatenate([np.full(len(a), -1), np.fromiter(count.values(), np.int64, len(count))])}).astype("int64")

    found = written(
        members.select(*group, *asking, "error", "codes", "probes").groupBy(*group).cogroup(
            probers.select(*[F.col(c).alias(f"by_{c}") for c in (*group, *asking)]).groupBy(*[f"by_{c}" for c in group]))
        .applyInPandas(compare, "a long, b long, n long"), "found")
    return found.where("n < 0").select("a", "b"), found.where("n >= 0").select(F.col("a").alias("rep"), "n")


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Few links that connect what the links a-b connect: each node with the smallest node it reaches."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = place[:len(a)], place[len(a):]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def near_duplicate_vectors(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors (vec_id, embedding)``.

    Vectors link when their cosine in double precision is at least ``cosine``.
    Those that are NULL, empty, zero or hold NULL or non-finite components link with
    nothing, nor do vectors of different lengths. Equal vectors link with each
    other; each row counts, repeated vec_ids included. Rows with a NULL vec_id have no links,
    a NULL component and are not kept. Other columns are not looked at.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    units = written(rows.mapInArrow(_units, "vec_id long, width int, digest binary, unit binary"), "units")
    usable = units.where("digest is not null and vec_id is not null")
    classes = written(usable.groupBy("digest").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("width").alias("width"), F.first("unit").alias("unit")), "classes")
    edges = usable.sparkSession.createDataFrame([], "a long, b long")
    counts = usable.sparkSession.createDataFrame([], "rep long, n long")
    for width in sorted(r["width"] for r in classes.select("width").distinct().collect()):
        more, n = _links(classes, width, cosine)
        edges, counts = edges.union(more), counts.union(n)
    labels = components(edges)
    linked = counts.groupBy("rep").agg(F.sum("n").alias("others"))
    known = classes.select("digest", "rep", "n").join(linked, "rep", "left").join(
        labels.select(F.col("node").alias("rep"), "component"), "rep", "left")
    known = written(known.select(
        "digest", F.expr("n - 1 + coalesce(others, 0)").alias("n_links"), F.coalesce("component", "rep").alias("component")), "known")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    linkless = units.where("digest is null or vec_id is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component"))
    return usable.select("vec_id", "digest").join(known, "digest").select("vec_id", "n_links", "component").union(linkless).select(
        "vec_id", "n_links", component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
