"""Quality classifier: ordinal regression with cumulative links on graded ratings.

A document's grade is 0 (toxic), 1 (poor) or 2 (good). One weight vector over
hashed text features gives a score s; ordered thresholds t1 < t2 give
P(grade >= j) = sigmoid(s - t_j). The expected grade is the sum of both
probabilities; P(grade >= 2) is the tail probability by which documents are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.tables import written
from stratalake.llm.words import REMEMBERED, forget, gathered, rows_of

#: Labelled documents that a model is fitted to, at most about so many (chosen by a hash of their id).
LABELLED = 20_000
#: Buckets of the hashed features, and how many of them get a weight.
BUCKETS, WEIGHTS = 1 << 20, 8_192
#: Every fifth labelled document is held out to measure accuracy.
HELD_OUT = 5
#: Documents are kept from this tail probability on.
KEEP_FROM = 0.5


def bucket(feature: str) -> int:
    return xxhash.xxh64_intdigest(feature.encode("utf-8", "surrogatepass")) % BUCKETS


class WordFeatures(dict):
    """Buckets of a word as written: its letters in lower case, and the signs at its end."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        core = word.casefold().strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
        signs = word[len(word.rstrip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")):]
        found = [bucket(f"word {core}")] if core else []
        if len(signs) > 1 or not core:
            found.append(bucket(f"signs {signs[:4]}"))
        self[word] = tuple(found)
        return self[word]


def _level(share: float) -> int:
    """A share from 0 to 1 in coarse steps."""
    return int(np.ceil(10 * share)) if share > 0.02 else 0


def features_of(text: str | None, memory: WordFeatures) -> set[int]:
    """Buckets present in a text; none without words."""
    words = text.split() if text else []
    if not words:
        return set()
    kinds = set(words)
    found = set()
    for word in kinds:
        found.update(memory[word])
    rate = {
        "repeated": sum(map(eq, words, words[1:])) / len(words),
        "distinct": len(kinds) / len(words),
        "capitals": sum(w.isupper() and len(w) > 1 for w in kinds) / len(kinds),
        "signed": sum(not w[-1].isalnum() for w in kinds) / len(kinds),
        "numbers": sum(w.isdigit() for w in kinds) / len(kinds),
    }
    found.update(bucket(f"{name} {_level(share)}") for name, share in rate.items())
    found.add(bucket(f"length {len(words).bit_length()}"))
    return found


@dataclass(frozen=True)
class QualityModel:
    """Weights of the buckets that have one, two thresholds, and the accuracy on held-out labels."""

    buckets: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    report: dict[str, float] = field(default_factory=dict)

    def tails(self, score: np.ndarray) -> np.ndarray:
        return _sigmoid(score[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _fit(rows: list[np.ndarray], grades: np.ndarray, width: int, steps: int = 400, decay: float = 2e-4):
    """Weights and thresholds by gradient descent with adaptive steps on the mean log-likelihood."""
    flat = np.concatenate([*rows, np.zeros(0, np.int64)])
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, t, gap = np.zeros(width), -1.0, 0.5
    moments = [np.zeros(width + 2), np.zeros(width + 2)]
    for step in range(1, steps + 1):
        score = np.bincount(owner, w[flat], len(rows))
        low, high = _sigmoid(score - t), _sigmoid(score - t - np.exp(gap))
        chance = np.select([grades == 0, grades == 1], [1 - low, low - high], high).clip(1e-9)
        # derivatives of log chance by the two thresholds
        d_low = np.select([grades == 0, grades == 1], [low * (1 - low), -low * (1 - low)], 0.0) / chance
        d_high = np.select([grades == 0, grades == 1], [0.0, high * (1 - high)], -high * (1 - high)) / chance
        by_score = -(d_low + d_high)
        up = np.concatenate([
            np.bincount(flat, by_score[owner], width) / len(rows) - decay * w,
            [(d_low + d_high).mean(), d_high.mean() * np.exp(gap)],
        ])
        moments[0] = 0.9 * moments[0] + 0.1 * up
        moments[1] = 0.99 * moments[1] + 0.01 * up**2
        move = 0.05 * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        w, t, gap = w + move[:-2], t + move[-2], gap + move[-1]
    return w, np.array([t, t + np.exp(gap)])


def grades_of(labels: DataFrame) -> DataFrame:
    """``doc_id, grade`` of the labelled documents; of several labels the worst counts, rows without any label do not."""
    grade = F.when(F.col("toxic") > 0, 0).when(F.col("quality") > 0, 2).when(F.col("quality") <= 0, 1)
    known = labels.select(F.col("doc_id").cast("long"), grade.alias("grade")).where("doc_id is not null and grade is not null")
    return known.groupBy("doc_id").agg(F.min("grade").alias("grade"))


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> QualityModel | None:
    """A model fitted to about ``labelled`` rated documents at most; None if there are none, or no documents.

    Rows with a NULL doc_id, in either table, and labels without a document take no part; a NULL or
    empty text is a document without features. Rows of ``docs`` that share a doc_id count as one, the one with the least
    features in order. Other columns are not looked at. Only bounded things reach the driver: the chosen features, and which of them
    each of those documents has.
    """
    grades = grades_of(labels)
    share = min(1.0, labelled / max(1, grades.count()))
    chosen = grades.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    rated = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        memory = WordFeatures()
        for doc_id, text, grade in rows_of(batches, "doc_id", "text", "grade"):
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc_id], pa.int64()), pa.array([grade], pa.int32()),
                 pa.array([sorted(features_of(text, memory))], pa.list_(pa.int32()))],
                names=["doc_id", "grade", "features"],
            )

    rows = rated.mapInArrow(lambda batches: gathered(extract(batches)), "doc_id long, grade int, features array<int>").groupBy("doc_id").agg(
        F.min("grade").alias("grade"), F.min("features").alias("features"))
    rows = written(rows, "rated").withColumn(
        "held_out", F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(HELD_OUT)) == 0)
    seen = rows.where("not held_out")
    totals = {r["grade"]: r["n"] for r in seen.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    n = sum(totals.values())
    if not n:
        return None
    counts = seen.select("grade", F.explode("features").alias("bucket")).groupBy("bucket").agg(
        F.count("*").alias("all"), *[F.count(F.when(F.col("grade") == g, 1)).alias(f"g{g}") for g in range(3)])
    p = F.col("all") / n
    distance = F.lit(0.0)
    for g in range(3):
        expected = p * totals.get(g, 0)
        distance = F.greatest(distance, F.abs(F.col(f"g{g}") - expected) / F.sqrt(expected * (1 - p) + 0.5))
    best = counts.where("all >= 3").select("bucket", distance.alias("z")).where("z >= 2.5") \
        .orderBy(F.desc("z"), "bucket").limit(WEIGHTS)
    buckets = np.array(sorted(r["bucket"] for r in best.collect()), np.int64)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grade, held, found in rows_of(batches, "grade", "held_out", "features"):
            own = np.intersect1d(np.array(found, np.int64), buckets)
            yield pa.RecordBatch.from_arrays(
                [pa.array([grade], pa.int32()), pa.array([held]),
                 pa.array([np.searchsorted(buckets, own).astype(np.int32).tobytes()], pa.binary())],
                names=["grade", "held_out", "picked"],
            )

    known = rows.orderBy("doc_id").mapInArrow(lambda batches: gathered(pick(batches)), "grade int, held_out boolean, picked binary").toPandas()
    picked = [np.frombuffer(x, np.int32).astype(np.int64) for x in known["picked"]]
    held, grade = known["held_out"].to_numpy(bool), known["grade"].to_numpy()
    weights, thresholds = _fit([r for r, h in zip(picked, held, strict=True) if not h], grade[~held], len(buckets))
    report = {"trained_on": float(n), "held_out": float(held.sum())}
    if held.any():
        score = np.array([weights[r].sum() for r, h in zip(picked, held, strict=True) if h])
        keep = _sigmoid(score - thresholds[1]) >= KEEP_FROM
        report["accuracy"] = float((keep == (grade[held] == 2)).mean())
        report["good_kept"] = float(keep[grade[held] == 2].mean()) if (grade[held] == 2).any() else 1.0
        report["toxic_rejected"] = float(1 - keep[grade[held] == 0].mean()) if (grade[held] == 0).any() else 1.0
    return QualityModel(buckets, weights, thresholds, report)


def _scorer(model: QualityModel):
    """Tail probabilities P(grade >= 1), P(grade >= 2) of texts; 0 without words."""
    weight = dict(zip(model.buckets.tolist(), model.weights.tolist(), strict=True))
    memory = WordFeatures()

    def tails(texts: list[str | None]) -> np.ndarray:
        found = [features_of(t, memory) for t in texts]
        score = np.array([sum(weight.get(b, 0.0) for b in sorted(f & weight.keys())) for f in found])
        return model.tails(score) * np.array([bool(f) for f in found])[:, None]

    return tails


def scores(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """``doc_id, expected_grade, tail_probability, kept`` per row of ``docs (doc_id, text)``.

    NULL and empty texts, and texts of white space, have expected grade and tail
    probability 0 and are not kept. Without a model (no labelled document) both
    are NULL and every row is kept. Repeated rows and rows with a NULL id are
    scored like any other; further columns are not looked at.
    """
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    if model is None:
        return plain.select(
            "doc_id", F.lit(None).cast("double").alias("expected_grade"),
            F.lit(None).cast("double").alias("tail_probability"), F.lit(True).alias("kept"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        tails = _scorer(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = tails(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(found.sum(axis=1)), pa.array(found[:, 1]),
                     pa.array(found[:, 1] >= KEEP_FROM)],
                    names=["doc_id", "expected_grade", "tail_probability", "kept"],
                )

    return plain.mapInArrow(run, "doc_id long, expected_grade double, tail_probability double, kept boolean")


def keep_good(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """The rows of ``docs`` whose text is kept by ``scores``, with all their columns, whatever their names.

    Rows with a NULL or empty text go, unless there is no model; rows with a NULL id and
    repeated rows are judged like others. No rows give no rows.
    """
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        tails = _scorer(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                yield part.filter(pa.array(tails(part.column("text").to_pylist())[:, 1] >= KEEP_FROM))

    return docs.mapInArrow(run, docs.schema)
