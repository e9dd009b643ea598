"""Periodic runs, nearest neighbours and whitening against brute-force versions, with the awkward cases."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from stratalake.llm import graph_search, periodic_runs, whitening

# -- periodic runs ------------------------------------------------------------


def brute_runs(words, least=24, times=3):
    """All stretches of equal words q apart, shortest q first; a stretch's multiples of q don't count."""
    found = {}
    for q in range(1, len(words)):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i - start + q >= max(least, times * q):
                found.setdefault((start, i - start + q), q)
            i += i == start
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    top = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize(("least", "times"), [(24, 3), (6, 3), (4, 2), (12, 4), (3, 3)])
def test_runs_of_random_texts(least, times):
    rng = random.Random(least)
    for _ in range(150):
        texts = []
        for _ in range(3):
            kinds, n = rng.choice([1, 2, 3, 6]), rng.randrange(90)
            words = [b"%d" % rng.randrange(kinds) for _ in range(n)]
            if n and rng.random() < 0.6:
                words = words[:rng.randrange(n)] + words[:rng.randrange(1, 12)] * rng.randrange(1, 15) + words[:rng.randrange(20)]
            texts.append(words + words + words[:7] if rng.random() < 0.2 else words)
        assert periodic_runs.runs_of_texts(texts, least, times) == [brute_runs(w, least, times) for w in texts]


def test_long_periodic_text():
    text = b"x y z ".split() * 8 + [b"q"]
    runs = periodic_runs.runs_of_texts([text * 400, [], [b"a"] * 30_000])
    assert len(runs[0]) == 401 and runs[0][0] == (0, 24, 3) and (0, 10_000, 25) in runs[0]
    assert runs[1:] == [[], [(0, 30_000, 1)]]


def test_digests_of_runs(spark):
    rng = random.Random(3)
    rows = [(None, "a " * 40), (1, None), (2, ""), (3, " \t\x0b\n"), (4, "one"), (5, "é x " * 30 + "end"), (5, "é x " * 30 + "end"), (-7, "A a " * 20)]
    for i in range(10, 130):
        rows.append((i, " ".join(str(rng.randrange(4 if i % 3 else 300)) for _ in range(rng.randrange(140)))))
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, t in rows if i is not None and t) > 5
    docs = spark.createDataFrame([(i, t, "r", 1) for i, t in rows], "doc_id long, text string, runs string, h int")
    got = periodic_runs.digest(periodic_runs.collapse_runs(periodic_runs.with_planted_runs(docs))).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((brute_row(i, t) for i, t in rows), key=repr)
    assert periodic_runs.digest(periodic_runs.collapse_runs(periodic_runs.with_planted_runs(docs.limit(0)))).count() == 0


def test_batches_of_texts_do_not_matter(spark, monkeypatch):
    rows = [(i, "a b c " * 12 + f"{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, periodic_runs.collapse_runs(docs).collect()))
    monkeypatch.setattr(periodic_runs, "TOGETHER", 10)
    monkeypatch.setattr(periodic_runs, "RETURNED", 20)
    assert sorted(map(tuple, periodic_runs.collapse_runs(docs).collect())) == want
    assert want[0][2] == "a b c 0" and [tuple(r) for r in want[0][1]] == [(0, 36, 3)]


# -- nearest neighbours ---------------------------------------------------------

def brute_nearest(rows, queries, k):
    def usable(v):
        return v and None not in v and all(map(math.isfinite, v)) and any(v)

    out = []
    for qid, q in queries:
        if qid is not None and usable(q):
            near = sorted((math.dist(q, v), i) for i, v in rows if i is not None and i != qid and usable(v) and len(v) == len(q))[:k]
            out += [(qid, r + 1, i, d) for r, (d, i) in enumerate(near)]
    return out


def check_nearest(df, want):
    got = sorted(map(tuple, df.collect()))
    assert [r[:3] for r in got] == [r[:3] for r in sorted(want)]
    assert np.allclose([r[3] for r in got], [r[3] for r in sorted(want)], rtol=1e-12, atol=0)


SCHEMA = "vec_id long, embedding array<double>, score string, rank int"


def test_nearest_of_few_vectors(spark):
    rng = np.random.default_rng(2)
    grid = [[float(a), float(b)] for a, b in rng.integers(-3, 4, (150, 2))]  # ties, copies and zero vectors
    rows = list(enumerate(grid)) + [(300, None), (301, []), (302, [1.0, None]), (303, [float("nan"), 1.0]), (304, [float("inf"), 0.0]),
                                    (None, [1.0, 1.0]), (305, [1.0, 2.0, 3.0]), (306, [1.0, 2.0, 4.0]), (5, [9.0, 9.0])]
    df = spark.createDataFrame([(i, v, "s", 1) for i, v in rows], SCHEMA)
    queries = df.selectExpr("vec_id as query_id", "embedding").where("vec_id is null or vec_id <> 5 and vec_id % 3 <> 1")
    check_nearest(graph_search.nearest(df, queries, k=7), brute_nearest(rows, [(i, v) for i, v in rows if i is None or i != 5 and i % 3 != 1], 7))
    assert graph_search.nearest(df.limit(0), queries).count() == 0
    assert graph_search.nearest(df, queries.limit(0)).count() == 0


def test_nearest_of_extreme_vectors(spark):
    rows = [(i, [s * (1.0 + i / 7), s]) for i, s in enumerate([1e200, 1e200, 1e160, 3e-170, 2e-170, 1.0])]
    df = spark.createDataFrame([(i, v, "s", 1) for i, v in rows], SCHEMA)
    check_nearest(graph_search.nearest(df, df.selectExpr("vec_id as query_id", "embedding"), k=6), brute_nearest(rows, rows, 6))


def test_recall_over_shards(spark, monkeypatch):
    monkeypatch.setattr(graph_search, "PER_SHARD", 700)
    monkeypatch.setattr(graph_search, "ASKING", 40)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2500, 32))
    x[1000:2000] = x[0]  # copies that a graph of rows would not get out of
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame([(i, v, "s", 1) for i, v in rows], SCHEMA)
    queries = [(i, v) for i, v in rows if i % 25 == 0]
    got = {tuple(r)[:3] for r in graph_search.nearest(df, df.where("vec_id % 25 = 0").selectExpr("vec_id as query_id", "embedding")).collect()}
    want = brute_nearest(rows, queries, 10)
    assert len(got) == len(want)
    pairs = {(q, i) for q, _, i, _ in want}
    assert len(pairs & {(q, i) for q, _, i in got}) >= 0.97 * len(pairs)
    assert {(0, r + 1, 1000 + r) for r in range(10)} <= got


def test_graph_is_kept_in_flat_rows(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 8))
    classes = spark.createDataFrame([(8, 0, hashlib.blake2b(v.tobytes(), digest_size=16).digest(), v.tobytes()) for v in x],
                                    "width int, shard int, digest binary, vector binary")
    index = graph_search.build_index(classes).toPandas()
    graph = graph_search._graph(index)
    assert sorted(index["number"]) == list(range(300)) and len(graph.layers) > 1
    for k, links in enumerate(graph.layers):
        inside = np.flatnonzero(graph.tops >= k)
        assert (links[graph.tops < k] == -1).all() and np.isin(links[inside][links[inside] >= 0], inside).all()
        assert len(inside) < 2 or ((links[inside] >= 0).sum(axis=1) > 0).all()


# -- whitening ------------------------------------------------------------------

def brute_whitening(rows, most=4):
    from fractions import Fraction

    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows
            if v is not None and None not in v and all(map(math.isfinite, v))]
    fit = sorted({tuple(x) for _, x in kept})
    n, total = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    mean = [Fraction(t, n) for t in total]
    centred = [[c - m for c, m in zip(x, mean, strict=True)] for x in fit]
    v = np.array([[float(sum(r[i] * r[j] for r in centred) / n) for j in range(len(mean))] for i in range(len(mean))])
    values, vectors = np.linalg.eigh(v)
    out = {}
    for i, x in kept:
        d = np.array([float(c - m) for c, m in zip(x, mean, strict=True)])
        for k in range(min(most, len(mean))):
            out[i, k + 1] = (n, sum((n * c - t) ** 2 for c, t in zip(x, total, strict=True)),
                             d @ vectors[:, -1 - k] / np.sqrt(values[-1 - k]), values[-1 - k] / np.trace(v))
    return out


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, "n", 1.0) for i, v in rows], "vec_id long, embedding array<double>, n string, whitened double")


@pytest.mark.parametrize(("width", "offset"), [(6, 0.0), (6, 1e6), (3, -7.5)])
def test_whitening(spark, width, offset):
    rng = np.random.default_rng(width)
    x = rng.normal(size=(200, width)) * np.arange(1, width + 1) + offset
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    rows += [(1000, rows[0][1]), (1001, rows[0][1])]  # once in the fit
    df = vectors_of(spark, [*rows, (2000, None), (2001, [None] * width), (2002, [float("nan")] * width), (2003, [float("inf")] + [1.0] * (width - 1))])
    want, got = brute_whitening(rows), whitening.whiten(df.repartition(3)).collect()
    assert {(r.vec_id, r.component) for r in got} == set(want) and len(got) == len(want)
    for component in range(1, min(width, 4) + 1):
        mine = [r for r in got if r.component == component]
        sign = np.sign(sum(r.whitened * want[r.vec_id, component][2] for r in mine))
        for r in mine:
            n, deviation, whitened, explained = want[r.vec_id, component]
            assert (r.n, r.deviation) == (n, deviation) and r.identity_error < 1e-9
            assert r.whitened == pytest.approx(sign * whitened, abs=1e-8) and r.explained == pytest.approx(explained, rel=1e-9)


def test_whitening_of_odd_tables(spark):
    one = vectors_of(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [])])
    assert whitening.whiten(one).count() == 0 and whitening.whiten(one.limit(0)).count() == 0
    line = vectors_of(spark, [(i, [float(i), 2.0 * i, -1.0 * i]) for i in range(5)] + [(None, [9.0, 1.0, 1.0][:1] * 2), (7, [3.0, 1.0]), (7, [3.0, 1.0])])
    got = whitening.whiten(line).collect()
    assert sorted((r.vec_id, r.component) for r in got if r.n == 5) == [(i, 1) for i in range(5)]
    assert sorted(((r.vec_id is None, r.component) for r in got if r.n == 2)) == [(False, 1), (False, 1), (True, 1)]
    large = whitening.whiten(vectors_of(spark, [(i, [(-1.0) ** i * 2.0 ** 52, float(i)]) for i in range(6)])).collect()
    assert {r.deviation for r in large} == {None} and all(r.identity_error < 1e-4 for r in large)


@pytest.mark.parametrize("values", [
    [1.0] * 8, [1.0, 1.0 + 1e-9, 1.0 + 2e-9, 3.0, 3.0 + 1e-12, 5.0, 1e-6], [0.0, 0.0, 2.0], list(np.linspace(1, 2, 40))])
def test_refinement_reaches_double_precision(values):
    rng = np.random.default_rng(len(values))
    q = np.linalg.qr(rng.normal(size=(len(values),) * 2))[0].astype(np.longdouble)
    a = q @ np.diag(np.array(values, np.longdouble)) @ q.T
    a = (a + a.T) / 2
    found, x = whitening.refined_eigenvectors(a)
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-17 and np.abs(a @ x - x * found).max() < 1e-17 * max(values)
    assert np.allclose(found.astype(float), sorted(values, reverse=True), atol=1e-14)


def test_sums_are_exact_beyond_float64():
    rng = np.random.default_rng(1)
    y = rng.integers(-2 ** 60, 2 ** 60, (50, 3))
    limbs = whitening._limbs(y)
    exact = sum((one.T @ other).astype(np.int64).astype(object) << (whitening.LIMB * (i + j))
                for i, one in enumerate(limbs) for j, other in enumerate(limbs))
    assert (exact == y.astype(object).T @ y.astype(object)).all()
