"""The pipeline on small tables: each stage against what it must keep, and the awkward tables."""

from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline
from stratalake.llm import packing
from tests.llm.test_operators import WORDS, jaccard_brute, prose

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def written(spark, folder, docs, labels):
    spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in docs], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


@pytest.fixture
def rows():
    rng = np.random.default_rng(8)
    docs = [(k, prose(k, 90 + int(rng.integers(0, 60))) + (" idiot moron idiot" if k % 4 == 0 else "")) for k in range(160)]
    labels = [(k, int(k % 4 > 0), int(k % 4 == 0)) for k in range(160)]
    near = docs[1][1].split()
    near[40] = "other"
    passage = prose(999, 60)
    docs += [(200, docs[1][1]), (201, " ".join(near)), (202, prose(700, 40) + " " + passage + " " + prose(701, 30)),
             (203, prose(702, 50) + " " + passage), (204, prose(703, 3000)), (205, None), (206, ""), (207, prose(704, 80)), (207, prose(704, 80)), (None, prose(705, 80))]
    return docs, labels


def test_run(spark, tmp_path, rows):
    docs, labels = rows
    sf_dir = written(spark, tmp_path, docs, labels)
    kept, frame = [], spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = corpus_pipeline.written(stage(spark, frame, sf_dir), name)
        assert [f.name for f in frame.schema] == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append([(r.doc_id, r.text) for r in frame.collect()])
    ids = [{i for i, _ in rows} for rows in kept]
    toxic = {k for k in range(160) if k % 4 == 0}
    assert not ids[0] & toxic and {k for k in range(160)} - toxic | {200, 201, 204, 207, None} <= ids[0] and not ids[0] & {205, 206}
    # one of each group of near copies, by brute force on what the classifier kept
    groups = jaccard_brute(dict((i, t) for i, t in kept[0] if i is not None).items(), 5, 80)
    assert {i for i in ids[1] if i is not None} == {i for i, (_, c) in groups.items() if i == c} and None in ids[1]
    assert len([i for i, _ in kept[1] if i == 207]) == 2  # rows of one document stay or go together
    before, after = dict(kept[1]), dict(kept[2])
    assert prose(999, 60) in after[202] and prose(999, 60) not in after[203] and set(after[203].split()) <= set(before[203].split())
    assert all(after[i] == t for i, t in before.items() if i not in (203,))
    places = corpus_pipeline.run(spark, sf_dir).toPandas()
    want = packing.pack(frame).toPandas()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(repr, places[columns].values.tolist())) == sorted(map(repr, want[columns].values.tolist()))
    assert (places.groupby("sequence_id")["length"].sum() <= 2048).all()
    assert set(places["doc_id"].dropna()) == {i for i in after if i is not None}


def test_run_on_odd_tables(spark, tmp_path):
    empty = written(spark, tmp_path / "empty", [], [])
    assert corpus_pipeline.run(spark, empty).count() == 0
    unlabelled = written(spark, tmp_path / "unlabelled", [(1, " ".join(WORDS[:9])), (2, None), (None, None)], [])
    assert corpus_pipeline.run(spark, unlabelled).count() == 3
