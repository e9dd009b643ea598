"""Each operator against a brute-force version on small rows, with the awkward cases."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratalake.llm import bm25, chat, html_main, jaccard_join, packing, paragraph_dedup, piece_codec, quality, token_files
from stratalake.llm import vector_dups, words
from stratalake.llm.components import components

WORDS = [f"w{i}" for i in range(400)]


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] for i in rng.integers(0, len(WORDS), n))


def documents(spark, rows):
    """Rows of (doc_id, text) with columns named like those of results."""
    return spark.createDataFrame(
        [(i, t, "x", "y", 1) for i, t in rows], "doc_id long, text string, component string, hub string, n long")


def groups(links, ids):
    parent = {i: i for i in ids}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def test_components(spark):
    rng = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))] + [(i, i + 1) for i in range(200, 240)] + [(500, 500)]
    df = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    want = groups(links, {x for link in links for x in link})
    assert {r.node: r.component for r in components(df).collect()} == want
    assert components(df.limit(0)).count() == 0


# -- n-gram Jaccard join ----------------------------------------------------------

def jaccard_brute(rows, size, percent):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] & sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in groups(links, ids).items()}


def near_copies(seed, n, copies, changes):
    rng = np.random.default_rng(seed)
    base = prose(seed, n).split()
    for k in range(copies):
        words = list(base)
        for at in rng.integers(0, n, int(rng.integers(0, changes))):
            words[at] = f"z{k}x{at}"
        yield " ".join(words)


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_jaccard_components(spark, size, percent):
    texts = [None, "", " \n\t", "one two", "ONE two", "one two three", prose(1, 4), prose(1, 4), " odd space"]
    for seed, n in ((2, 30), (3, 120), (4, 700)):
        texts += near_copies(seed, n, 25, n // 12)
    texts += [prose(100 + k, int(n)) for k, n in enumerate(np.linspace(5, 900, 12))] + [prose(9, 20_000)]
    rows = list(enumerate(texts, 10))
    want = jaccard_brute(rows, size, percent)
    got = jaccard_join.jaccard_components(documents(spark, [*rows, (None, "no id")]), size, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want
    assert got.columns == ["doc_id", "n_shingles", "component_id"]


def test_jaccard_repeated_and_empty(spark):
    got = jaccard_join.jaccard_components(documents(spark, [(7, "a b c d e"), (7, "a b c d e"), (3, "a b c d e")])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(3, 3), (7, 3), (7, 3)]
    assert jaccard_join.jaccard_components(documents(spark, [])).count() == 0


def test_rows_without_an_id_stay_in_the_pipeline(spark):
    import corpus_pipeline

    rows = [(1, prose(1, 40)), (2, prose(1, 40)), (3, prose(2, 40)), (3, prose(2, 40)), (None, prose(1, 40)), (None, "other")]
    got = corpus_pipeline.one_of_each_group(spark, documents(spark, rows), "")
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(r for r in rows if r[0] != 2)


def test_whole_sets_are_compared_without_python_batches(spark, monkeypatch):
    plans = {}
    write = jaccard_join.written
    monkeypatch.setattr(jaccard_join, "written", lambda df, label: plans.setdefault(label, df._jdf.queryExecution().toString()) and write(df, label))
    near = prose(1, 60).split()
    rows = [(1, " ".join(near)), (2, " ".join([*near[:30], "x", *near[31:]])), (3, prose(2, 60))]
    got = jaccard_join.jaccard_components(documents(spark, rows), 4, 80).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, 3: 3}
    assert "InArrow" not in plans["linked"] and "array_intersect" in plans["linked"]


def test_tables_of_another_operator_leave_a_worker():
    words.process_memory("table", lambda: "large")
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["a b c"]})
    list(jaccard_join._sets(iter([batch]), 4))
    assert words.process_memory("table", lambda: "none") == "none"
    list(paragraph_dedup._paragraphs(iter([batch])))
    assert words.process_memory("table", lambda: "left") == "left"
    words.forget()


# -- substring dedup --------------------------------------------------------------

def test_texts_are_hashed_together(monkeypatch):
    texts = ["\n".join(prose(k + i, 55) for i in range(0, 3000, 1000)) for k in range(100)]
    calls, mix = [], paragraph_dedup.mix
    monkeypatch.setattr(paragraph_dedup, "mix", lambda *x: calls.append(1) or mix(*x))
    keys = lambda part: sorted(
        r for b in paragraph_dedup._paragraphs(iter([pa.RecordBatch.from_pydict({"doc_id": list(part), "text": [texts[k] for k in part]})]))
        for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    together = keys(range(100))
    assert len(calls) < 30  # one text after the other makes as many each
    assert together == sorted(r for k in range(100) for r in keys([k]))  # and no window or line reaches into the next text


def test_words_of_both_sides_are_not_written(spark, monkeypatch):
    tables, write = {}, paragraph_dedup.written
    monkeypatch.setattr(paragraph_dedup, "written", lambda df, label: tables.setdefault(label, df.columns) and write(df, label))
    passage, line = prose(50, 55), prose(51, 70)
    rows = [(1, f"{prose(1, 40)} {passage} {prose(2, 60)}\n{line}"), (2, f"{prose(3, 33)} {passage} {prose(5, 20)}\n{line.replace(' ', ' new ', 1)}")]
    got = {r.doc_id: r.removed_words for r in paragraph_dedup.remove_repeats(documents(spark, rows)).collect()}
    assert got == {1: 0, 2: 126}
    assert not [t for t, columns in tables.items() if "hub_words" in columns or {"key", "words"} <= set(columns)]


def test_remove_repeats(spark):
    passage, line = prose(50, 55), prose(51, 70)
    changed = line.replace(" ", " new ", 1)
    rows = [
        (1, f"{prose(1, 40)} {passage} {prose(2, 60)}"), (2, f"{prose(3, 33)}\n{prose(4, 11)} {passage} {prose(5, 20)}\n{prose(6, 9)}"),
        (3, f"{prose(7, 30)}\n{line}\n{prose(8, 30)}"), (4, f"{prose(9, 20)}\n{changed}\n{prose(10, 61)}"),
        (5, prose(11, 300)), (6, None), (7, ""), (8, "short text"), (9, prose(11, 300)), (10, prose(12, 49)), (11, prose(12, 49)),
        (None, passage),
    ]
    df = documents(spark, rows).withColumn("removed_words", F.lit("clash"))
    got = {r.doc_id: r for r in paragraph_dedup.remove_repeats(df).collect()}
    text = dict(rows)
    for i in (1, 3, 5, 6, 7, 8, 10, 11, None):
        assert (got[i].text, got[i].removed_words) == (text[i], 0), i
    assert got[2].text == f"{prose(3, 33)}\n{prose(4, 11)} {prose(5, 20)}\n{prose(6, 9)}" and got[2].removed_words == 55
    assert got[4].text == f"{prose(9, 20)}\n{prose(10, 61)}"
    assert got[9].text == "" and got[9].removed_words == 300
    assert paragraph_dedup.remove_repeats(documents(spark, [])).count() == 0


@pytest.mark.parametrize("lead", range(0, 60, 7))
def test_windows_of_a_passage_are_found_wherever_it_stands(lead):
    rng = np.random.default_rng(lead)
    draw = lambda n: rng.integers(0, 2**63, n).astype(np.uint64)
    passage = draw(paragraph_dedup.MIN_WORDS + 1)
    one, two = (np.concatenate([draw(k), passage, draw(40)]) for k in (lead, 11))
    assert set(paragraph_dedup.window_starts(one)[1]) & set(paragraph_dedup.window_starts(two)[1])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_passages_against_brute_force(spark, seed):
    """All words go that stand in 50 words of an earlier document, and none but those of 20 words that another one has too."""
    rng = np.random.default_rng(seed)
    fresh = (f"v{i}" for i in range(10**6))
    texts = [[next(fresh) for _ in range(int(rng.integers(20, 400)))] for _ in range(12)]
    for _ in range(25):  # passages of any length, put into any other document
        a, b = (texts[i] for i in rng.choice(len(texts), 2, replace=False))
        n, at = int(rng.integers(30, 120)), int(rng.integers(0, len(a)))
        place = int(rng.integers(0, len(b) + 1))
        b[place:place] = a[at:at + n]
    docs = documents(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])
    got = {r.doc_id: {w for s in r.repeated_spans for w in range(s["first"], s["last"])} for r in paragraph_dedup.remove_repeats(docs).collect()}
    for size, holds in ((50, lambda some, i: some <= got[i]), (20, lambda some, i: got[i] <= some)):
        first: dict[tuple, int] = {}
        for i, words in enumerate(texts):
            repeated = set()
            for at in range(len(words) - size + 1):
                if first.setdefault(tuple(words[at:at + size]), i) < i:
                    repeated |= set(range(at, at + size))
            assert holds(repeated, i)


def test_words_repeated_over_and_over_are_one_pair(spark, monkeypatch):
    counts, write = {}, paragraph_dedup.written

    def counted(df, label):
        table = write(df, label)
        counts[label] = table.count()
        return table

    monkeypatch.setattr(paragraph_dedup, "written", counted)
    rows = [(k, f"{prose(k, 30)} {'is onhe. ' * 150}{prose(100 + k, 30)}") for k in range(9)]
    got = {r.doc_id: r.removed_words for r in paragraph_dedup.remove_repeats(documents(spark, rows)).collect()}
    assert got == {0: 0} | dict.fromkeys(range(1, 9), 300)
    assert counts["pairs"] <= 8 * 4 and counts["passages"] <= 8 * 80  # some 150 and 300 a document if each window counts


@pytest.mark.parametrize("period", [2, 23, 40])
def test_stretches_of_repeated_words_against_brute_force(spark, period):
    """Stretches of any length, whatever the first document has of them: the words that stand in 50 words of an earlier one go."""
    unit, rng = prose(period, period).split(), np.random.default_rng(period)
    lengths = [23, 130, 400, 75, 51, 260, 130]
    texts = []
    for k, n in enumerate(lengths):
        turn, tail = int(rng.integers(0, period)), prose(900 + k % 2, 40).split()
        texts.append([*prose(100 + k, 33).split(), *((unit[turn:] + unit * (1 + n // period))[:n]), *tail, *unit * (60 // period), *prose(200 + k, 21).split()])
    docs = documents(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])
    got = {r.doc_id: {w for s in r.repeated_spans for w in range(s["first"], s["last"])} for r in paragraph_dedup.remove_repeats(docs).collect()}
    for size, holds in ((50, lambda some, i: some <= got[i]), (20, lambda some, i: got[i] <= some)):
        first: dict[tuple, int] = {}
        for i, words_of in enumerate(texts):
            repeated = set()
            for at in range(len(words_of) - size + 1):
                if first.setdefault(tuple(words_of[at:at + size]), i) < i:
                    repeated |= set(range(at, at + size))
            assert holds(repeated, i), (i, sorted(repeated ^ got[i]))


def test_stretches():
    at, key, text = np.array([3, 5, 7, 9, 14, 16, 60, 2, 4, 9]), np.array([7, 7, 7, 7, 7, 7, 7, 7, 7, 8]), np.array([0] * 7 + [1] * 3)
    head, times, every = paragraph_dedup.stretches(at, key, text)
    assert list(zip(head.tolist(), times.tolist(), every.tolist(), strict=True)) == [(0, 4, 2), (4, 1, 0), (5, 1, 0), (6, 1, 0), (7, 2, 2), (9, 1, 0)]
    none = np.zeros(0, np.int64)
    assert [len(x) for x in paragraph_dedup.stretches(none, none, none)] == [0, 0, 0]


def test_islands():
    assert paragraph_dedup.islands([(5, 9), (0, 3), (2, 4), (4, 5), (8, 12), (8, 10)]) == [(0, 4), (4, 5), (5, 12)]


@pytest.mark.parametrize("size", [3, 40, 400, 6000])
def test_sketches_never_overstate(size):
    rng = np.random.default_rng(size)
    a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
    for changed in (0, 1, size // 10, size // 2, size):
        b = np.unique(np.concatenate([a[changed:], rng.integers(0, 2**63, changed).astype(np.uint64)]))
        (x, fine_x), (y, fine_y) = (jaccard_join.cells_of([jaccard_join.sketch_of(v)]) for v in (a, b))
        differing = len(np.setxor1d(a, b))
        assert np.abs(x - y).sum() <= differing and jaccard_join.apart(fine_x, fine_y)[0] <= differing
        if 40 <= size <= 400 and changed == size // 10:
            assert jaccard_join.apart(fine_x, fine_y)[0] > 0.6 * differing


def test_bands_recall():
    rng = np.random.default_rng(3)
    hit = 0
    for _ in range(300):
        common, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (160, 20, 20))
        x, y = paragraph_dedup.band_keys([np.concatenate([common, a]), np.concatenate([common, b])])  # 0.8
        hit += bool(set(x) & set(y))
    assert hit >= 295


def test_passage_of_which_an_earlier_document_has_a_piece(spark):
    rows = []
    for k in range(0, 120, 4):
        passage = prose(500 + k, 55).split()
        piece = " ".join(passage[5:50])
        around = [prose(10_000 + 10 * k + i, 20 + 3 * i) for i in range(6)]
        rows += [(k + i, f"{around[i]} {held} {around[i + 3]}") for i, held in enumerate((piece, " ".join(passage), " ".join(passage)))]
    got = {r.doc_id: r.removed_words for r in paragraph_dedup.remove_repeats(documents(spark, rows)).collect()}
    assert all((got[k], got[k + 1], got[k + 2]) == (0, 0, 55) for k in range(0, 120, 4)), got


def test_each_occurrence_of_a_passage_goes(spark):
    passage = prose(70, 60)
    rows = [(1, f"{prose(1, 40)} {passage} {prose(2, 30)}"), (2, f"{prose(3, 30)} {passage} {prose(4, 45)} {passage} {prose(5, 30)}")]
    got = {r.doc_id: r for r in paragraph_dedup.remove_repeats(documents(spark, rows)).collect()}
    assert got[2].removed_words == 120 and got[2].text == f"{prose(3, 30)} {prose(4, 45)} {prose(5, 30)}"


def test_lines_of_one_bucket_are_compared_with_each_other(spark, monkeypatch):
    monkeypatch.setattr(paragraph_dedup, "BANDS", 1)  # every line of one bucket, and the first is unlike the rest
    monkeypatch.setattr(paragraph_dedup, "band_keys", lambda sets: np.full((len(sets), 1), 7, np.uint64))
    line = prose(80, 90).split()
    near = [*line[:45], "x", *line[46:]]
    rows = [(1, prose(81, 90)), (2, " ".join(line)), (3, prose(82, 70)), (4, " ".join(near))]
    got = {r.doc_id: r.removed_words for r in paragraph_dedup.remove_repeats(documents(spark, rows)).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 90}


def test_paragraphs_of_short_lines(spark):
    words = prose(90, 96).split()
    changed = [*words[:30], "x", *words[31:62], "y", *words[63:]]
    lay = lambda w: "\n".join(" ".join(w[k:k + 12]) for k in range(0, 96, 12))
    rows = [(1, f"{prose(1, 20)}\n\n{lay(words)}\n\n{prose(2, 20)}"), (2, f"{prose(3, 20)}\n \n{lay(changed)}\n\n{prose(4, 20)}")]
    got = {r.doc_id: r for r in paragraph_dedup.remove_repeats(documents(spark, rows)).collect()}
    assert got[1].removed_words == 0 and got[2].removed_words == 96
    assert paragraph_dedup.long_lines("a\n\n" + lay(words) + "\n") == [(1, 96)]


# -- packing ------------------------------------------------------------------------

def clip_ids(text):
    from tokenizers import Tokenizer

    from stratalake.llm.tokens import vocabulary

    return Tokenizer.from_file(vocabulary()).encode(text or "", add_special_tokens=False).ids


ODD_TEXTS = [
    None, "", " ", "a  b   c ", " lead", "▁x ▁▁ y", "é́ x \x1c z\x00 <s> <unk>", "tab\tnew\n\nline \n x", "İstanbul ẞ ǅ",
    "it's <|endoftext|> we'll 123 ４５ don't!!", "日本語 テスト 😀😀", "a" * 3000, "word " * 3000, "x ,.- ... a.b b; c!", "́abc ́", "\n",
]


def test_pack(spark):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(99, "rep"), (99, "rep"), (None, "x")] + [
        (200 + k, prose(k, 40 + 13 * k)) for k in range(60)]
    got = packing.pack(documents(spark, rows), size=256).toPandas()
    want = Counter()
    for i, text in rows:
        ids = [*clip_ids(text), 0]
        for p, at in enumerate(range(0, len(ids), 256)):
            want[(i, p, at, len(ids[at:at + 256]), zlib.crc32(np.array(ids[at:at + 256], "<u4").tobytes()))] += 1
    assert Counter((None if math.isnan(r[0]) else int(r[0]), *r[1:5]) for r in got.itertuples(index=False)) == want
    at = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert (at["length"].cumsum() - got["length"] == got["offset"]).all() and at["length"].sum().max() <= 256
    assert got["sequence_id"].nunique() <= math.ceil(got["length"].sum() / 256) + 1
    assert packing.pack(documents(spark, [])).count() == 0


def test_packed_sequences_hold_the_ids(spark):
    docs = documents(spark, [(k, prose(k, 70 + k)) for k in range(12)])
    places = packing.pack(docs, size=128)
    rows = {r.sequence_id: r.ids for r in packing.sequences(docs, places).collect()}
    for p in places.collect():
        assert rows[p.sequence_id][p.offset:p.offset + p.length] == [*clip_ids(prose(p.doc_id, 70 + p.doc_id)), 0][p.start:p.start + p.length]


def test_best_triples_against_all():
    rng = np.random.default_rng(3)
    counts, value = rng.integers(0, 2, 65), rng.normal(size=65)
    counts[0] = 0
    every = [(a, b, c) for a in range(64) for b in range(1, a + 1) for c in range(1, b + 1)
             if a + b + c == 64 and counts[a] and counts[b] and counts[c]]
    best = {}
    for t in every:
        worth = value[list(t)].sum()
        if worth > max(0, best.get(t[0], (0,))[0]):
            best[t[0]] = worth, t
    got = {int(t[0]): value[t].sum() for t in packing.best_triples(counts, 64, value)}
    assert got.keys() == best.keys() and all(got[a] == pytest.approx(best[a][0]) for a in got)


def test_plan_of_large_counts():
    counts = np.zeros(2049, np.int64)
    rng = np.random.default_rng(1)
    counts[1:] = rng.integers(0, 10**9, 2048)
    counts[37] = 10**12  # one length with most of the pieces
    plan = packing.plan_packing(counts)
    filled = (counts * np.arange(2049)).sum()
    assert plan.sequences <= 1.015 * filled / 2048 + 2  # a third of the tokens are in pieces that fill no sequence
    for length in (37, 5, 2048):
        ranks = np.array([0, counts[length] - 1, counts[length] // 2])
        sequence, offset = plan.place(np.full(3, length), ranks)
        assert (sequence < plan.sequences).all() and (offset + length <= 2048).all()


# -- token files ------------------------------------------------------------------

def test_token_files(spark):
    rows = list(enumerate(ODD_TEXTS, -5)) + [(900, "rep"), (900, "rep"), (None, "none")]
    got = token_files.token_file_rows(documents(spark, rows)).toPandas().sort_values("start")
    at = 0
    for (i, text), r in zip(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), got.itertuples(), strict=True):
        ids = [*clip_ids(text), 2]
        assert (None if math.isnan(r.doc_id) else r.doc_id, r.start, r.n_tokens) == (i, at, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert token_files.token_file_rows(documents(spark, [])).count() == 0


def test_documents_are_read_by_their_place(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 300)
    rows = [(i // 2, prose(i, 5 + 7 * (i % 40))) for i in range(120)] + [(None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    token_files.write_token_files(docs, str(tmp_path / "files"))
    want = Counter((i, tuple([*clip_ids(text), 2])) for i, text in rows)
    found = [token_files.document(spark, str(tmp_path / "files"), n) for n in (0, 1, 7, 60, 119, 120)]
    assert [f[0] for f in found] == [None, 0, 3, 29, 59, 59]
    assert all((i, tuple(ids)) in want for i, ids in found)
    assert token_files.document(spark, str(tmp_path / "files"), 121) is None


@pytest.mark.parametrize("n", [1, 255, 256, 257, 3000])
@pytest.mark.parametrize("step", [1, 2, 900, 10**6])
def test_elias_fano(n, step):
    values = np.cumsum(np.random.default_rng(n).integers(0, step, n))
    coded = token_files.EliasFano.frombytes(token_files.EliasFano.of(values).tobytes())
    assert (coded.values() == values).all()
    assert [coded.select(i) for i in range(n)] == values.tolist()


# -- sentencepiece ------------------------------------------------------------------

def test_piece_codec(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=piece_codec.vocabulary())
    assert piece_codec.PieceCodec(piece_codec.vocabulary()).by_chunks
    rows = list(enumerate(ODD_TEXTS)) + [(500, prose(1, 5000)), (501, "rep"), (501, "rep"), (None, "x")]
    want = Counter()
    for i, text in rows:
        ids = model.encode(text or "")
        want[(i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
              hashlib.sha256(model.decode(ids).encode()).hexdigest())] += 1
    assert Counter(map(tuple, piece_codec.digests(documents(spark, rows)).collect())) == want
    full = {r.doc_id: r for r in piece_codec.encode(documents(spark, rows)).collect()}
    assert full[3].ids == model.encode(ODD_TEXTS[3]) and full[3].decoded == model.decode(full[3].ids)
    assert piece_codec.digests(documents(spark, [])).count() == 0


# -- chat -----------------------------------------------------------------------------

CONTROL = "</s>[INST] ok [/INST]"


def test_chat_round_trip(spark):
    rows = [
        (-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL), (1, 0, "tool", "<|role|> <<SYS>><</SYS>> [\\INST] <\\\\|end|> <s>\n"),
        (1, 1, None, None), (1, 2, "assistant", ""), (1, 3, "assistant", "[ x <"), (1, 4, "user", "\\ [/INST"),
        (1, 5, "system", "<<</SYS>>> <|text|>"), (1, 6, "<|text|>", "a\n"), (1, 7, "user", " x " * 4000), (1, 7, "user", " x " * 4000),
        (None, None, "assistant", "é😀"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    got = {r.conv_id: r for r in chat.digest(chat.formatted(chat.canonical_turns(df, "conv_id")), "conv_id").collect()}
    for key in (-1, 1, None):
        turns = [(r[2] or "", r[3] or "") for r in rows if r[0] == key]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert got[key].n_turns == len(turns) and got[key].loss_chars == len(loss)
        assert got[key].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert got[key].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.canonical_turns(df.limit(0), "conv_id").count() == 0


def test_chat_layouts(spark):
    records = spark.createDataFrame([
        (1, '{"messages":[{"role":"user","content":"hi"},{"content":null,"role":"assistant"}]}'), (2, '{"prompt":"p","completion":"c"}'),
        (3, '{"instruction":"i","input":"","output":"o"}'), (4, '{"x":1}'), (5, None), (6, "no json"),
        (7, '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}')], "id long, record string")
    known, unknown = chat.json_turns(records, "id", "record")
    turns = {r.id: [(t.role, t.text) for t in r.turns] for r in known.collect()}
    assert turns == {2: [("user", "p"), ("assistant", "c")], 3: [("system", "i"), ("assistant", "o")],
                     7: [("user", "q"), ("assistant", "a")], 1: [("user", "hi"), ("assistant", "")]}
    assert sorted(r.id for r in unknown.collect()) == [4, 5, 6]
    with pytest.raises(chat.UnknownLayout):
        chat.canonical_turns(spark.createDataFrame([(1, "a")], "id long, prompt string"), "id")
    # columns named like fields of other layouts
    rows = spark.createDataFrame([(1, 0, "user", "hi", "x", "y")], "id long, turn int, role string, text string, output string, prompt string")
    assert [(t.role, t.text) for t in chat.canonical_turns(rows, "id").first().turns] == [("user", "hi")]
    with pytest.raises(chat.UnknownLayout):
        chat.canonical_turns(spark.createDataFrame([(1, "a", "b", "c")], "id long, prompt string, completion string, response string"), "id")


# -- pages ------------------------------------------------------------------------------

def test_main_text(spark):
    page = (
        "<html><head><title>x</title></head><body><header><h1>Site</h1></header><div class='cookie-notice'>We use</div><main>"
        "<article class=post><h1>T&amp;itle</h1><p>One <b>two</b>\n&lt;three&gt;<br>four</p><div class=\"ad-slot\">BUY</div>"
        "<ul><li>a</li><li>b</li></ul><p>end <span class=ad>x</span>of</p><div>PART {}</div><div>See also us</div>"
        "<section id='comments'><p>nice</p></section><script>if (a<b) '</p>'</script></article></main><form>f</form><footer>f</footer>")
    rows = [(k, f"https://User@Host.example:8/{k}", page.format(k)) for k in range(8)]
    rows += [(20, None, "<p>no host"), (21, "http://a.b/", None), (22, "http://a.b/", ""), (None, "x", "plain &amp; text < 3 <p"),
             (23, "http://host.example/", "<article><p>" + "long " * 50_000 + "</article>"), (24, "http://h/", "<nav>only</nav>")]
    copied = "<article><h2>Own</h2><ul><li>kept</li></ul><div>kept too</div></article>"
    rows += [(k, "http://copies/", f"<p>{k}" + copied) for k in range(30, 40)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in html_main.extract_main_text(df).collect()}
    for k in range(8):
        assert got[k].text == f"T&itle\nOne two <three> four\nend of\nPART {k}"  # the list and "See also us" recur
    assert [got[k].text for k in (20, 21, 22, None, 24)] == ["no host", "", "", "plain & text < 3", ""]
    assert all(got[k].text == "Own\nkept\nkept too" for k in range(30, 40))  # copies of one article
    assert got[23].n_chars == 5 * 50_000 - 1 == len(got[23].text)
    assert html_main.extract_main_text(df.limit(0)).count() == 0


# -- search -------------------------------------------------------------------------------

def bm25_brute(rows, queries, k):
    memory = bm25.WordHashes()
    tf = [(i, dict(zip(*(x.tolist() for x in bm25.terms_of(t, memory)), strict=True))) for i, t in rows if i is not None]
    mean = sum(sum(d.values()) for _, d in tf) / len(tf)
    df = Counter(t for _, d in tf for t in d)
    for q, text in queries:
        scored = []
        asked = dict(zip(*(x.tolist() for x in bm25.terms_of(text, memory)), strict=True))
        for i, d in tf:
            length = sum(d.values())
            s = sum(n * math.log1p((len(tf) - df[t] + 0.5) / (df[t] + 0.5)) * d[t] * 2.2 / (d[t] + 1.2 * (0.25 + 0.75 * length / mean))
                    for t, n in asked.items() if t in d)
            if s > 0:
                scored.append((-round(s, 6), i))
        yield from ((q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1))


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(bm25, "SHARD_DOCS", 150)
    monkeypatch.setattr(bm25, "BLOCK", 8)
    rows = [(k, prose(k, 5 + 7 * (k % 40))) for k in range(400)] + [(1000, None), (1001, ""), (1002, prose(3, 30)), (1003, prose(3, 30)),
                                                                     (1004, "Rare, WORD rare"), (1005, prose(9, 20_000)), (None, "w1 w2")]
    queries = [(1, prose(7, 12)), (2, "rare word"), (3, None), (4, "nothing-known"), (5, prose(3, 30)), (6, prose(8, 3000)), (None, "w1")]
    got = bm25.top_k(documents(spark, rows), spark.createDataFrame(queries, "query_id long, text string"), 10).collect()
    want = list(bm25_brute(rows, [q for q in queries if q[0]], 10))
    assert sorted((r.query_id, r["rank"], r.doc_id) for r in got) == sorted(w[:3] for w in want)
    assert max(abs(a.score - b[3]) for a, b in zip(sorted(got, key=lambda r: (r.query_id, r["rank"])), sorted(want), strict=True)) < 2e-6
    assert bm25.top_k(documents(spark, []), spark.createDataFrame(queries, "query_id long, text string")).count() == 0


@pytest.mark.parametrize("k", [1, 10, 200])
def test_thin_lists_without_bounds(monkeypatch, k):
    """Lists with few postings in a block are added up without bounds, others pruned by them; both give the same."""
    monkeypatch.setattr(bm25.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    monkeypatch.setattr(bm25, "BLOCK", 8)
    monkeypatch.setattr(bm25, "FREQUENT", 1)
    texts = pa.table({"doc_id": range(300), "text": [prose(i, 5 + 7 * (i % 40)) for i in range(300)]})
    row, = bm25._shards(iter(texts.to_batches()))
    shard = bm25.Shard(*(row.column(c)[0].as_py() for c in bm25._SHARD[3:]), 140.0)
    asked = [bm25.terms_of(prose(i, 60), bm25.WordHashes()) for i in range(500, 520)]
    places, weights = [shard.find(terms) for terms, _ in asked], [counts * 1.5 for _, counts in asked]
    pruned, by_bounds = shard._pruned, []
    monkeypatch.setattr(bm25.Shard, "_pruned", lambda _, *query: by_bounds.append(query) or pruned(*query))
    thin = list(shard.best(places, weights, k))
    assert not by_bounds
    monkeypatch.setattr(bm25, "THIN", 0)
    bounded = list(shard.best(places, weights, k))
    assert len(by_bounds) == len(asked)
    for (docs, scores), (others, same) in zip(thin, bounded, strict=True):
        assert docs.tolist() == others.tolist() and len(docs) == k and abs(scores - same).max() < 2e-6


# -- vectors --------------------------------------------------------------------------------

def test_vectors(spark, monkeypatch):
    for name, value in {"PER_LIST": 40, "MEMBERS": 64, "PROBES": 100}.items():
        monkeypatch.setattr(vector_dups, name, value)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(150, 24))
    near = np.concatenate([base[:30].repeat(9, axis=0) + 0.07 * rng.normal(size=(270, 24)), base[:1].repeat(200, axis=0) + 0.1 * rng.normal(size=(200, 24))])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate([near, base]), 5)]
    rows += [(2000 + k, rows[0][1]) for k in range(40)] + [(3000, [2 * x for x in rows[0][1]])]
    odd = [(4000, None), (4001, []), (4002, [0.0] * 24), (4003, [float("nan")] * 24), (4004, [None] * 24), (4005, [float("inf")] * 24),
           (4006, [1e300] * 24), (4007, [1.0] * 3), (4008, [1.0] * 24)]
    units = {i: np.array(v) / np.abs(v).max() for i, v in [*rows, (4006, [1.0] * 24), (4008, [1.0] * 24)]}
    ids = sorted(units)
    x = np.stack([units[i] / np.linalg.norm(units[i]) for i in ids])
    linked = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    want = groups([(ids[a], ids[b]) for a, b in zip(*np.nonzero(linked), strict=True)], [*ids, *(i for i, _ in odd)])
    df = spark.createDataFrame([(i, v, 1, "n") for i, v in [*rows, *odd]], "vec_id long, embedding array<double>, label int, unit string")
    got = {r.vec_id: r for r in vector_dups.near_duplicate_vectors(df).collect()}
    counts = dict(zip(ids, linked.sum(axis=1).tolist(), strict=True))
    found = sum(got[i].n_links for i in ids)
    assert found >= 0.99 * sum(counts.values()) and all(got[i].n_links <= counts[i] for i in ids)
    assert {i: got[i].component_id for i in want} == want
    assert all(got[i].kept == (want[i] == i) for i in want)
    assert all(got[i].n_links == 0 for i, _ in odd if i not in units)
    assert vector_dups.near_duplicate_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("spread", ["narrow", "falling", "even"])
def test_no_pair_is_lost_to_a_list_not_probed(spread):
    rng = np.random.default_rng(6)
    draw = {"narrow": lambda n: rng.normal(size=(n, 8)) @ rng.normal(size=(8, 64)), "even": lambda n: rng.normal(size=(n, 64)),
            "falling": lambda n: rng.normal(size=(n, 64)) / np.arange(1, 65)}[spread]
    unit = lambda v: v / np.linalg.norm(v, axis=1)[:, None]
    x = unit(draw(6000))
    step = unit(draw(6000))
    step = unit(step - (step * x).sum(axis=1)[:, None] * x)
    y = 0.951 * x + np.sqrt(1 - 0.951 ** 2) * step
    centres = vector_dups._kmeans(np.concatenate([x, y]), 128, 1, 4)
    limit, apart = np.sqrt(0.1) + 1e-9, vector_dups._nearest(centres, centres)[1]
    (a, d_a), (b, d_b) = vector_dups._nearest(x, centres), vector_dups._nearest(y, centres)
    assert (a != b).any()
    row = np.arange(len(x))
    assert (vector_dups.probes(d_a, a, apart, limit)[row, b] | vector_dups.probes(d_b, b, apart, limit)[row, a]).all()


# -- quality ----------------------------------------------------------------------------------

def test_repeated_documents_are_fitted_once(spark):
    rows = [(k, prose(k, 60) + (" idiot" if k % 2 else "")) for k in range(40)]
    labelled = spark.createDataFrame([(k, 1 - k % 2, k % 2) for k in range(40)], "doc_id long, quality int, toxic int")
    again = rows + [(3, rows[3][1])] * 200 + [(None, "x")]
    one, other = (quality.train(documents(spark, r), labelled) for r in (rows, again))
    assert one.report == other.report and (one.weights == other.weights).all()
    assert quality.train(documents(spark, []), labelled) is None

def test_quality(spark):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for k in range(900):
        text, grade = prose(k, int(rng.integers(20, 200))), k % 3
        if grade == 1:
            text = " ".join(w + "%%%" for w in text.split())
        if grade == 0:
            text += f" {('idiot', 'moron')[k % 2]} " + prose(k + 5000, 10)
        rows.append((k, text))
        labels.append((k, int(grade == 2), int(grade == 0)))
    labels += [(0, 1, 0), (None, 1, 1), (3, None, None), (77_777, 1, 0)]
    docs = documents(spark, [*rows, (5000, None), (5001, ""), (5002, "\n "), (5003, "w1 " * 30_000), (None, prose(1, 50))])
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.train(docs, labelled)
    assert model.report["accuracy"] > 0.97 and model.thresholds[0] < model.thresholds[1]
    got = {r.doc_id: r for r in quality.scores(docs, model).collect()}
    assert sum(got[k].kept == (k % 3 == 2) for k in range(900)) > 880
    assert [(got[k].expected_grade, got[k].tail_probability, got[k].kept) for k in (5000, 5001, 5002)] == [(0.0, 0.0, False)] * 3
    assert got[None].kept
    mean = [np.mean([got[k].expected_grade for k in range(g, 900, 3)]) for g in range(3)]
    assert mean[0] < mean[1] < mean[2]
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got.values())
    assert quality.train(docs, labelled.limit(0)) is None
    assert all(r.kept for r in quality.scores(docs, None).collect())
    assert quality.scores(docs.limit(0), model).count() == 0
