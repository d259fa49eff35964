"""Toxicity scores: held-out accuracy and defined results at the edges."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from canton.llm import toxicity


def prose(rng, n):
    pool = ["the", "of", "harbour", "stone", "river", "walks", "quietly", "under", "lantern", "and", "gardens"]
    return [rng.choice(pool) + rng.choice(["", "", "s", "ly", "ing"]) for _ in range(n)]


def labelled(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = prose(rng, rng.randint(8, 300))
        toxic = int(i % 5 == 0)
        if toxic:
            for _ in range(max(2, len(words) // 15)):
                words[rng.randrange(len(words))] = rng.choice(["vilescum,", "Braindead", "worthlessly", "moronic."])
        rows.append((i, " ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def rows():
    return labelled(1, 900)


def test_held_out_accuracy(spark, rows):
    extra = [(5000, "", 0), (5001, None, 1), (None, "no id", 1), (5002, "word " * 60_000, 0), (5003, "!!! ---", 0)]
    docs = spark.createDataFrame(
        [(i, t, 0, "l") for i, t, _ in rows + extra] + [(1, "repeated row", 0, "l")],
        "doc_id long, text string, score int, toxic string",
    ).repartition(4)
    marks = [(i, y) for i, _, y in rows] + [(3, None), (None, 1), (4, 7), (9999, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    texts, flags = toxicity.labelled_sample(docs, labels)
    train = {t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    assert set(texts) <= train | {"repeated row"} and sum(flags) > 50
    model = toxicity.fit(texts, flags)
    got = toxicity.score_toxicity(docs, model).collect()
    assert len(got) == len(rows) + 6
    truth = {i: y for i, _, y in rows}
    right = [r.predicted == truth[r.doc_id] for r in got if r.doc_id in truth and r.held_out]
    assert len(right) > 150 and np.mean(right) > 0.95
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id is None:
            assert r.held_out is False
        else:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.doc_id in (5000, 5001, 5003):
            assert r.score == 0
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    clean = sorted((r.doc_id is None, r.doc_id or 0) for r in got if not r.predicted)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == clean


def test_repeated_fits_agree(rows):
    texts, flags = [r[1] for r in rows], [r[2] for r in rows]
    one, two = toxicity.fit(texts, flags), toxicity.fit(texts, flags)
    column = pa.array(texts[:50] + [None, ""], pa.string())
    assert (one.scorer().scores(column) == two.scorer().scores(column)).all()
    # A text's score does not depend on its neighbours.
    alone = [one.scorer().scores(pa.array([t], pa.string()))[0] for t in texts[:20]]
    assert np.allclose(alone, one.scorer().scores(column)[:20], atol=1e-12)


def test_missing_labels(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows[:20]], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(*toxicity.labelled_sample(docs, none))
    assert {r.score for r in toxicity.score_toxicity(docs, model).collect()} == {0.5}
    clean = toxicity.fit([t for _, t, _ in rows[:20]], [0] * 20)
    assert all(r.predicted == 0 for r in toxicity.score_toxicity(docs, clean).collect())
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_labelled_texts_are_whole(spark):
    text = "word " * 10_000 + "vilescum"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.labelled_sample(docs, labels) == ([text], [1])


def test_all_stay_without_usable_labels(spark):
    rows = [(i, f"some words {i}") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = [t for _, t in rows]
    for model in (toxicity.fit([], []), toxicity.fit(texts[:4], [0, 1, 0, 1]), toxicity.fit(texts, [1] * 9)):
        assert toxicity.keep_clean(docs, model).count() == 9


def test_windows_cover_all_words():
    texts = ["One, two; three!four", "", None, "--", "é" * 5 + " a b c d e f g h"]
    text, starts, ends, owner, n = toxicity.windows(pa.array(texts), 3)
    assert n == 5
    joined = [b" ".join(text[a:b].split() and [text[a:b].strip()]) for a, b in zip(starts, ends)]
    assert joined == [b"one two three", b"four", "ééééé a b".encode(), b"c d e", b"f g h"]
    assert owner.tolist() == [0, 0, 4, 4, 4]


def test_the_driver_keeps_nothing_of_the_fit(spark, rows):
    """Freed memory would count beside the driver's later stages."""
    def used():
        with open("/proc/self/smaps_rollup") as f:
            return next(int(line.split()[1]) for line in f if line.startswith("Anonymous"))

    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    model = toxicity.fit([t for _, t, _ in rows], [y for _, _, y in rows])
    freed = [np.ones(125) for _ in range(200_000)]
    kept = freed[::1_000]  # holds the heap's top where it is
    del freed
    before = used()
    assert toxicity.keep_clean(docs, model).columns == docs.columns
    assert len(kept) == 200 and used() < before - 100_000
