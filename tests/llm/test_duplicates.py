"""N-gram join and repeat removal against brute force."""

import hashlib
import random

import numpy as np
import pytest

from canton.llm import ngram_join, repeats
from canton.llm.graph import components


def shingles(text):
    w = (text or "").split()
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))}


def brute_classes(rows):
    known = [(i, shingles(t)) for i, t in rows]
    n = len(known)
    links = [0] * n
    copies = [0] * n
    root = list(range(n))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        copies[a] += 1
        for b in range(a):
            s, t = known[a][1], known[b][1]
            same = s == t
            if same or s and t and len(s & t) >= 0.8 * len(s | t) - 1e-9:
                links[a] += 1
                links[b] += 1
                copies[a] += same
                copies[b] += same
                root[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for a in range(n):
        ids = {known[a][0], least.get(top(a))} - {None}
        least[top(a)] = min(ids, default=None)
    out = [(known[a][0], least[top(a)], links[a], copies[a]) for a in range(n)]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[2:]))


def corpus(seed, groups=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, at = [], 0
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 30, 120, 400]))]
        for _ in range(rng.choice([1, 2, 5, 90 if g == 3 else 4])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((at, " ".join(words) if rng.random() < 0.8 else "\n ".join(words) + " "))
            at += 1
    rng.shuffle(rows)
    rows += [(5000, ""), (5001, None), (5002, " \n\t"), (5003, "one"), (5004, "one"), (None, rows[0][1]), (None, None)]
    rows += [(6000, "long " * 40_000)]
    return rows


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rows = corpus(4)
    rows.append(rows[1])  # a repeated row
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, class_id string")
    got = [tuple(r) for r in ngram_join.near_duplicates(df.repartition(4)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(brute_classes(rows), key=key)
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    # Rows without an id are copies of others here, so each class keeps one with an id.
    assert sorted(ids) == sorted({r[1] for r in got})


def test_one_id_for_unlike_texts_and_none(spark):
    """Text A and B under one id, B again under another, copies without an id: each text stays once."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (1, b), (2, b), (None, c), (None, c), (None, c + " more"), (3, a + " more"), (4, None), (4, ""), (1, a)]
    df = spark.createDataFrame([(i, t, i, "x") for i, t in rows], "doc_id long, text string, id long, t string")
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert sum(i == 1 and t == a for i, t in got) == 1 and sum(i == 1 and t == b for i, t in got) == 1
    assert sum(i is None for i, _ in got) == 1 and sum(i == 4 for i, _ in got) == 1 and len(got) == 4
    classes = sorted((tuple(r) for r in ngram_join.near_duplicates(df).collect()), key=repr)
    assert classes == sorted(brute_classes(rows), key=repr)


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, row string")
    assert ngram_join.near_duplicates(empty).count() == 0
    assert ngram_join.keep_one(empty).count() == 0 and ngram_join.keep_one(empty).columns == empty.columns


def test_near_duplicates_of_given_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = sorted(tuple(r) for r in ngram_join.near_duplicates(df).collect())
    assert got == sorted(brute_classes(rows))


def test_banding_reaches_the_recall():
    for similarity, recall in ((0.8, 0.9999), (0.8, 0.9), (0.5, 0.99)):
        bands, rows = ngram_join.choose_bands(similarity, recall, 96)
        assert bands * rows <= 96 and 1 - (1 - similarity**rows) ** bands >= recall - 1e-12


def test_shared_counts(monkeypatch):
    monkeypatch.setattr(ngram_join, "_COLUMNS", 7)
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40))).astype(np.uint64) for _ in range(9)]
    offsets = np.cumsum([0, *map(len, sets)])
    got = ngram_join.shared_counts(np.concatenate(sets), offsets)
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    assert (got == want).all()


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    random.Random(1).shuffle(chain)
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_removed(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            w = t[i : i + length]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def passages(seed, length):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(length // 2) for _ in range(4)]
    rows = []
    for i in range(90):
        parts = [prose(rng.randint(0, 60))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            p = rng.choice(shared)
            a = rng.randrange(len(p))
            parts += [p[a : a + rng.randint(length // 2, 3 * length)] if rng.random() < 0.6 else p, prose(rng.randint(0, 40))]
        rows.append((i, " ".join(parts)))
    rows += [(200 + i, prose(3) + " " + shared[0] + " " + prose(9)) for i in range(40)]
    rows += [(300, "ab" * 200), (301, "x" * (length - 1)), (302, "y" * length), (303, "z" * (length + 1))]
    rows += [(304, ""), (305, None), (306, rows[3][1]), (307, rows[3][1] + "é"), (307, "q"), (None, rows[5][1]), (None, prose(50))]
    return rows


@pytest.mark.parametrize("group", [256, 3])
def test_repeats_equal_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    monkeypatch.setattr(repeats, "COLLECTION", 50)
    length = 40
    rows = passages(8, length)
    rows.append(rows[0])
    df = spark.createDataFrame([(i, t, "r") for i, t in rows], "doc_id long, text string, row string")
    got = [tuple(r) for r in repeats.remove_repeats(df.repartition(5), length, 12).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(brute_removed(rows, length), key=key)


def test_repeats_of_given_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = sorted(tuple(r) for r in repeats.remove_repeats(df).collect())
    assert got == sorted(brute_removed(rows, 400))
    assert repeats.remove_repeats(df.limit(0)).count() == 0


def test_anchors_are_in_every_string():
    rng = np.random.default_rng(0)
    raw = rng.integers(97, 100, 3000).astype(np.uint8)
    offsets = np.array([0, 700, 705, 3000])
    place, _ = repeats.anchors(raw, offsets, 60, 16)
    for a, b in zip(offsets[:-1], offsets[1:]):
        for i in range(a, b - 59):
            assert ((place >= i) & (place <= i + 44)).any()
