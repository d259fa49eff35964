"""Line dedup against brute force over all pairs of lines."""

import random
import re

import pytest

from canton.llm import line_dedup


def words(line):
    return {w for w in re.split("[ \t\r\f\v\n]+", line) if w}


def brute(rows):
    """rows: (doc_id, text), ids distinct or rows equal. Kept lines by doc_id."""
    order = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = [], {}
    for i, text in order:
        kept = []
        lines = text.split("\n")
        for line in lines:
            s = words(line)
            if not s or not any(len(s & t) >= 0.8 * len(s | t) - 1e-9 for t in seen):
                kept.append(line)
            if s:
                seen.append(s)
        out[i] = (i, "\n".join(kept), len(lines), len(lines) - len(kept))
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.6)) % 4000}" for _ in range(3000)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 10, 40]))] for _ in range(60)]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(rng.randint(1, 6)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                at = rng.randrange(len(line) + 1)
                line[at : at + rng.choice([0, 1])] = [rng.choice(vocabulary)] * rng.choice([0, 1])
            if rng.random() < 0.1:
                line = [f"new{rng.random()}" if rng.random() < 0.1 else w for w in line]
            lines.append(("  " if rng.random() < 0.3 else " ").join(line) + ("\r" if rng.random() < 0.2 else ""))
        rows.append((i, "\n".join(lines)))
    variants = [f"v{k}" for k in range(50)]
    for k in range(80):
        rows.append((1000 + k, " ".join(v if j != k % 50 else f"x{k}" for j, v in enumerate(variants))))
    long = [f"l{k}" for k in range(150)]
    for k in range(24):  # around the similarity, with the larger sketch and beside shorter sets
        changed = set(rng.sample(range(150), (1, 5, 15, 17, 30)[k % 5]))
        words_ = [w if j not in changed else f"y{k}-{j}" for j, w in enumerate(long)]
        rows.append((1500 + k, " ".join(words_[: 150 - 60 * (k % 7 == 6)])))
    rows.append((1600, " ".join(long[:95])))
    rows.append((1601, " ".join(long[:100])))
    rows += [(2000, ""), (2001, None), (2002, "\n\n  \n"), (2003, "alone"), (2004, "alone\n\nalone again"), (2005, "z " * 60_000)]
    return rows


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_equals_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", broadcast)
    rows = corpus(2)
    rows += [rows[3], (None, rows[7][1] + "\nlast line of all")]
    want = brute(rows)
    df = spark.createDataFrame([(i, t, i, "k") for i, t in rows], "doc_id long, text string, no long, n_lines string")
    got = line_dedup.dedup_lines(df.repartition(3), counts=True)
    assert got.columns == ["doc_id", "text", "no", "n_lines", "n_removed"]
    collected = got.collect()
    assert len(collected) == len(rows)
    for r in collected:
        if r.doc_id == 2001:
            assert r.text is None and r.n_lines == r.n_removed == 0
        else:
            assert (r.doc_id, r.text, r.n_lines, r.n_removed) == want[r.doc_id]
    assert line_dedup.dedup_lines(df).columns == df.columns


def test_given_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    got = line_dedup.dedup_lines(df, counts=True).select("doc_id", "text", "n_lines", "n_removed").collect()
    assert {r.doc_id: tuple(r) for r in got} == want
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = line_dedup.dedup_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan


def test_variants_that_the_earliest_does_not_remove(spark, monkeypatch):
    """Many variants resemble some earlier one, few the first: a set leaves with the first that removes it."""
    rng = random.Random(5)
    line = [f"v{k}" for k in range(40)]
    rows = []
    for i in range(500):
        changed = set(rng.sample(range(40), 3))
        rows.append((i, " ".join(w if j not in changed else f"c{j}-{rng.randrange(12)}" for j, w in enumerate(line))))
    rounds, stored = [], line_dedup.stored

    def watched(df, name):
        out = stored(df, name)
        if name == "pairs":
            rounds.append(([(r.k1, r.turn) for r in out.select("k1", "turn").collect()], []))
        if name == "lost":
            rounds[-1][1].append({r.k1 for r in out.collect()})
        return out

    monkeypatch.setattr(line_dedup, "stored", watched)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.dedup_lines(df, counts=True).collect()
    want = brute(rows)
    assert {r.doc_id: (r.doc_id, r.text, r.n_lines, r.n_removed) for r in got} == want
    assert 100 < sum(r.n_removed for r in got) < 499
    verified = candidates = removed = 0
    for pairs, lost in rounds:
        gone, lost_once = set(), set().union(*lost)
        removed += len(lost_once)
        for (low, high), beaten in zip(((1, 1), (2, 4), (5, 16), (17, 10**9)), lost):
            verified += sum(low <= turn <= high and k1 in lost_once - gone for k1, turn in pairs)
            gone |= beaten
        candidates += sum(k1 in lost_once for k1, _ in pairs)
    assert removed <= verified < candidates / 2


def test_words_and_pairs_are_made_once(spark, monkeypatch):
    """No plan makes the words of all lines, or the candidate pairs, a second time."""
    plans, kinds, stored = [], [], line_dedup.stored

    def watched(df, name):
        if name == "words":
            kinds.append({c: kind for c, kind in df.dtypes if c not in ("k1", "place", "key")})
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return stored(df, name)

    monkeypatch.setattr(line_dedup, "stored", watched)
    rows = corpus(4) + [(3000, "tab\tword\rother\x0bwords  here\x0cend"), (3001, " end tab word here other words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.dedup_lines(df, counts=True).collect()
    want = brute(rows)
    assert {r.doc_id: (r.doc_id, r.text, r.n_lines, r.n_removed) for r in got if r.doc_id != 2001} == {i: w for i, w in want.items()}
    named = lambda name: [plan for n, plan in plans if n == name]
    assert all(plan.count("sort_array(") == 1 for plan in named("lines")) and named("lines")
    assert named("pairs") and not any("Union" in plan for plan in named("pairs"))
    # Sets travel to their verification as one line each, not as an array of words.
    assert kinds and all(kind == {"line": "string", "n": "int"} for kind in kinds)
