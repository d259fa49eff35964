"""Conversation repair against all edit sequences."""

import hashlib
import itertools
import random
import zlib

import pytest

from canton.llm import dialogs as D

SCHEMA = "conv_id long, turn long, role string, text string, gone int, cut string"
WHITE = " \t\n\v\f\r"


def hurt(rows):
    """Conversations with their damaged rows; NULLs as one space in keys, roles and texts."""
    out = {}
    for conv, turn, role, text in rows:
        say = lambda x: " " if x is None else str(x)
        fault = zlib.crc32(f"{say(conv)}:{say(turn)}".encode()) % 20
        role, text = say(role), say(text)
        kept = out.setdefault(conv, [])
        if fault == 1:
            text = ""
        elif fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif fault == 4:
            role = "user"
        kept += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def legal(initials):
    rest = initials[1:] if initials[:1] == "s" else initials
    return not initials or (rest != "" and rest == "ua" * (len(rest) // 2))


def repairs(rows, costs):
    """(cost, audit, repaired rows) of every edit sequence with at most two inserts a gap."""
    gaps = [()] + [(x,) for x in "ua"] + [(x, y) for x in "ua" for y in "ua"]
    kinds = [[("D",)] if gone else [("D",), ("K",), ("R", "user"), ("R", "assistant")] for _, _, gone, _ in rows]
    for edits in itertools.product(*kinds):
        base = sum({"D": costs.delete, "K": 0, "R": costs.rerole}[e[0]] for e in edits)
        base += sum(costs.truncated for e, r in zip(edits, rows) if e[0] != "D" and r[3])
        for fills in itertools.product(gaps, repeat=len(rows) + 1):
            audit, said = "", []
            for i, fill in enumerate(fills):
                audit += "I" * len(fill)
                said += [(D.NAMES[x], "") for x in fill]
                if i < len(rows):
                    role, text = rows[i][:2]
                    audit += edits[i][0]
                    if edits[i][0] != "D":
                        said.append((edits[i][1] if edits[i][0] == "R" else role, text))
            if legal("".join(r[:1] or "-" for r, _ in said)):
                yield base + costs.insert * audit.count("I"), audit, said


def brute(rows, costs=D.Costs()):
    out = []
    for conv, turns in hurt(rows).items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        judged = []
        for i, (_, role, text) in enumerate(turns):
            fault = None
            if not text.strip(WHITE):
                fault = "blank"
            elif (role, text) in [t[1:] for t in turns[:i]]:
                fault = "duplicate"
            elif text.rstrip(WHITE)[-1] not in ".!?":
                fault = "truncated"
            if fault:
                counts[fault] += 1
            judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        numbers = {t for t, _, _ in turns if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        cost, audit, said = min(repairs(judged, costs), key=lambda x: x[:2])
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def conversations(seed, most, n):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?\n ", "so it", "", " \t", "Ä ö?", "Yes."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, ""]
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, most)):
            at = rng.choice([turn, turn, turn, turn + 2, None])
            rows.append((conv, at, rng.choice(roles), rng.choice([*texts, None])))
    return rows


@pytest.mark.parametrize(
    "costs", [D.Costs(), D.Costs(insert=1), D.Costs(rerole=2, delete=3, insert=2, truncated=1), D.Costs(rerole=4, delete=4, insert=3)]
)
def test_equals_all_edit_sequences(spark, costs):
    rows = conversations(3, 3, 14) + [(None, 1, "user", "Hi."), (None, 2, "user", "Hi."), (-5, None, None, None)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = [tuple(r) for r in D.repair_conversations(D.damage(df.repartition(3)), costs).collect()]
    # Turns that are at once NULL or repeated stand by role and text, as in brute().
    assert sorted(got, key=repr) == brute(rows, costs)


def test_empty_and_all_dropped(spark):
    assert D.repair_conversations(D.damage(spark.createDataFrame([], SCHEMA))).count() == 0
    conv = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(conv, 0, "user", "Hi.", 1, "x")], SCHEMA)
    (row,) = D.repair_conversations(D.damage(df)).collect()
    assert tuple(row) == (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def naive(rows, costs):
    """The same minimum over tuples (cost, audit) without inserts, for long conversations."""
    best = {0: (0, "", [])}
    for role, text, gone, cut in rows:
        new = {}
        for state, (cost, audit, said) in best.items():
            options = [(state, cost + costs.delete, audit + "D", said)]
            if not gone:
                late = costs.truncated * cut
                if role[:1] in D.NEXT[state]:
                    options.append((D.NEXT[state][role[:1]], cost + late, audit + "K", [*said, (role, text)]))
                for i, name in D.NAMES.items():
                    if i in D.NEXT[state]:
                        options.append((D.NEXT[state][i], cost + late + costs.rerole, audit + "R", [*said, (name, text)]))
            for to, *value in options:
                if to not in new or tuple(value[:2]) < new[to][:2]:
                    new[to] = tuple(value)
        best = new
    cost, audit, said = min((best[s] for s in D.ENDS if s in best), key=lambda x: x[:2])
    return cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()


def test_long_conversations_fold_their_digits(monkeypatch):
    rng = random.Random(9)
    for fold, n in ((2, 60), (3, 200), (7, 500), (256, 1500)):
        monkeypatch.setattr(D, "FOLD", fold)
        rows = [
            (rng.choice(["user", "assistant", "system", "x"]), f"t{i}.", rng.random() < 0.1, rng.random() < 0.1) for i in range(n)
        ]
        repair = D.Repair(D.Costs())
        for r in rows:
            repair.add(*r)
        assert repair.result() == naive(rows, D.Costs())
        assert max(w for w, _, _ in repair.layers[0].values()).bit_length() <= 3 * (fold + 1) + 16


def test_long_conversation_in_bounded_state(spark):
    """20,000 turns of one conversation, read as one sorted pass."""
    df = spark.range(20_000).selectExpr(
        "7L AS conv_id", "id AS turn", "CASE id % 3 WHEN 0 THEN 'user' ELSE 'assistant' END AS role", "concat('t', id % 9000, '.') AS text"
    )
    (row,) = D.repair_conversations(df).collect()
    assert len(row["audit"]) == 20_000 and row["duplicate"] == 11_000 and row["gaps"] == 0
