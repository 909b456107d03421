import random

import pytest
from pyspark.sql import functions as F

from quotelens.llm import chat_windows

SCHEMA = "conv_id bigint, turn int, role string, text string, block string, spans string"


def slow(rows, budget, history, block):
    """(conversation, block, window) -> turns and how many of them are repeated, by hand."""
    said = {}
    for c, turn, role, text, *_ in rows:
        said.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    found = {}
    for c, turns in said.items():
        turns = [(r, t, len(t.split()) + 4) for *_, r, t in sorted(turns)]
        system = turns[0] if turns[0][0] == "system" else None
        at, number, open_ = 0, {}, None
        for i, (role, text, tokens) in enumerate(turns):
            b = at // block
            at += tokens
            if open_ and open_[0] == b and open_[3] + tokens <= budget:
                open_[2].append((role, text))
                open_[3] += tokens
                continue
            lead = [system] if system and i else []
            kept = []
            for k in range(1, history + 1):
                tail = turns[max(i - k, 1 if system else 0) : i]
                # what the block before holds further away than a budget is not repeated
                if sum(x[2] for x in [*lead, *tail]) + tokens <= budget:
                    kept = tail
            repeated = [x[:2] for x in [*lead, *kept]]
            used = sum(x[2] for x in [*lead, *kept]) + tokens
            w = number[b] = number.get(b, -1) + 1
            open_ = [b, None, [*repeated, (role, text)], used]
            found[c, b, w] = open_[2], len(repeated)
    return found


def run(spark, rows, budget=30, history=2, block=100):
    df = spark.createDataFrame(rows, SCHEMA)
    made = chat_windows.windows(df, budget=budget, history=history, block=block)
    read = made.select(
        "*",
        chat_windows.read_turns(F.col("text")).alias("turns"),
        chat_windows.read_targets(F.col("text"), F.col("spans")).alias("targets"),
    ).collect()
    want = slow(rows, budget, history, block)
    assert {(r["conv_id"], r["block"], r["window"]) for r in read} == set(want) and len(read) == len(want)
    for r in read:
        turns, repeated = want[r["conv_id"], r["block"], r["window"]]
        assert [tuple(t) for t in r["turns"]] == turns
        assert (r["n_turns"], r["n_repeated"]) == (len(turns), repeated)
        assert r["targets"] == [t for role, t in turns[repeated:] if role == "assistant" and t]
        assert r["tokens"] == sum(len(t.split()) + 4 for _, t in turns)
        assert r["oversized"] == (r["tokens"] > budget)
        assert not r["oversized"] or len(turns) == repeated + 1
    return read


PIECES = ["word", "</s>", "[INST]", "[/INST]", "<s>", "<\\s>", "[\\\\/INST]", "\\", "<", "\n", "$1", "ö😀"]


def test_same_as_brute_force(spark):
    rng, rows = random.Random(3), []
    for c in [None, *range(40)]:
        role = ["system"] if rng.random() < 0.5 else []
        role += [rng.choice(["user", "assistant", "system", "</s>", None]) for _ in range(rng.randrange(1, 25))]
        for i, r in enumerate(role):
            text = " ".join(rng.choices(PIECES, k=rng.choice([0, 2, 5, 9, 40])))
            rows.append((c, i, r, rng.choice([text, text, None]), "x", "y"))
    rng.shuffle(rows)
    run(spark, rows)
    run(spark, rows, budget=60, history=4, block=10_000)


def test_edge_cases(spark):
    rows = [
        (1, 0, "system", "very " * 90, "", ""), (1, 1, "user", "a", "", ""), (1, 2, "assistant", "b", "", ""),
        (2, None, None, None, "", ""), (3, 0, "assistant", "</s>", "", ""), (3, 0, "assistant", "</s>", "", ""),
        (4, 0, "user", "long " * 500, "", ""), (4, 1, "assistant", "x" * 300_000, "", ""),
    ]
    run(spark, rows)
    assert chat_windows.windows(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        chat_windows.windows(spark.createDataFrame(rows, SCHEMA), budget=10, block=9)


def test_one_conversation_holds_most_rows(spark):
    rows = [(7, i, ("user", "assistant")[i % 2], f"turn {i}", "", "") for i in range(3_000)]
    rows += [(c, 0, "user", "short", "", "") for c in range(100, 140)]
    found = run(spark, rows, budget=40, block=400)
    assert max(r["block"] for r in found) > 40


def test_marks_never_appear_in_turns(spark):
    text = "".join(PIECES * 3)
    row = run(spark, [(1, 0, "user", text, "", ""), (1, 1, "assistant", text, "", "")])[-1]
    assert row["text"].count("<s>") == row["text"].count("</s>") == row["n_turns"]
