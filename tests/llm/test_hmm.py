import itertools
import math
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotelens.llm import hmm
from quotelens.llm.text import lower_words, remainder


def chain(states=3, classes=4, seed=0):
    rng = np.random.default_rng(seed)
    emit = rng.random((classes, states))
    move = rng.random((states, states))
    return hmm.Chain(
        np.array([0.5, 0.3, 0.2]),
        move / move.sum(1, keepdims=True), emit / emit.sum(0),
    )


def paths(model, sequence):
    """Every state path with its joint probability."""
    for path in itertools.product(range(len(model.start)), repeat=len(sequence)):
        p = model.start[path[0]] * model.emit[sequence[0], path[0]]
        for t in range(1, len(path)):
            p *= model.move[path[t - 1], path[t]] * model.emit[sequence[t], path[t]]
        yield path, p


SEQUENCES = [np.array(s) for s in ([0, 1, 2], [3], [1, 1, 2, 0, 3], [2, 0])]


def test_forward_equals_the_sum_over_all_paths():
    model = chain()
    found = hmm.log10_likelihood(model, SEQUENCES)
    for sequence, value in zip(SEQUENCES, found):
        assert value == pytest.approx(math.log10(sum(p for _, p in paths(model, sequence))))


@pytest.mark.parametrize("segment", [1, 2, 3, 100])
def test_expected_counts_equal_the_sum_over_all_paths(segment):
    model = chain()
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
    for sequence in SEQUENCES:
        whole = sum(p for _, p in paths(model, sequence))
        for path, p in paths(model, sequence):
            start[path[0]] += p / whole
            for a, b in zip(path, path[1:]):
                move[a, b] += p / whole
            for word, state in zip(sequence, path):
                emit[word, state] += p / whole
    want = np.concatenate([start[None], move, emit])
    assert np.allclose(hmm.expected_counts(model, SEQUENCES, segment), want)
    found = hmm.log10_likelihood(model, SEQUENCES, segment)
    assert np.allclose(found, [math.log10(sum(p for _, p in paths(model, s))) for s in SEQUENCES])


def test_pieces_of_a_long_text_give_the_counts_of_the_whole(monkeypatch):
    rng, model = np.random.default_rng(5), chain(classes=50, seed=2)
    data = [rng.integers(0, 50, n) for n in (5_000, 1, 700, 64, 65, 3)]
    whole = hmm.expected_counts(model, data, 10_000)
    monkeypatch.setattr(hmm, "TOKENS", 900)  # several blocks of pieces
    for segment in (7, 64, 512):
        assert np.allclose(hmm.expected_counts(model, data, segment), whole)
        assert np.allclose(hmm.log10_likelihood(model, data, segment), hmm.log10_likelihood(model, data, 10_000))
    assert whole[1:4].sum() == pytest.approx(sum(len(s) - 1 for s in data))  # no transition is left out
    assert whole[4:].sum() == pytest.approx(sum(map(len, data)))


def test_a_very_long_text_takes_steps_of_a_piece_not_of_the_text():
    rng, model = np.random.default_rng(5), chain(classes=50, seed=2)
    text = rng.integers(0, 50, 1_000_000)
    began = time.monotonic()
    counts = hmm.expected_counts(model, [text])
    assert counts[4:].sum() == pytest.approx(len(text)) and time.monotonic() - began < 20


def test_baum_welch_never_loses_likelihood():
    rng = np.random.default_rng(3)
    data = [rng.choice(6, 40, p=np.eye(6)[rng.integers(6)] * 0.7 + 0.05) for _ in range(60)]
    tokens = np.bincount(np.concatenate(data), minlength=6).astype(float)
    model, seen = hmm.Chain.initial(tokens, 3, 0), []
    for _ in range(6):
        seen.append(hmm.log10_likelihood(model, data).sum())
        counts = hmm.expected_counts(model, data)
        model = hmm.Chain.from_counts(counts, tokens)
    assert all(b > a - 2 for a, b in zip(seen, seen[1:])) and seen[-1] > seen[0] + 50


TEXTS = {i: t for i, t in enumerate(
    ["The cat sat", "the Cat ran ran", None, "", "der hund lief", "Der Hund saß  da\n\tund lief",
     "the hound ran", "unseen words only", "le chien", "the the the", "ÉTÉ été", "cat " * 3_000]
)}


@pytest.mark.parametrize("held", [0, 3, 10_000])
def test_scores_equal_brute_force_whatever_is_in_memory(spark, held):
    rows = [*TEXTS.items(), (None, "the cat"), (1, TEXTS[1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    df = df.selectExpr("*", "1 AS row", "2 AS c", "3 AS base")
    settings = {"own": 4, "groups": 3, "held": held}
    out = hmm.score_texts(
        df, remainder("doc_id", 7) == 2, vocabulary=settings, states=2, rounds=2, segment=4
    ).collect()
    train = [lower_words(t or "") for i, t in rows if zlib.crc32(str(i or "").encode()) % 7 != 2]
    counts = Counter(w for words in train for w in words)
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    assert len(out) == len(rows) and {r["train_tokens"] for r in out} == {n}
    for r in out:
        words = lower_words(TEXTS.get(r["doc_id"], "the cat") or "")
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        base += math.log10((len(train) + 1) / (n + v + 1))
        assert r["base_score"] == pytest.approx(base)
        assert r["n_known"] == 1 + sum(counts[w] > 0 for w in words)
        assert r["n_tokens"] == 1 + len(words)
        assert r["score"] < 0


def test_probabilities_of_short_texts_sum_to_less_than_one(spark):
    train = [(i, t) for i, t in enumerate(["a b", "b a c", "c", "a a", "", "d b"] * 3)]
    known = ["a", "b", "c", "d", "new"]
    every = ["", *known, *(f"{x} {y}" for x in known for y in known)]
    rows = [(i, t, False) for i, t in train] + [(100 + i, t, True) for i, t in enumerate(every)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, out boolean")
    scored = hmm.score_texts(
        df, F.col("out"), vocabulary={"own": 2, "groups": 2}, states=2, rounds=3
    ).filter("held_out")
    scores = [r["score"] for r in scored.collect()]
    assert len(scores) == len(every) and 0.5 < sum(10**s for s in scores) < 1


def test_no_rows_and_no_training_rows(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert hmm.score_texts(df, F.lit(False), rounds=1).collect() == []
    one = spark.createDataFrame([(1, "word")], "doc_id bigint, text string")
    (row,) = hmm.score_texts(one, F.lit(True), rounds=1).collect()
    assert (row["n_known"], row["train_tokens"], row["base_score"]) == (0, 0, 0.0)


@pytest.mark.parametrize("spread, code", [(1, "<u2"), (20_000, "<u4")])
def test_classes_follow_the_vocabulary(spark, spread, code):
    rows = [(i, f"w{i % 9} x{i}", i > 80) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, out boolean")
    words = hmm.Vocabulary(df.filter("NOT out").select("text"), spread=spread)
    assert (words.own, words.code) == (math.ceil(spread * math.sqrt(90)) + 1, code)
    scored = hmm.score_texts(df, F.col("out"), vocabulary={"spread": spread}, states=2, rounds=2).collect()
    assert len(scored) == 90 and all(r["score"] < 0 for r in scored)


def test_words_and_counts_are_those_of_whole_texts(spark):
    """Arrow's words against the plain ones, and counts over batches that are cut and flushed."""
    import random

    import pyarrow as pa

    rng = random.Random(5)
    chars = [chr(i) for i in range(128)] + list("éÜß\u0085 　漢𝒳")
    texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 30))) for _ in range(500)] + ["", " ", "a" * 99]
    words, lengths = hmm._words(pa.array(texts))
    plain = [lower_words(t) for t in texts]
    assert [w.encode() for w in words.to_pylist()] == [w for found in plain for w in found]
    assert lengths.tolist() == [len(found) for found in plain]
    batch = pa.record_batch([pa.array(texts)], ["text"])
    parts = list(hmm._parts(batch, 0, 100))
    assert len(parts) > 50 and pa.Table.from_batches(parts)["text"].to_pylist() == texts
    assert list(hmm._parts(batch.slice(0, 0), 0)) == []
    counted = hmm.count_words(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    assert {r["word"].encode(): r["c"] for r in counted.collect()} == Counter(w for found in plain for w in found)


def test_only_pieces_between_others_need_a_matrix(monkeypatch):
    rng = np.random.default_rng(1)
    model, found = chain(), []
    sequences = [rng.integers(0, 4, n) for n in (5, 10, 11, 20, 31)]
    whole = hmm.expected_counts(model, sequences, 100), hmm.log10_likelihood(model, sequences, 100)
    across = hmm._across
    monkeypatch.setattr(hmm, "_across", lambda c, pieces: found.append(len(pieces)) or across(c, pieces))
    monkeypatch.setattr(hmm, "TOKENS", 15)
    assert np.allclose(hmm.expected_counts(model, sequences, 10), whole[0])
    assert sum(found) == 2
    assert np.allclose(hmm.log10_likelihood(model, sequences, 10), whole[1])
