import zlib

import numpy as np
import pytest

from quotelens.llm import quality

WORDS = "the house of many rooms stood near water and trees where people walked in the evening".split()


def good(rng, n):
    return " ".join(rng.choice(WORDS, n))


def bad(rng, n):
    return " ".join(w + "***" for w in rng.choice(WORDS, n))


def corpus(seed, count):
    """Documents; bad ones have one bad passage among good ones."""
    rng, rows = np.random.default_rng(seed), []
    for i in range(count):
        parts = [good(rng, 64) for _ in range(rng.integers(1, 5))]
        label = int(rng.random() < 0.7)
        if not label:
            parts[rng.integers(len(parts))] = bad(rng, 64)
        rows.append((i, " ".join(parts), label))
    return rows


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    model = quality.fit([], [], hidden=5, attention=3, seed=1)
    model["score"] = rng.normal(size=5)
    x, starts = rng.normal(size=(7, quality.WIDTH)) / 5, np.array([0, 2, 3])
    target = np.array([1.0, 0.0, 0.3])

    def loss(model):
        p = quality._forward(model, x, starts)[5]
        fit = -(target * np.log(p) + (1 - target) * np.log(1 - p)).mean()
        return fit + 0.5e-4 * (model["encode"] ** 2).sum()

    for name, gradient in quality._gradients(model, x, starts, target).items():
        flat = np.atleast_1d(np.asarray(model[name]))
        for place in list(np.ndindex(flat.shape))[:: max(1, flat.size // 7)]:
            moved = {s: np.array(flat, float) for s in (1, -1)}
            for s in moved:
                moved[s][place] += s * 1e-5
            values = [loss(model | {name: m.reshape(np.shape(model[name]))}) for m in moved.values()]
            want = (values[0] - values[1]) / 2e-5
            assert np.atleast_1d(gradient)[place] == pytest.approx(want, abs=1e-6)


def test_learns_from_document_labels_which_passage_is_bad(spark):
    rows = corpus(1, 400)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id bigint, quality int")
    docs = docs.selectExpr("*", "1 AS quality", "2 AS target", "3 AS score")
    out = {r["doc_id"]: r["score"] for r in quality.score_documents(docs, labels, held_fold=0).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert np.mean([(out[i] >= 0.5) == bool(q) for i, _, q in held]) > 0.95


def test_held_out_labels_are_not_read(spark):
    rows = corpus(2, 60)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, _, q in rows]
    models = [
        quality.train(docs, spark.createDataFrame(pairs, "doc_id bigint, quality int"))
        for pairs in ([(i, q) for i, _, q in rows], turned)
    ]
    assert all(np.array_equal(models[0][k], models[1][k]) for k in models[0])


def test_fit_takes_whole_texts_within_its_bounds(spark, monkeypatch):
    rng, held = np.random.default_rng(5), []
    texts = {i: good(rng, 64 * n) for i, n in enumerate([3, 1, 90, 2, 4, 1, 7, 2])}
    docs = spark.createDataFrame([*texts.items(), (1, texts[1])], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id bigint, quality int")
    monkeypatch.setattr(quality, "fit", lambda bags, targets: held.append((bags, targets)))
    used = [i for i in texts if zlib.crc32(str(i).encode()) % 5]
    bags = {i: quality.encode_passages(texts[i], 64) for i in used}
    for limit in (100_000, 20, 3):
        quality.train(docs, labels, sample_passages=limit)
        got, targets = held.pop()
        assert sum(map(len, got)) <= limit
        ids = [next(i for i in used if np.array_equal(bags[i], g)) for g in got]  # none is cut
        assert ids == sorted(ids) and targets == [float(i % 2) for i in ids]
        left = limit - sum(map(len, got))
        assert all(len(bags[i]) > left for i in used if i not in ids)
    assert 2 in used and len(bags[2]) == 90


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "a"), (4, "word " * 200_000), (5, " \n ")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for pairs in ([], [(3, 1), (3, 0), (4, None)], [(1, 1), (2, 1), (3, 1), (4, 1)]):
        labels = spark.createDataFrame(pairs, "doc_id bigint, quality int")
        out = quality.score_documents(docs, labels).collect()
        assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
        by_text = {}
        for r in out:
            by_text.setdefault((r["text"] or "").strip(), set()).add(r["score"])
        assert all(len(s) == 1 for s in by_text.values())
        if not pairs:
            assert {r["score"] for r in out} == {0.5}
    assert quality.score_documents(docs.limit(0), labels.limit(0)).collect() == []


def test_long_texts_score_as_in_small_blocks():
    rng = np.random.default_rng(4)
    x = quality.encode_passages(good(rng, 200), 64)
    assert x.shape == (4, quality.WIDTH)
    assert np.array_equal(quality.encode_passages("", 64), quality.encode_passages(" \n", 64))
