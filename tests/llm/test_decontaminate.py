import random

import numpy as np
import pyarrow as pa
import pytest

from quotelens.llm import decontaminate
from quotelens.llm.decontaminate import GAP, MATCH, MISMATCH, align

VOCABULARY = [f"w{i}" for i in range(300)]


def slow_align(item, passage):
    h = np.zeros((len(item) + 1, len(passage) + 1), int)
    for i in range(1, len(item) + 1):
        for j in range(1, len(passage) + 1):
            step = MATCH if item[i - 1] == passage[j - 1] else MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + step, h[i - 1, j] + GAP, h[i, j - 1] + GAP)
    return int(h.max())


def test_alignment_equals_the_full_table():
    rng = np.random.default_rng(0)
    for _ in range(200):
        item, passage = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(0, 20))
        score, end = align(item, passage)
        assert score == slow_align(item, passage)
        assert slow_align(item, passage[:end]) == score


def edited(words, rng, rate):
    """Words with substitutions, deletions and insertions."""
    out = []
    for w in words:
        kind = rng.random()
        if kind < rate / 3:
            continue
        out.append(rng.choice(VOCABULARY) if kind < 2 * rate / 3 else w)
        if 2 * rate / 3 < kind < rate:
            out.append(rng.choice(VOCABULARY))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(1)
    prose = lambda n: [rng.choice(VOCABULARY) for _ in range(n)]
    items = {i: prose(30) for i in range(8)}
    planted, documents = {}, {}
    for i in range(120):
        body = prose(rng.randrange(200))
        if i % 3 == 0:
            item = i % 8
            copy = edited(items[item], rng, 0 if i % 2 else 0.2)
            at = rng.randrange(len(body) + 1)
            body[at:at] = copy
            planted[i] = item
        documents[i] = " ".join(body).capitalize()
    documents[20] = " ".join(items[1] + prose(60_000) + items[2])  # very long
    planted[20] = 1
    rows = [*documents.items(), (None, " ".join(items[3])), (500, None), (501, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    bench = [(i, ", ".join(w).upper()) for i, w in items.items()] + [(90, None), (91, " . "), (92, "zz yy")]
    return docs, spark.createDataFrame(bench, "item_id bigint, text string"), planted


@pytest.mark.parametrize("block_chars", [10**6, 300])
def test_exact_and_edited_copies_are_found_and_nothing_else(tables, block_chars):
    docs, bench, planted = tables
    out = decontaminate.contaminated(docs.selectExpr("*", "1 AS item_id", "2 AS score"), bench,
                                     block_chars=block_chars).collect()
    found = {(r["doc_id"], r["item_id"]) for r in out}
    assert found == {*planted.items(), (20, 2), (None, 3)} and len(out) == len(found)
    texts = {r["doc_id"]: decontaminate.plain_words(r["text"] or "") for r in docs.collect()}
    items = {r["item_id"]: decontaminate.plain_words(r["text"] or "") for r in bench.collect()}
    for r in out:
        span = texts[r["doc_id"]][r["start_word"] : r["end_word"]]
        assert r["score"] == slow_align(items[r["item_id"]], span) / (MATCH * len(items[r["item_id"]]))


def test_rows_with_an_item_are_dropped(tables):
    docs, bench, planted = tables
    kept = decontaminate.drop_contaminated(docs.selectExpr("text", "'x' AS more", "doc_id"), bench)
    assert kept.columns == ["text", "more", "doc_id"]
    want = {r["doc_id"] for r in docs.collect()} - {*planted, None}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)


def test_items_copied_everywhere_and_short_items(spark):
    docs = spark.createDataFrame([(i, "alpha beta gamma delta epsilon") for i in range(40)] * 2,
                                 "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon"), (2, "delta epsilon"), (2, "delta epsilon")],
                                  "item_id bigint, text string")
    assert decontaminate.contaminated(docs, bench).count() == 80 * 3


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert decontaminate.contaminated(docs.limit(0), bench).collect() == []
    assert decontaminate.contaminated(docs, bench.limit(0)).collect() == []
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == 1


@pytest.mark.parametrize("exact_copies", [0, 3])
@pytest.mark.parametrize("n", [16, 40])
def test_every_fourth_word_replaced(spark, n, exact_copies):
    item = [f"i{i}" for i in range(n)]
    copy = " ".join(f"x{i}" if i % 4 == 3 else w for i, w in enumerate(item))
    rows = [(0, copy)] + [(i + 1, " ".join(item)) for i in range(exact_copies)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    found = {r["doc_id"]: r["score"] for r in decontaminate.contaminated(docs, bench).collect()}
    words = decontaminate.plain_words
    assert found[0] == slow_align(words(" ".join(item)), words(copy)) / (MATCH * n) > 0.5
    assert len(found) == 1 + exact_copies
    assert decontaminate.drop_contaminated(docs, bench).count() == 0


@pytest.mark.parametrize("n", [12, 24, 48])
def test_every_third_word_replaced(spark, n):
    item = [f"i{i}" for i in range(n)]
    copy = [f"x{i}" if i % 3 == 2 else w for i, w in enumerate(item)]
    docs = spark.createDataFrame([(1, " ".join(["before"] * 40 + copy + ["after"] * 40))], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    (found,) = decontaminate.contaminated(docs, bench).collect()
    assert found["score"] == slow_align(item, copy) / (MATCH * n) >= 0.5


def test_quotas_make_sure_of_a_seed():
    """For any set of kept words and any errors that the threshold allows."""
    rng = random.Random(4)
    for _ in range(4_000):
        n = rng.randrange(1, 40)
        need = decontaminate.needed(n, 0.5)
        words, pairs = decontaminate.quotas(n, 0.5)
        kept, parted = [i for i in range(n) if rng.random() < 0.8], rng.random() < 0.3
        runs = sum(1 for a, b in zip([-2, *kept], kept) if b != a + 1 or parted)
        if MATCH * len(kept) - max(runs - 1, 0) < need:
            continue
        held = set() if parted else {i for i in kept if i + 1 in kept}
        assert n - len(kept) < words or (pairs and n - 1 - len(held) < pairs)


def test_recall_is_that_of_aligning_all_pairs(spark):
    """Common words, repeated words, and copies with every kind of edit around the threshold."""
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(60)]
    items = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 7, 12, 20]))] for _ in range(12)] + [["v1"] * 9]
    texts = []
    for _ in range(150):
        body = [rng.choice(vocabulary) for _ in range(rng.randrange(40))]
        copy = edited(rng.choice(items), rng, rng.choice([0.2, 0.6, 0.9, 1.2]))
        if rng.random() < 0.3:
            copy = [x for w in copy for x in (w, "odd")]
        body[len(body) // 2 : len(body) // 2] = copy
        texts.append(body)
    want = {
        (d, i)
        for d, words in enumerate(texts)
        for i, item in enumerate(items)
        if slow_align(item, words) >= decontaminate.needed(len(item), 0.5)
    }
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(texts)], "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id bigint, text string")
    found = decontaminate.contaminated(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want and len(found) == len(want) > 100
    for r in found:
        assert r["score"] * MATCH * len(items[r["item_id"]]) == slow_align(items[r["item_id"]], texts[r["doc_id"]])


def test_items_beyond_a_broadcast(spark, tables, monkeypatch):
    docs, bench, planted = tables
    monkeypatch.setattr(decontaminate, "fits", lambda *_: None)
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()}
    assert found == {*planted.items(), (20, 2), (None, 3)}


def test_each_task_has_one_python_worker(tables):
    """Workers stay with their executor, so a second one in a row takes its memory to the end of the job."""
    docs, bench, _ = tables
    found = decontaminate.contaminated(docs, bench)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_texts_cross_to_python_in_slices(monkeypatch):
    texts = pa.array(["a", "", "b c", None, "d"])
    for rows in (1, 2, 5, 9):
        monkeypatch.setattr(decontaminate, "SLICE", rows)
        assert list(decontaminate._texts(texts)) == texts.to_pylist()


def test_texts_looked_up_together_are_those_alone(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choices("a b c d e".split(), k=rng.randint(0, 9))) for _ in range(200)] + ["", "!"]
    known = np.unique(np.concatenate([g for t in texts[:3] for g in decontaminate._hashes(decontaminate.plain_words(t))]))
    marks = decontaminate._bitmap(known)
    alone = [[decontaminate._find(g, known, marks) for g in decontaminate._hashes(decontaminate.plain_words(t))] for t in texts]
    monkeypatch.setattr(decontaminate, "TOGETHER", 100)
    got = []
    for lists in decontaminate._together(texts):
        assert len(lists) == 1 or sum(map(len, texts[len(got) : len(got) + len(lists)])) <= 100
        one, ends, hits = decontaminate._found(lists, known, marks)
        for k in range(len(lists)):
            assert list(one[ends[k] : ends[k + 1]]) == list(decontaminate._hashes(lists[k])[0])
            got.append([(p[r == k] - ends[k], w[r == k]) for p, w, r in hits])
    assert len(got) == len(texts)
    for a, b in zip(alone, got):
        assert [[list(x) for x in pair] for pair in a] == [[list(x) for x in pair] for pair in b]
