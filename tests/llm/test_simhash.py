import itertools
import random

import numpy as np
import pytest
import xxhash

from quotelens.llm import graph, simhash
from quotelens.llm.text import lower_words
from quotelens.session import settle


def slow_fingerprint(text, shingle=4, seed=42):
    words = [w.decode() for w in lower_words(text)]
    if not words:
        return 0
    runs = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(r, seed) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, radius=4):
    """Smallest index reachable for each value."""
    f = np.array(values, np.uint64)
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= radius
    label = np.arange(len(f))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label.tolist()
        label = new


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4])
def test_masks_cover_every_pair_within_the_radius(radius):
    masks, rng = [m % (1 << 64) for m in simhash.masks(radius)], random.Random(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    chosen = itertools.combinations(range(64), radius) if radius < 3 else (
        rng.sample(range(64), radius) for _ in range(20_000)
    )
    for bits in chosen:
        change = sum(1 << b for b in bits)
        assert any(change & m == 0 for m in masks)


def test_fingerprints(spark):
    rng = random.Random(0)
    texts = ["", "one", "A b\tc", "a b c d", None, "Été ÉTÉ " * 9, "w " * 70_000 + "end"]
    texts += [" ".join(rng.choice("the of and cat Dog".split()) for _ in range(n)) for n in (5, 80)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = [r[0] for r in df.select(simhash.hex16(simhash.simhash(df["text"]))).collect()]
    assert found == [f"{slow_fingerprint(t or ''):016x}" for t in texts]


def prints(spark, values, ids=None):
    rows = [(i, v - (1 << 64) if v >> 63 else v) for i, v in zip(ids or range(len(values)), values)]
    return spark.createDataFrame(rows, "doc_id bigint, f bigint").repartition(3)


def scattered(rng, balls):
    """Balls around random centres, chains of steps of up to 4 bits, repeats and loners."""
    flip = lambda v, n: v ^ sum(1 << b for b in rng.sample(range(64), n))
    values = [0, 0, 1 << 63, (1 << 64) - 1]
    for size in balls:
        centre = rng.getrandbits(64)
        values += [flip(centre, rng.randrange(6)) for _ in range(size)]
    for _ in range(10):
        values.append(rng.getrandbits(64))
        for _ in range(15):
            values.append(flip(values[-1], rng.choice([3, 4, 5])))
    rng.shuffle(values)
    return values


@pytest.mark.parametrize("piece", [2, 2_000])
def test_groups_equal_brute_force(spark, piece, monkeypatch):
    values = scattered(random.Random(1), [200, 60, 3, 2])
    whole = simhash.linked
    monkeypatch.setattr(simhash, "linked", lambda p, r: whole(p, r, piece))
    out = simhash.near_groups(prints(spark, values)).collect()
    want = brute_components(values)
    assert len(out) == len(values)
    assert {r["doc_id"]: r["component_id"] for r in out} == dict(enumerate(want))


def test_hot_keys_join_like_others(spark, monkeypatch):
    monkeypatch.setattr(graph, "HOT_KEYS", 4)
    values = [7] * 50 + [1 << 40 | 5] * 20 + scattered(random.Random(2), [5])
    out = simhash.near_groups(prints(spark, values)).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == dict(enumerate(brute_components(values)))


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 60)] + [(70, 70)]
    out = graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    roots = {r["node"]: r["root"] for r in out}
    assert roots == {i: 100 for i in range(101, 161)} | {i: 5 for i in range(6, 60)}
    empty = spark.createDataFrame([], "a bigint, b bigint")
    assert graph.components(empty).collect() == []


COPY = "one two three four five six seven eight nine ten eleven twelve"
ROWS = [(3, COPY), (2, COPY.upper()), (9, "other words stand in this text alone"), (4, None), (7, ""),
        (None, COPY), (9, "other words stand in this text alone"), (11, None)]


def test_documents(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string").selectExpr("*", "1 AS f", "2 AS n")
    out = simhash.near_duplicates(df).collect()
    groups = sorted((str(r["doc_id"]), r["component_id"]) for r in out)
    assert groups == [("11", 4), ("2", 2), ("3", 2), ("4", 4), ("7", 4), ("9", 9), ("9", 9), ("None", 2)]
    assert {r["fingerprint"] for r in out if r["doc_id"] in (4, 7, 11)} == {"0" * 16}
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 4, 9]
    alone = spark.createDataFrame([(None, "x y"), (None, "x y")], "doc_id bigint, text string")
    assert simhash.drop_near_duplicates(alone).count() == 1
    assert [r["component_id"] for r in simhash.near_duplicates(alone).collect()] == [None, None]
    assert simhash.near_duplicates(df.limit(0)).collect() == []
    assert simhash.drop_near_duplicates(df.limit(0)).collect() == []


def test_inlined_tables_are_not_broadcast(spark):
    """Spark sizes them like the fingerprints alone, which are few bytes."""
    stored = settle(prints(spark, range(100)).select("f"))
    plan = simhash._buckets(stored, 4)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_cold_keys_are_shuffled(spark):
    rows = settle(spark.range(100).selectExpr("id", "id % 7 AS f"))
    unique = settle(spark.range(7).selectExpr("id AS f", "id AS v", "10L AS n"))
    joined = graph.join_unique(rows, unique, "f", "n", 70_000)
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["v"] for r in joined.collect()) == sorted(i % 7 for i in range(100))
