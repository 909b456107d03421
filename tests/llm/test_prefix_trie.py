import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from quotelens.llm import prefix_trie

SCHEMA = "conv_id bigint, turn int, role string, text string, id string, turns string"


def slow(rows):
    """All nodes by hand, from (conversation, turn, role, text) rows without ties."""
    said = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            said[c].append((turn is not None, turn or 0, role or "", text or ""))
    return slow_trie({c: tuple((r, t) for *_, r, t in sorted(v)) for c, v in said.items()})


def slow_trie(conversations):
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    found = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = sorted(c for c in convs if len(conversations[c]) == len(node))
        parents = {n[:-1] for n in members if n}
        found.append(
            (
                min(convs),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(convs),
                sum(len(n) == len(node) + 1 and n[:-1] == node for n in below),
                sum(n not in parents for n in below),
                sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(found, key=str)


def trie(lists):
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(lists).collect()), key=str)


@pytest.fixture
def small_blocks(spark, monkeypatch):
    """Many shards, blocks of a few rows, chunks of three ids."""
    monkeypatch.setattr(prefix_trie, "CELLS", 24)
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    settings = {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_same_as_brute_force_over_many_edges(spark, small_blocks, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-300, 1_000), 120):
        turns = [(rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "ccc"])) for _ in range(rng.randrange(1, 5))]
        if rng.random() < 0.4:
            turns = [("user", "hot"), ("assistant", "copy")]
        rows += [(c, i, role, text, "x", "y") for i, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    assert trie(prefix_trie.turn_lists(spark.createDataFrame(rows, SCHEMA))) == slow(rows)


def test_edge_cases(spark, small_blocks):
    rows = [
        (1, None, None, None, "", ""), (1, 0, "user", "", "", ""), (1, 1, "user", "x" * 5_000, "", ""),
        (2, 0, "", None, "", ""), (2, 1, "user", "", "", ""),
        (3, 5, "us", "er", "", ""), (4, 5, "user", "", "", ""), (None, 0, "user", "lost", "", ""),
    ]
    rows += [(5, i, "user", "same", "", "") for i in range(300)]
    assert trie(prefix_trie.turn_lists(spark.createDataFrame(rows, SCHEMA))) == slow(rows)
    empty = prefix_trie.turn_lists(spark.createDataFrame([], SCHEMA))
    assert prefix_trie.prefix_trie(prefix_trie.share_heads(empty)).count() == 0


def test_repeated_rows_and_ties_are_turns(spark):
    rows = [(c, 0, "user", "again", "", "") for c in (1, 1, 2)] + [(c, 0, "user", t, "", "") for c, t in ((3, "p"), (3, "q"), (4, "q"), (4, "p"))]
    found = trie(prefix_trie.turn_lists(spark.createDataFrame(rows, SCHEMA)))
    assert [(r[0], r[3]) for r in found if r[1] == 2] == [(1, 1), (3, 2)]


def test_conversations_without_turns_are_in_the_root(spark):
    lists = spark.createDataFrame(
        [(7, []), (8, []), (9, [(bytes(16), 4)])], "id bigint, turns array<struct<hash:binary,size:int>>"
    )
    digest = hashlib.sha256(b"7,8").hexdigest()
    assert trie(lists)[0] == (7, 0, None, 3, 1, 1, 0, digest)
    only = trie(lists.filter("id < 9"))
    assert only == [(7, 0, None, 2, 0, 1, 0, digest)]


def test_shared_heads(spark):
    import zlib

    rows = [(c, i, "user", f"{c}-{i}", "", "") for c in (0, 3, 57, 99, 101, 200, 217) for i in range(c % 9 + 1)]
    lists = prefix_trie.turn_lists(spark.createDataFrame(rows, SCHEMA))
    want = {}
    for c in {r[0] for r in rows}:
        h = zlib.crc32(str(c).encode()) % 6
        own = [("user", r[3]) for r in rows if r[0] == c]
        want[c] = tuple([("user", r[3]) for r in rows if r[0] == c - c % 100][:h] + own[h:])
    assert trie(prefix_trie.share_heads(lists)) == slow_trie(want)


def test_a_block_sorts_its_rows():
    keys = [bytes([k]) * 16 for k in (3, 1, 2, 1)]
    *depths, (convs, _) = prefix_trie.block_nodes(keys, [bytes(4)] * 4, np.array([1, 5, 3, 4]))
    assert convs.tolist() == [4, 5, 3, 1]
    assert depths[1][3][0].tolist() == [2, 1, 1]
