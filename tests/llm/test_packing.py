import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from quotelens.llm import packing

PATHS = [
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
]
SLOW, QUICK = packing.load_encoder(PATHS[0]), packing.load_encoder(*PATHS)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=255), max_size=60))
def test_quick_ids_equal_on_latin_text(text):
    assert SLOW(text).tolist() == QUICK(text).tolist()


@pytest.mark.parametrize("text", ["<|endoftext|> a", "日本語 text ½²", "a" * 5_000, " \n\t  x  ", ""])
def test_quick_ids_equal(text):
    assert SLOW(text).tolist() == QUICK(text).tolist()


def check(rows, texts, tiers=(128, 256, 512, 1024)):
    """Every id in one piece, pieces gapless in full windows; ``texts`` by document id."""
    documents, sequences = {}, {}
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] > 0
        documents.setdefault(r["doc_id"], []).append((r["start"], ids.tolist(), r["doc_tokens"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["window"]))
    assert set(documents) == set(texts)
    for doc, pieces in documents.items():
        want = [*SLOW(texts[doc] or "").tolist(), 0]
        at = 0
        for start, ids, total in sorted(pieces):
            assert (start, total) == (at, len(want))
            assert ids == want[at : at + len(ids)]
            at += len(ids)
        assert at == len(want)
    for pieces in sequences.values():
        at = 0
        for offset, length, _ in sorted(pieces):
            assert offset == at
            at += length
        window = pieces[0][2]
        assert at == window <= max(tiers) and window & (window - 1) == 0


def test_packing_keeps_every_id_and_fills_every_window(spark):
    rng = np.random.default_rng(1)
    texts = {
        i: " ".join(rng.choice(["alpha", "beta", "éclair", "gamma"], rng.integers(0, 900)))
        for i in range(150)
    }
    texts |= {200: None, 201: "", 202: "long text " * 8_000, None: "no id"}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    df = df.selectExpr("*", "'x' AS window", "0 AS ids")
    rows = packing.pack(df, *PATHS, pool_tokens=20_000).collect()
    check(rows, texts)
    groups = {}
    for r in rows:
        groups.setdefault((r["step_group"], r["window"]), []).append(r["length"])
    assert max(sum(g) for g in groups.values()) <= 32 * 1024
    assert len({g for g, _ in groups}) == len(groups)


def test_groups_have_nearly_the_same_cost():
    rng = np.random.default_rng(2)
    windows = [[(0, 0, np.zeros(n), n) for n in rng.multinomial(1024, [0.25] * 4)] for _ in range(64)]
    windows += [[(0, 0, np.zeros(1024), 1024)] for _ in range(64)]
    cost = np.zeros(4)
    for group, window in zip(packing._deal(windows, 4), windows):
        cost[group] += sum(len(p[2]) ** 2 for p in window)
    assert cost.max() < 1.01 * cost.min()


def test_repeated_rows_and_empty_tables(spark):
    twice = spark.createDataFrame([(1, "same text")] * 2, "doc_id bigint, text string").coalesce(1)
    rows = packing.pack(twice, *PATHS).collect()
    assert sum(r["length"] for r in rows) == 2 * rows[0]["doc_tokens"]
    assert packing.pack(twice.limit(0), *PATHS).collect() == []
