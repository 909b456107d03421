from collections import Counter

import pytest
from pyspark.sql import functions as F

from quotelens.operators import prepare as prep
from quotelens.plans import jobs

TOKENS = [
    (1, "the cat sat on the mat".split()),
    (2, "the the a".split()),
    (3, []),
    (4, "mat a cat zebra".split()),
]


@pytest.fixture(scope="module")
def tokens(spark):
    return spark.createDataFrame(TOKENS, "i int, tokens array<string>").repartition(3)


def test_vocabulary_order(tokens):
    counts = Counter(t for _, ts in TOKENS for t in ts)
    want = [t for t, _ in sorted(counts.items(), key=lambda e: (-e[1], e[0]))]
    got = prep.fit_vocab(tokens).orderBy("token_id").collect()
    assert [r.token for r in got] == want
    assert [r.token_id for r in got] == list(range(1, len(want) + 1))


def test_ids_do_not_depend_on_what_is_in_memory(tokens, spark):
    vocab = prep.fit_vocab(tokens).cache()
    ids = {r.token: r.token_id for r in vocab.collect()}
    want = {i: [ids[t] for t in ts] for i, ts in TOKENS}
    for encoder, options in ((prep.encode, {}), (prep.encode, {"limit": 2}), (prep.encode, {"limit": 0})):
        got = {r.i: r.ids for r in encoder(tokens, vocab, "i", **options).collect()}
        assert got == want
        none = spark.createDataFrame([(9, None)], tokens.schema)
        assert encoder(none, vocab, "i", **options).first().ids == []
    long = spark.createDataFrame([(1, ["x" * 300, "y"])], tokens.schema)
    ids = prep.encode(long, prep.fit_vocab(long), "i").first().ids
    assert ids == [1, 2]


def test_unknown_tokens(tokens):
    vocab = prep.fit_vocab(tokens).filter("token <> 'zebra'")
    for encoder, options in ((prep.encode, {}), (prep.encode, {"limit": 2}), (prep.encode, {"limit": 0})):
        with pytest.raises(Exception, match="zebra"):
            encoder(tokens, vocab, "i", **options).collect()
        got = {r.i: r.ids for r in encoder(tokens, vocab, "i", unknown_id=0, **options).collect()}
        assert got[4][-1] == 0 and len(got[4]) == 4


def test_outside_tokenizer(spark):
    df = spark.createDataFrame([("ab",), ("",)], "text string")
    got = prep.encode_with(df, lambda texts: [[ord(c) for c in t] for t in texts]).collect()
    assert [r.ids for r in got] == [[97, 98], []]


def test_outside_tokenizer_gets_little_at_once(spark):
    texts = ["", None, "x" * 700_000, "y" * 700_000, "z" * (3 << 20), "é"] + ["w" * 1000] * 5000
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").coalesce(1)

    def tokenize(some):  # the bytes of the call, for each text
        size = sum(len((t or "").encode()) for t in some)
        return [None if t is None else [len(t), size, len(some)] for t in some]

    got = {r.i: r.ids for r in prep.encode_with(df, tokenize).collect()}
    assert [got[i] and got[i][0] for i in range(len(texts))] == [t if t is None else len(t) for t in texts]
    assert all(ids is None or ids[1] <= prep.CALL_BYTES or ids[2] == 1 for ids in got.values())


def test_memory_lookup_stays_in_arrow(tokens, spark):
    """Ids come with the positions and tokens that are not held; a chunk asks once for a token."""
    vocab = prep.fit_vocab(tokens)
    ids = {r.token: r.token_id for r in vocab.collect()}
    held = prep._memory_ids(vocab.filter("token_id <= 2"))
    for r in tokens.select("tokens", held("tokens").alias("f")).collect():
        want = [ids[t] if ids[t] <= 2 else None for t in r.tokens]
        assert r.f.ids == want and r.f._pos == [i for i, v in enumerate(want) if v is None]
        assert r.f._tokens == [r.tokens[i] for i in r.f._pos]
    many = spark.createDataFrame([(i, ["often"] * 50) for i in range(100)], tokens.schema).coalesce(1)
    rare = many.select("i", F.sequence(F.lit(0), F.lit(49)).alias("_pos"), F.col("tokens").alias("_tokens"))
    lists = prep._joined_ids(rare, prep.fit_vocab(many), "i", None)
    assert all(r._at == [(p, 1) for p in range(50)] for r in lists.collect()) and lists.count() == 100


def test_workers_get_little_at_once(spark, monkeypatch):
    """3,000 lists of 800 tokens are 30 MB, and fewer rows than an Arrow batch may have."""
    plain = prep._arrow_udf

    def watched(fn, kind):
        def run(batches):
            def small():
                for lists in batches:
                    assert lists.nbytes < 16 << 20
                    yield lists

            yield from fn(small())

        return plain(run, kind)

    monkeypatch.setattr(prep, "_arrow_udf", watched)
    conf, name = spark.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(name)
    words = F.transform(F.sequence(F.lit(1), F.lit(800)), lambda n: F.concat(F.lit("token"), n.cast("string")))
    df = spark.range(3000).select("id", words.alias("tokens")).coalesce(1)
    vocab = spark.range(1, 801).select(F.expr("concat('token', id)").alias("token"), F.col("id").cast("int").alias("token_id"))
    coded = prep.encode(df, vocab, "id", limit=2)
    assert coded.filter(F.col("ids") == F.sequence(F.lit(1), F.lit(800))).count() == 3000
    assert conf.get(name) == before and coded.columns == ["id", "tokens", "ids"]


def test_prompt_limit_is_inclusive(spark):
    df = spark.range(8999, 9002).select(F.array_repeat(F.lit(1), F.col("id").cast("int")).alias("prompt_ids"))
    assert sorted(len(r.prompt_ids) for r in prep.filter_prompt_len(df).collect()) == [8999, 9000]


def test_masks_and_cut(spark):
    rows = [(n, list(range(1, n + 1)), [1, 2, 3]) for n in (10999, 11000, 11001)]
    df = spark.createDataFrame(rows, "n int, full_ids array<int>, prompt_ids array<int>")
    for r in prep.training_arrays(df, pad_id=5).collect():
        assert len(r.input_ids) == len(r.labels) == len(r.attention_mask) == min(r.n, 11000)
        assert r.labels[:6] == [-100, -100, -100, 4, -100, 6]
        assert r.attention_mask[3:6] == [1, 0, 1]


def test_prefix_check(spark):
    good = spark.createDataFrame([([1, 2, 3], [1, 2]), ([1], [])], "full_ids array<int>, prompt_ids array<int>")
    assert prep.assert_prefix(good).count() == 2
    bad = spark.createDataFrame([([1, 2, 3], [2])], "full_ids array<int>, prompt_ids array<int>")
    with pytest.raises(Exception, match="do not start with"):
        prep.assert_prefix(bad).select("full_ids").collect()


@pytest.mark.parametrize("longest, width", [(7, 8), (8, 8), (9, 16)])
def test_padding(spark, longest, width):
    rows = [("b", [9] * longest), ("b", [9] * 3), ("c", [9])]
    df = spark.createDataFrame(rows, "batch string, input_ids array<int>")
    df = df.withColumn("attention_mask", F.transform("input_ids", lambda _: F.lit(1)))
    df = df.withColumn("labels", F.col("input_ids"))
    for r in prep.pad_batches(df).collect():
        assert len(r.input_ids) == len(r.labels) == len(r.attention_mask) == (width if r.batch == "b" else 8)
        n = r.input_ids.count(9)
        assert r.input_ids[n:] == r.attention_mask[n:] == [0] * (len(r.input_ids) - n)
        assert r.labels[n:] == [-100] * (len(r.labels) - n)


def test_batches_take_any_order(spark):
    df = spark.range(0, 50, 2).repartition(4)
    got = {r.id: r.batch for r in prep.batch_no(df, ["id"], 5).collect()}
    assert got == {i: i // 10 + 1 for i in range(0, 50, 2)}
    named = df.select(F.lit("f").alias("file"), F.col("id").alias("row"))
    assert {r.row: r.batch for r in prep.batch_no(named, ["file", "row"], 5).collect()} == got


def test_training_set_from_documents(spark):
    answer = "struct<hypothesis_id:string,label:string,hypothesis:string,source_clause:string>"
    rows = [(i, f"text number {i} of the set", [("q1", "entailment", "h", f"clause {i}")]) for i in range(6)]
    docs = spark.createDataFrame(rows, f"document_id long, text string, inference array<{answer}>")
    coded = jobs.coded_set(docs, F.lit("Read it."))
    for r in jobs.training_set(coded).collect():
        n = len(r.prompt_ids)
        assert r.full_ids[:n] == r.prompt_ids and r.labels == [-100] * n + r.full_ids[n:]
        assert set(r.attention_mask) == {1} and r.input_ids == r.full_ids
    sizes = sorted(len(r.full_ids) for r in coded.collect())
    report = jobs.training_report(coded, max_sequence=sizes[0] - 1).first()
    assert tuple(report) == (6, 0, 6)
    assert tuple(jobs.training_report(coded, max_prompt=1).first()) == (6, 6, 0)
    assert tuple(jobs.training_report(coded).first()) == (6, 0, 0)
    assert jobs.training_set(coded, max_prompt=1).count() == 0
    outside = jobs.coded_set(docs, F.lit("Read it."), tokenize=lambda ts: [list(t.encode()) for t in ts])
    texts = {r.document_id: bytes(r.full_ids).decode() for r in outside.collect()}
    assert "text number 3 of the set" in texts[3] and "clause 3" in texts[3]
    with pytest.raises(Exception, match="do not start with"):
        jobs.coded_set(docs, F.lit("s"), tokenize=lambda ts: [[len(t)] for t in ts])
    prompts = jobs.test_prompts(docs, F.lit("Read it.")).collect()
    assert all(p.text.endswith("<|im_start|>assistant\n") and len(p.inference) == 1 for p in prompts)


@pytest.mark.parametrize("text", ["", "a b\n\t{\"q\": 1.5}", "Größe  日本語 𝒳! <|im_start|>user\n<|x|>", "\u00a0\u2003x"])
def test_pieces_put_together_are_the_text(spark, text):
    from quotelens.functions import text as tx

    pieces = spark.createDataFrame([(text,)], "t string").select(tx.chat_pieces(F.col("t"))).first()[0]
    assert "".join(pieces) == text
    assert ("<|im_start|>" in pieces) == ("<|im_start|>" in text)
