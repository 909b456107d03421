import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from quotelens.functions import text as tx
from quotelens.operators import overlap

WORDS = "the receiving party shall not reverse a b c é ü ß X-ray 12".split()


def brute(target, prediction, n=3):
    def grams(t):
        t = re.findall("[a-z0-9]+", (t or "").lower())
        return Counter(tuple(t[i : i + n]) for i in range(len(t) - n + 1))

    t, p = grams(target), grams(prediction)
    o = sum((t & p).values())
    pr, rc = o / max(sum(p.values()), 1), o / max(sum(t.values()), 1)
    return pr, rc, (2 * pr * rc / (pr + rc) if o else 0.0)


def test_golden_edges(spark):
    rows = [
        ("this is war.", "war is this", 0.0, 0.0, 0.0),
        ("a b", "a b", 0.0, 0.0, 0.0),
        ("", "", 0.0, 0.0, 0.0),
        (None, "a b c", 0.0, 0.0, 0.0),
        (
            "the Receiving Party shall not reverse the Receiving Party shall not",
            "the Receiving Party shall not the Receiving Party shall not "
            "the Receiving Party shall not",
            6 / 13,
            6 / 9,
            0.545455,
        ),
    ]
    df = spark.createDataFrame(rows, "t string, p string, pr double, rc double, f double")
    for row in overlap.rouge_pairs(df, "t", "p").collect():
        assert math.isclose(row.rouge.precision, row.pr, abs_tol=1e-6)
        assert math.isclose(row.rouge.recall, row.rc, abs_tol=1e-6)
        assert math.isclose(row.rouge.fmeasure, row.f, abs_tol=1e-6)


def test_matches_brute_force(spark):
    rng = random.Random(7)
    rows = [
        tuple(" ".join(rng.choices(WORDS[: rng.choice([2, 6, 13])], k=rng.randint(0, 60))) for _ in "tp")
        for _ in range(200)
    ]
    df = spark.createDataFrame(rows, "t string, p string")
    for n in (1, 2, 3):
        for row in overlap.rouge_pairs(df, "t", "p", n).collect():
            want = brute(row.t, row.p, n)
            got = (row.rouge.precision, row.rouge.recall, row.rouge.fmeasure)
            assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(got, want)), row


def test_self_score_and_symmetry(spark):
    df = spark.createDataFrame([("a b c a b c a b c d", "c a b c a")], "x string, y string")
    row = df.select(
        tx.rouge_n(F.col("x"), F.col("x")).alias("same"),
        tx.rouge_n(F.col("x"), F.col("y")).alias("xy"),
        tx.rouge_n(F.col("y"), F.col("x")).alias("yx"),
    ).first()
    assert row.same.fmeasure == 1.0
    assert row.xy.precision == row.yx.recall and row.xy.recall == row.yx.precision


def test_occurrences_are_told_apart(spark):
    df = spark.createDataFrame([(["b", "a", "b", "b", "a", "c"],), ([],)], "g array<string>")
    got = [sorted(r[0]) for r in df.select(tx.distinct_occurrences(F.col("g"))).collect()]
    assert got == [["a", "a#2", "b", "b#2", "b#3", "c"], []]


def test_table_overlap_with_a_hot_key(spark):
    """One key holds most quotes; slices and plain grouping give the same scores."""
    rng = random.Random(3)
    text = {k: " ".join(rng.choices(WORDS, k=80)) for k in range(4)}
    quotes = [
        (k, i, " ".join(rng.choices(WORDS, k=rng.randint(0, 12))))
        for i in range(120)
        for k in [0 if i % 3 else rng.randint(0, 5)]
    ]
    left = spark.createDataFrame(quotes, "k int, quote_id int, text string")
    right = spark.createDataFrame(list(text.items()), "k int, text string")
    for per_group in (5, 1000):
        rows = overlap.ngram_overlap(left, right, "k", per_group=per_group).collect()
        assert len(rows) == len(quotes)
        asked = {(k, i): q for k, i, q in quotes}
        for r in rows:
            want = brute(text.get(r.k), asked[r.k, r.quote_id])
            assert math.isclose(r.rouge.precision, want[0], abs_tol=1e-9)
            assert math.isclose(r.rouge.fmeasure, want[2], abs_tol=1e-9)


def test_quote_precisions_of_many_quotes(spark):
    contract = "a b c d a b c e f g"
    quotes = ["a b c a b c", "", "x y z", "e f g", "a b c d a b c e f g"]
    df = spark.createDataFrame([(contract, quotes)], "c string, q array<string>")
    got = df.select(tx.quote_precisions(F.col("c"), F.col("q"))).first()[0]
    assert got == [brute(contract, q)[0] for q in quotes]


def test_wanted_occurrences_are_those_of_the_whole_text(spark):
    """Random texts with many repeats, against the numbered grams of the whole text."""
    rng = random.Random(3)
    draw = lambda most: " ".join(rng.choice("ab") for _ in range(rng.randint(0, most)))
    rows = [(draw(60), [draw(12) for _ in range(rng.randint(0, 4))]) for _ in range(80)] + [(None, ["a b a"]), ("a b a b a", [None])]
    df = spark.createDataFrame(rows, "c string, q array<string>")
    wanted = F.array_distinct(F.flatten(F.transform("q", lambda q: tx.gram_set(q))))
    grams = tx.ngrams(tx.rouge_tokens(F.col("c")))
    for r in df.select(
        "c", "q", F.array_sort(F.array_intersect(tx.gram_set(F.col("c")), wanted)).alias("whole"),
        F.array_sort(tx.bind(wanted, lambda w: tx._wanted_occurrences(grams, w))).alias("found"),
        tx.quote_precisions(F.col("c"), F.col("q")).alias("precisions"),
    ).collect():
        assert r.found == r.whole
        assert r.precisions == [brute(r.c, q)[0] for q in r.q]


def test_only_quoted_grams_of_a_contract_are_built(spark):
    """In order and with repeats; missing texts, other scripts and signs whose small letter is one of a to z."""
    rows = [
        ("A b, c d a B c x a b c d", ["c d a", "b cİ b"]),
        ("K İ É k I İ k", ["k i k", "k i k i"]),
        ("a b c", []),
        ("a b c", ["a b", None, ""]),
        ("", ["a b c"]),
        (None, ["a b c"]),
        ("a b c", None),
    ]
    df = spark.createDataFrame(rows, "c string, q array<string>")
    c, q = F.col("c"), F.col("q")
    wanted = F.flatten(F.transform(q, lambda x: tx.ngrams(tx.rouge_tokens(x))))
    every = tx.bind(wanted, lambda w: F.filter(tx.ngrams(tx.rouge_tokens(c)), lambda g: F.array_contains(w, g)))
    got = df.select(
        tx._quoted_grams(c, q, 3).alias("grams"), every.alias("every"), tx.quote_precisions(c, q).alias("precisions")
    ).collect()
    assert got[0].grams == ["c d a"] and got[0].precisions == [1.0, 0.0]
    assert [r.grams for r in got] == [r.every or [] for r in got]
    assert got[2].precisions == [] and got[3].precisions == [0.0, 0.0, 0.0]
    assert got[5].precisions == [0.0] and got[6].precisions is None


def test_crowds_without_a_key_or_with_one_quote_id_are_split(spark):
    """Null keys are scored where they are, and equal quote ids do not hold quotes together."""
    texts = spark.createDataFrame([("k", "a b c d e f g h")], "k string, text string")
    rows = [(None, 1, f"a b c {i}") for i in range(500)] + [("k", 1, f"a b c {i}") for i in range(500)]
    quotes = spark.createDataFrame(rows, "k string, quote_id int, text string").repartition(4)
    scored = overlap.ngram_overlap(quotes, texts, "k", per_group=20).collect()
    assert len(scored) == 1000
    assert all(r.overlap == (0 if r.k is None else 1) for r in scored)
    assert all(r.quote_grams == 2 and r.rouge.precision == r.overlap / 2 for r in scored)


def test_repeats_of_one_quote_do_not_share_a_group(spark, monkeypatch):
    """Equal quotes of one id are scored once, so a group stays near the wanted size."""
    texts = spark.createDataFrame([("k", "a b c d e f g h")], "k string, text string")
    rows = [("k", 1, "a b c")] * 400 + [("k", 2, None)] * 70 + [("k", i, f"a b c {i}") for i in range(200)]
    quotes = spark.createDataFrame(rows, "k string, quote_id int, text string").repartition(4)
    scored = overlap.ngram_overlap(quotes, texts, "k", per_group=20).collect()
    assert sorted((r.quote_id, r.overlap, r.quote_grams) for r in scored) == sorted(
        (i, 0, 0) if q is None else (i, 1, len(q.split()) - 2) for _, i, q in rows
    )

    def sizes(n):
        return F.transform("_quotes", lambda q: q.withField("overlap", F.size("_quotes")).withField(
            "quote_grams", F.lit(1)).withField("target_grams", F.lit(1)))

    monkeypatch.setattr(overlap, "_score_group", sizes)
    assert max(r.overlap for r in overlap.ngram_overlap(quotes, texts, "k", per_group=20).collect()) < 60


def test_rows_are_repeated_by_their_count(spark):
    df = spark.createDataFrame([(1, 1), (2, 65_536), (3, 65_537), (4, 200_000)], "i int, n long")
    got = overlap._repeated(df, F.col("n")).groupBy("i").count().collect()
    assert {r["i"]: r["count"] for r in got} == {1: 1, 2: 65_536, 3: 65_537, 4: 200_000}


def test_broadcasts_are_checked_by_bytes(spark):
    from quotelens.operators.joins import fits

    df = spark.createDataFrame([("x" * 1000,)] * 10, "t string")
    assert fits(df) == 10 and fits(df, 9) is None and fits(df, most_bytes=5_000) is None
    assert fits(df.limit(0)) == 0
