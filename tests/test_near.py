import random
import re

import pytest
from pyspark.sql import functions as F

from quotelens.operators import near

WORDS = [f"w{i}" for i in range(12)]


def words(text):
    return set(re.findall("[a-z0-9]+", (text or "").lower()))


@pytest.mark.parametrize("least", [50, 80, 100])
def test_pairs_equal_all_pairs(spark, least):
    rng = random.Random(least)
    make = lambda: " ".join(rng.choices(WORDS, k=rng.randint(0, 7)))
    texts, others = ([make() for _ in range(120)] + [None, "", "!"] for _ in range(2))
    frames = [spark.createDataFrame([(t,) for t in x + x], "text string") for x in (texts, others)]
    found = [tuple(r) for r in near.similar_texts(*frames, least).collect()]
    want = {
        (a, b, len(words(a) & words(b)), len(words(a) | words(b)))
        for a in texts for b in others
        if a is not None and b is not None and words(a) and words(b)
        and 100 * len(words(a) & words(b)) >= least * len(words(a) | words(b))
    }
    assert len(found) == len(set(found)) and set(found) == want and want


def test_common_words_make_few_candidates(spark):
    """Texts of common words meet often; what leaves the join is numbers, and hardly more than is alike."""
    rng = random.Random(7)
    texts = [" ".join(rng.sample([f"w{i}" for i in range(60)], 20)) for _ in range(300)]
    texts += [f"{t} more" for t in texts[:20]]
    sets = near._word_sets(spark.createDataFrame([(t,) for t in texts], "text string"))
    counts = sets.selectExpr("explode(words) AS word").groupBy("word").agg(F.count(F.lit(1)).alias("held"))
    rows = near._prefixes(sets, counts, 80)
    assert "text" not in rows.columns
    met = sum(r["count"] ** 2 for r in rows.groupBy("word").count().collect())
    pairs = {tuple(r) for r in near._candidates(sets, sets, 80).collect()}
    held = {r["id"]: set(r["words"]) for r in sets.collect()}
    alike = {(a, b) for a, x in held.items() for b, y in held.items() if 100 * len(x & y) >= 80 * len(x | y)}
    assert alike <= pairs and len(pairs) <= 2 * len(alike) < met / 10


def test_kinds(spark):
    legend = spark.createDataFrame(
        [("a", "one two three four five"), ("b", "six seven eight nine ten"), ("c", "??")],
        "hypothesis_id string, hypothesis string",
    )
    rows = [
        (1, "a", "one two three four five"),  # right
        (1, "b", "One, two three four five"),  # words of another id
        (2, "a", "six seven eight nine ten"),  # swapped
        (2, "b", "one two three four five"),  # swapped
        (3, "a", "one two three four five six"),  # edited
        (4, "a", "other text"), (4, "b", "other text"),  # repeated
        (5, "a", "??"),  # swapped, without words
        (5, "b", None), (6, "z", "nothing like it"), (None, "a", ""),  # unknown
    ]
    answers = spark.createDataFrame(
        [(*r, 9) for r in rows], "document_id bigint, hypothesis_id string, hypothesis string, shared bigint"
    ).drop("shared")
    found = near.explain_mismatches(answers, legend).collect()
    kinds = {(r["document_id"], r["hypothesis_id"]): (r["kind"], r["near_id"]) for r in found}
    assert len(found) == len(rows) - 1 and kinds == {
        (1, "b"): ("near_other", "a"), (2, "a"): ("swapped", "b"), (2, "b"): ("swapped", "a"),
        (3, "a"): ("edited", "a"), (4, "a"): ("repeated", None), (4, "b"): ("repeated", None),
        (5, "a"): ("swapped", "c"), (5, "b"): ("unknown", None), (6, "z"): ("unknown", None),
        (None, "a"): ("unknown", None),
    }


def test_empty_tables(spark):
    legend = spark.createDataFrame([], "hypothesis_id string, hypothesis string")
    answers = spark.createDataFrame([(1, "a", "x")], "document_id bigint, hypothesis_id string, hypothesis string")
    (row,) = near.explain_mismatches(answers, legend).collect()
    assert (row["kind"], row["near_id"]) == ("unknown", None)
    assert near.explain_mismatches(answers.limit(0), legend).collect() == []
