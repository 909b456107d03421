"""Why an answer's text is not the legend's: texts swapped, repeated or slightly edited.

Different texts meet different legend texts in a set-similarity join with prefix filtering. Two word
sets whose Jaccard similarity is at least ``least`` percent share one of the first
n - ceil(least n / 100) + 1 words of each, whatever order all sets follow; here the words that few
legend texts have come first, so frequent words are hardly ever joined on. Every pair that shares such
a word is compared whole: no link is lost, and nothing is compared that shares only common words.

What the join carries is small and of fixed size: the number of a text, its count of words, the place
of the word and ``BITS`` bits, each the parity of the words that hash to it. Place and bits bound how
much two texts can share, so almost every pair that is not alike is dropped inside the join; texts and
their words are shuffled once for the pairs that are left.

Words are those of ROUGE. Texts without words are like no other; null texts are equal to none.
Repeated rows are classified each and compared once. An empty table or legend gives what has no match.
"""

from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import settle
from .evaluate import legend_mismatch
from .joins import join_small


BITS = 256


def _word_sets(texts):
    """Distinct texts with their words as a set, numbered in the shared folder."""
    sets = texts.filter("text IS NOT NULL").distinct()
    words = F.array_distinct(tx.rouge_tokens(F.col("text")))
    return settle(sets.select(F.monotonically_increasing_id().alias("id"), "text", words.alias("words")))


def _prefixes(sets, counts, least):
    """One row for each text and word of its prefix: id, n, word, its place, and the bits of all words."""
    words = sets.select("id", F.size("words").alias("n"), F.explode("words").alias("word"))
    bit = f"pmod(xxhash64(word), {BITS})"
    parity = [
        F.expr(f"bit_xor(CASE WHEN {bit} div 64 = {i} THEN shiftleft(1L, CAST({bit} % 64 AS INT)) ELSE 0L END)")
        for i in range(BITS // 64)
    ]
    ranked = join_small(words, counts, "word", "left").groupBy("id").agg(
        F.first("n").alias("n"),
        F.sort_array(F.collect_list(F.struct(F.coalesce("held", F.lit(0)).alias("held"), "word"))).alias("words"),
        *[p.alias(f"bits{i}") for i, p in enumerate(parity)],
    )
    length = F.expr(f"n - CAST(ceil({int(least)} * n / 100) AS INT) + 1")
    prefix = F.transform(F.slice("words", F.lit(1), length), lambda w: w["word"])
    kept = [c for c in ranked.columns if c != "words"]
    return ranked.select(*kept, F.posexplode(prefix).alias("place", "word"))


def _may_be_alike(least):
    """Whether the sets of two prefix rows, the other's columns with ``_``, can share enough words.

    Alike sets share at least ``least (n + m) / (100 + least)`` words. No more are shared than the first
    common word and those behind it; each word of one set only turns one bit at most.
    """
    total = F.col("n") + F.col("_n")
    behind = F.least(F.col("n") - F.col("place"), F.col("_n") - F.col("_place"))
    turned = sum(
        (F.bit_count(F.col(f"bits{i}").bitwiseXOR(F.col(f"_bits{i}"))) for i in range(BITS // 64)), F.lit(0)
    )
    sizes = (F.col("n") * 100 >= F.col("_n") * least) & (F.col("_n") * 100 >= F.col("n") * least)
    return sizes & (behind * (100 + least) >= total * least) & ((total - turned) * (100 + least) >= total * 2 * least)


def _candidates(left, right, least):
    """Pairs (id, _id) of word sets that share a prefix word and may be alike, each once."""
    counts = right.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("held"))
    a, b = _prefixes(left, counts, least), _prefixes(right, counts, least)
    b = b.withColumnsRenamed({c: f"_{c}" for c in b.columns})
    met = a.join(b, (F.col("word") == F.col("_word")) & _may_be_alike(least))
    return met.select("id", "_id").distinct()


def similar_texts(texts, others, least=80):
    """Pairs (text, other, shared, together) of distinct texts whose word sets are alike.

    ``texts`` and ``others`` have one column ``text``; ``shared`` of ``together`` words are in both.
    """
    least = int(least)
    left, right = _word_sets(texts), _word_sets(others)
    pairs = _candidates(left, right, least)
    words = right.select(F.col("id").alias("_id"), F.col("text").alias("other"), F.col("words").alias("theirs"))
    both = pairs.join(left, "id").join(words, "_id")
    shared = F.size(F.array_intersect("words", "theirs"))
    sized = both.select("text", "other", shared.alias("shared"), F.size(F.array_union("words", "theirs")).alias("together"))
    return sized.filter(F.col("shared") * 100 >= F.col("together") * least)


def explain_mismatches(answers, legend, doc="document_id", least=80):
    """Mismatched answers with ``kind``, the nearest legend id and the words shared with it.

    In this order: ``swapped``, the text is that of another id; ``repeated``, the document gives the
    text more than once; ``edited``, like the text of its own id; ``near_other``, like that of another
    id; ``unknown``. Nearest is the most similar text at ``least`` percent, then the answer's own id,
    then the smallest id.
    """
    wrong = legend_mismatch(answers, legend)
    ids = legend.filter("hypothesis IS NOT NULL").groupBy(F.col("hypothesis").alias("other"))
    named = ids.agg(F.min("hypothesis_id").alias("near_id"))
    texts = wrong.select(F.col("hypothesis").alias("text")).filter("text IS NOT NULL").distinct()
    held = settle(join_small(texts, named.select("other", F.col("other").alias("text")), "text", "left"))
    # No other text can be nearer than the same one, so only new texts are compared.
    new = held.filter("other IS NULL").select("text")
    alike = similar_texts(new, named.select(F.col("other").alias("text")), least)
    n = F.size(F.array_distinct(tx.rouge_tokens(F.col("text"))))
    exact = held.filter("other IS NOT NULL").select("text", "other", n.alias("shared"), n.alias("together"))
    far = -F.when(F.col("text") == F.col("other"), 2.0).otherwise(F.col("shared") / F.col("together"))
    every = settle(alike.unionByName(exact).select("text", "other", "shared", "together", far.alias("far")))
    top = join_small(every, named, "other").groupBy("text").agg(
        F.min(F.struct("far", "near_id", "shared", "together")).alias("__top")
    )
    own = every.select("text", F.col("other").alias("expected"), F.struct("far", "shared", "together").alias("__own"))
    times = answers.groupBy(doc, "hypothesis").agg(F.count(F.lit(1)).alias("__times"))
    found = wrong.join(times, [doc, "hypothesis"], "left")
    found = join_small(found, top.withColumnRenamed("text", "hypothesis"), "hypothesis", "left")
    found = join_small(found, own.withColumnRenamed("text", "hypothesis"), ["hypothesis", "expected"], "left")
    kind = (
        F.when(F.col("__top.far") == -2, "swapped")
        .when(F.col("__times") > 1, "repeated")
        .when(F.col("__own").isNotNull(), "edited")
        .when(F.col("__top").isNotNull(), "near_other")
        .otherwise("unknown")
    )
    closest = F.col("__own.far") == F.col("__top.far")
    near = [F.when(closest, F.col("hypothesis_id")).otherwise(F.col("__top.near_id")).alias("near_id")]
    near += [F.when(closest, F.col(f"__own.{c}")).otherwise(F.col(f"__top.{c}")).alias(c) for c in ("shared", "together")]
    kept = [c for c in found.columns if not c.startswith("__")]
    return found.select(*kept, kind.alias("kind"), *near)
