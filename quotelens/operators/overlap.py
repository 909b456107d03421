"""Scoring quotes against the texts they are said to come from."""

from pyspark.sql import functions as F

from ..functions import text as tx
from .joins import fits, hinted

QUOTES_PER_GROUP = 256


def ngram_overlap(left, right, key, n=3, quote_id="quote_id", per_group=QUOTES_PER_GROUP):
    """Clipped n-gram overlap of every text in ``left`` with the text of its key in ``right``.

    ``left`` has (key, quote_id, text), ``right`` has one (key, text) per key. Result: key,
    quote_id, overlap, quote_grams, target_grams and the struct ``rouge``. A quote without a
    text on the right, or too short for an n-gram, scores 0 and stays.

    Each text is shuffled once; n-grams never are. Quotes of one key travel together so that
    the long text is cut into n-grams once, at most about ``per_group`` of them: where a key has
    more, equal quotes of one id are counted, scored once and repeated by their count; what is
    then still more than ``per_group`` is spread over slices by a hash of the quote and the text
    copied to each. Quotes without a key have no text to meet and are scored where they are.
    """
    alone, left = left.filter(F.col(key).isNull()), left.filter(F.col(key).isNotNull())
    slices = F.ceil(F.count(F.lit(1)) / per_group).cast("int").alias("_slices")
    crowded = fits(left.groupBy(key).agg(slices).filter("_slices > 1")) != 0
    if not crowded:
        on, quotes, targets = [key], left.withColumn("_times", F.lit(1).cast("long")), right
    else:
        counted = left.groupBy(key, quote_id, "text").agg(F.count(F.lit(1)).alias("_times"))
        crowd = counted.groupBy(key).agg(slices).filter("_slices > 1")
        crowds = fits(crowd)
        on, slices = [key, "_slice"], F.coalesce("_slices", F.lit(1))
        quotes = counted.join(hinted(crowd, crowds), key, "left").withColumn(
            "_slice", F.pmod(F.xxhash64(quote_id, "text"), slices).cast("int")
        )
        targets = right.join(hinted(crowd, crowds), key, "left").withColumn(
            "_slice", F.explode(F.sequence(F.lit(0), slices - 1))
        )
    grouped = quotes.groupBy(*on).agg(
        F.collect_list(
            F.struct(F.col(quote_id).alias("id"), F.col("text").alias("t"), F.col("_times").alias("n"))
        ).alias("_quotes")
    )
    targets = targets.select(*on, F.col("text").alias("_target"))
    paired = grouped.join(targets, on, "left").select(key, "_quotes", "_target")
    lonely = alone.select(
        key,
        F.array(
            F.struct(
                F.col(quote_id).alias("id"), F.col("text").alias("t"), F.lit(1).cast("long").alias("n")
            )
        ).alias("_quotes"),
        F.lit(None).cast("string").alias("_target"),
    )
    both = paired.unionByName(lonely)
    scored = both.select(key, F.explode(_score_group(n)).alias("_s"))
    if crowded:
        scored = _repeated(scored, F.col("_s.n"))
    return scored.select(
        key,
        F.col("_s.id").alias(quote_id),
        "_s.overlap",
        "_s.quote_grams",
        "_s.target_grams",
        tx.overlap_score(
            F.col("_s.overlap"), F.col("_s.target_grams"), F.col("_s.quote_grams")
        ).alias("rouge"),
    )


def _repeated(df, times):
    """Every row ``times`` times; arrays stay within 65,536 entries up to 2^32 times."""
    last, step = times - 1, 1 << 16
    parts = df.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / step))))
    size = F.least(F.lit(step - 1).cast("long"), last - F.col("_part") * step)
    return parts.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), size)))


def _score_group(n):
    def score(target):
        return F.transform(
            F.transform(
                "_quotes",
                lambda q: F.struct(
                    q["id"].alias("id"), q["n"].alias("n"), tx.gram_set(q["t"], n).alias("g")
                ),
            ),
            lambda q: F.struct(
                q["id"].alias("id"),
                q["n"].alias("n"),
                tx.shared_grams(q["g"], target).alias("overlap"),
                F.size(q["g"]).alias("quote_grams"),
                F.size(target).alias("target_grams"),
            ),
        )

    return tx.bind(tx.gram_set(F.col("_target"), n), score)


def rouge_pairs(df, target, prediction, n=3, name="rouge"):
    """ROUGE-N of two text columns of each row."""
    return df.withColumn(name, tx.rouge_n(F.col(target), F.col(prediction), n))
