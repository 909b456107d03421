"""Label drift against a stored baseline, as a chi-square test that tables and streams share.

A row of counts per hypothesis (one column a label) is compared with the baseline's counts of that
hypothesis: are both samples of one distribution? All of it is arithmetic on one row, so a stream
needs no further state than its windowed counts.
"""

import math

from pyspark.sql import functions as F

from ..schemas import LABELS
from .joins import join_small


def label_table(answers, groups=(), labels=LABELS):
    """Answers per hypothesis (and ``groups``), a column for each label; others are left out.

    The number of rows does not depend on the number of answers, and counts are summed before they
    are shuffled.
    """
    known = answers.filter(F.col("label").isin(*labels))
    counts = [F.count_if(F.col("label") == label).alias(label) for label in labels]
    return known.groupBy(*groups, "hypothesis_id").agg(*counts)


def upper_gamma_share(half_df, x):
    """Q(half_df, x): the chance that a chi-square of 2 * ``half_df`` degrees exceeds 2 ``x``.

    ``half_df`` is a multiple of 1/2 and known; the sum has ``half_df`` terms. Half-integers start
    from the complementary error function (relative error below 1.2e-7).
    """
    whole = float(half_df).is_integer()
    start = F.exp(-x) if whole else _erfc(F.sqrt(x))
    total, order = start, 1.0 if whole else 0.5
    while order < half_df:
        total = total + F.exp(-x + order * F.log(x) - F.lit(math.lgamma(order + 1)))
        order += 1
    return F.when(x <= 0, 1.0).otherwise(F.least(total, F.lit(1.0)))


#: Coefficients of a published rational approximation of erfc.
_ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807,
         -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def _erfc(z):
    """Complementary error function for z >= 0."""
    t = 1 / (1 + z / 2)
    sum_ = F.lit(_ERFC[-1])
    for c in reversed(_ERFC[:-1]):
        sum_ = c + t * sum_
    return t * F.exp(-z * z + sum_)


def chi_square(counts, base):
    """Statistic and degrees of freedom of two rows of counts (lists of columns).

    Labels that neither side has do not count. The statistic is 0 if one side has no answers.
    """
    total, base_total = (sum(side[1:], side[0]) for side in (counts, base))
    statistic, used = F.lit(0.0), F.lit(0)
    for a, b in zip(counts, base):
        both = a + b
        for seen, size in ((a, total), (b, base_total)):
            expected = both * size / (total + base_total)
            statistic = statistic + F.when(both > 0, (seen - expected) ** 2 / expected).otherwise(0.0)
        used = used + F.when(both > 0, 1).otherwise(0)
    empty = (total == 0) | (base_total == 0)
    return F.when(empty, 0.0).otherwise(statistic), F.greatest(used - 1, F.lit(0))


def drift_test(counts, baseline, alpha=0.001, labels=LABELS):
    """``counts`` of :func:`label_table` against those of a baseline, by hypothesis.

    Adds ``answers``, ``statistic``, ``degrees``, ``p_value``, ``effect`` (Cramer's V, 0 to 1) and
    ``drifted``. A hypothesis that the baseline has not got is ``unknown`` and has no p-value.
    ``counts`` may be a stream; ``baseline`` is a table, with a row for each hypothesis.
    """
    base = [f"_base_{label}" for label in labels]
    stored = baseline.select("hypothesis_id", *[F.col(x).alias(y) for x, y in zip(labels, base)])
    joined = join_small(counts, stored, "hypothesis_id", "left")
    unknown = F.col(base[0]).isNull()
    statistic, degrees = chi_square([F.col(c) for c in labels], [F.col(c) for c in base])
    total = sum((F.col(c) for c in labels[1:]), F.col(labels[0]))
    everything = total + sum((F.col(c) for c in base[1:]), F.col(base[0]))
    p_value = F.when(F.col("degrees") == 0, 1.0)
    for d in range(1, len(labels)):
        p_value = p_value.when(F.col("degrees") == d, upper_gamma_share(d / 2, F.col("statistic") / 2))
    named = joined.withColumns({
        "answers": total,
        "statistic": F.when(~unknown, statistic),
        "degrees": F.when(~unknown, degrees),
        "unknown": unknown,
        "_all": everything,
    }).withColumn("p_value", p_value)
    return named.withColumns({
        "effect": F.sqrt(F.col("statistic") / F.col("_all")),
        "drifted": F.coalesce(F.col("p_value") < alpha, F.lit(False)),
    }).drop("_all", *base)
