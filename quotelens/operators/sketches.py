"""Percentiles by period from stored quantile sketches, for load tests and live requests.

A sketch (KLL) holds a bounded sample of the values of a period. Sketches merge, so those stored by
the hour give percentiles by day, by endpoint or of everything without the requests being read
again; unlike stored percentiles they may be put together. Aggregation is partial before the
shuffle: a task sends one sketch a group whatever its rows, so no key is hot.

A percentile has a rank within ``rank_error(k)`` of the asked one, with 99 % confidence, however many
sketches were merged; up to ``k`` values it is exact. Minimum (0.0) and maximum (1.0) are always
exact. Values are those of rows, none is interpolated.

Edge cases: null and NaN values are left out of sketch and count, infinities count as values; a
group without values has count 0 and null percentiles. Rows without a time are left out; null keys
are a group. An empty table gives an empty result. Repeated rows count each.
"""

from pyspark.sql import functions as F

K = 800


def rank_error(k=K):
    """Bound of the rank of a percentile, as a share, with 99 % confidence."""
    return 2.296 / k**0.9723


def sketched(df, columns, keys=(), time="ts", period="1 hour", k=K):
    """One row a period and key: ``period`` (its start), and for each column sketch and count.

    Also over a stream; its watermark then closes the periods.
    """
    if "period" in (*keys, *columns):
        raise ValueError("no key or column may be named period")
    values = {c: F.col(c).cast("double") for c in columns}
    shown = {c: F.when(~F.isnan(v), v) for c, v in values.items()}
    aggregates = [
        a
        for c, v in shown.items()
        for a in (F.kll_sketch_agg_double(v, k).alias(f"{c}_sketch"), F.count(v).alias(f"{c}_count"))
    ]
    grouped = df.groupBy(*keys, F.window(time, period).alias("_window")).agg(*aggregates)
    return grouped.withColumn("period", F.col("_window.start")).drop("_window")


def merged(sketches, columns, keys=(), period=None, k=K):
    """Stored sketches put together by ``keys`` and a longer ``period`` (None: all periods)."""
    by = list(keys)
    if period:
        sketches = sketches.withColumn("period", F.window("period", period).start)
        by.append("period")
    aggregates = [
        a
        for c in columns
        for a in (
            F.kll_merge_agg_double(F.when(F.col(f"{c}_count") > 0, F.col(f"{c}_sketch")), k).alias(f"{c}_sketch"),
            F.sum(f"{c}_count").alias(f"{c}_count"),
        )
    ]
    out = sketches.groupBy(*by).agg(*aggregates)
    return out if by else out.filter(F.col(f"{columns[0]}_count").isNotNull())


def percentiles(sketches, columns, marks=(0.5, 0.9, 0.99)):
    """The sketches replaced by percentile columns such as ``p99_latency_ms``."""
    found = {
        f"p{100 * p:g}_{c}": F.when(
            F.col(f"{c}_count") > 0, F.kll_sketch_get_quantile_double(f"{c}_sketch", F.lit(float(p)))
        )
        for c in columns
        for p in marks
    }
    return sketches.withColumns(found).drop(*[f"{c}_sketch" for c in columns])
