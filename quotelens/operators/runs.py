"""Load-test summaries, training logs and request timing."""

from pyspark.sql import functions as F

from ..session import settle
from .ordered import exact_percentiles, in_parts, next_value, running_in_parts


def bench_summary(requests, keys=()):
    """Load-test summary per ``keys`` from one row per request; null keys are left out.

    Columns read: client, start_ms, latency_ms, first_byte_ms, tokens, failed.
    """
    keyed = requests.dropna(subset=list(keys)) if keys else requests
    keyed = keyed.withColumn("_all", F.lit(1))
    on = [*keys, "_all"]
    ratio = F.col("concurrentClients") / (F.col("averageLatency") / 1000)
    answered = F.col("totalRequests") - F.col("failedRequests")
    totals = keyed.groupBy(*on).agg(
        (F.max(F.col("start_ms") + F.col("latency_ms")) - F.min("start_ms")).alias("totalTimeMills"),
        F.count(F.lit(1)).alias("totalRequests"),
        F.count_if("failed").alias("failedRequests"),
        F.count_distinct("client").alias("concurrentClients"),
        F.sum("tokens").alias("totalTokens"),
        F.avg("latency_ms").alias("averageLatency"),
        F.avg("first_byte_ms").alias("timeToFirstByte"),
    )
    derived = totals.withColumns(
        {
            "errorRate": 100 * F.col("failedRequests") / F.col("totalRequests"),
            "tps": ratio,
            "tokenThroughput": ratio * F.col("totalTokens") / F.nullif(answered, F.lit(0)),
            "tokenPerRequest": F.floor(F.col("totalTokens") / F.col("totalRequests")),
        }
    )
    marks = (0.5, 0.9, 0.99)
    columns = {"l": "latency_ms", "f": "first_byte_ms"}
    percentiles = exact_percentiles(keyed, on, columns, marks)
    names = {f"l{p * 100:g}": f"p{p * 100:g}Latency" for p in marks}
    names |= {f"f{p * 100:g}": f"p{p * 100:g}TimeToFirstByte" for p in marks}
    return _side_by_side(derived, percentiles, on).withColumnsRenamed(names).drop("_all")


def _side_by_side(left, right, on):
    """Two tables with one row a key as one; an aggregation, as the key may be a constant."""
    both = left.unionByName(right, allowMissingColumns=True)
    return both.groupBy(*on).agg(*[F.max(c).alias(c) for c in both.columns if c not in on])


def loss_series(log, run=()):
    """Training and evaluation losses as one series; an entry with both counts as training."""
    series = F.when(F.col("loss").isNotNull(), "loss").when(
        F.col("eval_loss").isNotNull(), "eval_loss"
    )
    return log.select(
        *run, "step", series.alias("series"), F.coalesce("loss", "eval_loss").alias("value")
    ).filter("series is not null")


def best_step(log, run="run"):
    """Step with the lowest evaluation loss per run; the earlier one on a tie."""
    evals = log.filter(F.col("eval_loss").isNotNull())
    return evals.groupBy(run).agg(
        F.min_by("step", F.struct("eval_loss", "step")).alias("best_step"),
        F.min("eval_loss").alias("best_loss"),
    )


def early_stop(log, patience=2, min_delta=1e-3, run="run"):
    """Step at which training stops per run, null if it never does.

    An evaluation improves if it is the first or lowers the best loss so far by more than
    ``min_delta``; training stops at the ``patience``-th in a row that does not.
    """
    evals = log.filter(F.col("eval_loss").isNotNull()).select(run, "step", "eval_loss")
    ranks = {
        "_rank": ("sum", F.lit(1), False),
        "_best": ("min", F.col("eval_loss"), True),
    }
    ranked = running_in_parts(in_parts(evals, [run], ["step"]), [run], ["step"], ranks)
    improved = F.col("_best").isNull() | (F.col("_best") - F.col("eval_loss") > min_delta)
    last = {"_last": ("max", F.when(improved, F.col("_rank")), False)}
    since = running_in_parts(ranked, [run], ["step"], last)
    waited = F.col("_rank") - F.col("_last")
    return since.groupBy(run).agg(
        F.min(F.when(waited >= patience, F.col("step"))).alias("stop_step")
    )


def request_gap(log, client="client", at="ts_ms"):
    """Milliseconds to the client's next request (``gap_ms``), null on its last one."""
    following = next_value(log, [client], [at], F.col(at), "_next")
    return following.withColumn("gap_ms", F.col("_next") - F.col(at)).drop("_next")


def length_stats(df, size, keys=(), exact=True):
    """Count, mean, extremes and percentiles of a length per ``keys`` (nulls left out)."""
    rows = df.dropna(subset=list(keys)) if keys else df
    sized = rows.select(*keys, F.lit(1).alias("_all"), size.alias("_size"))
    on = [*keys, "_all"]
    marks = (0.5, 0.9, 0.99)
    if exact:
        # Everything follows from how often each size occurs, so sizes are computed once.
        sizes = settle(sized.groupBy(*on, "_size").agg(F.count(F.lit(1)).alias("_n")))
        stats = sizes.groupBy(*on).agg(
            F.coalesce(F.sum(F.when(F.col("_size").isNotNull(), F.col("_n"))), F.lit(0)).alias("count"),
            (F.sum(F.col("_size") * F.col("_n")) / F.sum(
                F.when(F.col("_size").isNotNull(), F.col("_n"))
            )).alias("mean"),
            F.min("_size").alias("min"),
            F.max("_size").alias("max"),
        )
        marked = exact_percentiles(sizes, on, {"p": "_size"}, marks, count="_n")
        stats = _side_by_side(stats, marked, on)
    else:
        stats = sized.groupBy(*on).agg(
            F.count("_size").alias("count"),
            F.avg("_size").alias("mean"),
            F.min("_size").alias("min"),
            F.max("_size").alias("max"),
            *[F.percentile_approx("_size", p).alias(f"p{p * 100:g}") for p in marks],
        )
    return stats.drop("_all")
