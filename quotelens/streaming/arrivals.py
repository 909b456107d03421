"""Responses that arrive more than once or too late.

A caller that runs into a time limit sends its request again, so the log may hold one response
several times, within minutes of each other.
"""

from pyspark.sql import functions as F

from .live import WATERMARK


def distinct_responses(responses, ids="request_id", within=WATERMARK, ts="ts"):
    """The first response of each request; repeats within ``within`` of its time are dropped.

    The state holds a request for that long only, so it does not grow with the stream. A response
    without any id cannot be recognised and always stays. Tables are made distinct over all time:
    the earliest response stays, of equal times the smallest row.
    """
    ids = [ids] if isinstance(ids, str) else list(ids)
    unknown = F.lit(True)
    for name in ids:
        unknown = unknown & F.col(name).isNull()
    if responses.isStreaming:
        timed = responses.withWatermark(ts, within)
        # Without an id, a random one; with one, it is the same each time.
        own = F.when(unknown, F.uuid())
        kept = timed.withColumn("_own", own).dropDuplicatesWithinWatermark([*ids, "_own"])
        return kept.drop("_own")
    rest = [c for c in responses.columns if c not in ids and c != ts]
    first = (
        responses.filter(~unknown)
        .groupBy(*ids)
        .agg(F.min(F.struct(ts, *rest)).alias("_first"))
        .select(*ids, "_first.*")
    )
    return first.unionByName(responses.filter(unknown))


def counted(responses, name="arrivals", ts="ts"):
    """``responses`` with metrics observed in every micro-batch: rows, and their span of time."""
    return responses.observe(
        name, F.count(F.lit(1)).alias("rows"), F.min(ts).alias("earliest"), F.max(ts).alias("latest")
    )


def arrival_totals(query, name="arrivals"):
    """What a query has seen since it started: rows, repeats and late rows that were dropped.

    Rows are the observed ones of :func:`counted`; repeats and late rows are counted by the stateful
    operators themselves. Uses the progress that the session keeps
    (``spark.sql.streaming.numRecentProgressUpdates`` batches).
    """
    totals = {"rows": 0, "repeats": 0, "late": 0}
    for progress in query.recentProgress:
        seen = progress.observedMetrics.get(name)
        totals["rows"] += seen["rows"] if seen else 0
        for state in progress.stateOperators:
            totals["late"] += state.numRowsDroppedByWatermark
            totals["repeats"] += state.customMetrics.get("numDroppedDuplicateRows", 0)
    return totals
