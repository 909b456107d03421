"""Load tests, training history and request timing."""

from pyspark.sql import functions as F

from ...functions import text as tx
from ...operators import runs, sketches
from ...operators.joins import join_small
from ...streaming import live
from . import standins as st
from .monitoring import _arrivals, _arriving, _ended
from .registry import TOKENS, query, r6, scratch, table, texts

_COUNTS = ("totalRequests", "failedRequests", "concurrentClients", "totalTokens", "tokenPerRequest")
_NUMBERS = (
    "totalTimeMills",
    "averageLatency",
    "timeToFirstByte",
    "errorRate",
    "tps",
    "tokenThroughput",
    "p50Latency",
    "p90Latency",
    "p99Latency",
    "p50TimeToFirstByte",
    "p90TimeToFirstByte",
    "p99TimeToFirstByte",
)


def _summary_sql(keys):
    group = "".join(f"{k}, " for k in keys)
    by = f"GROUP BY {', '.join(keys)}" if keys else ""
    marks = ", ".join(
        f"round(quantile_cont({column}, {p}), 4) AS p{int(p * 100)}{name}"
        for column, name in (("latency_ms", "Latency"), ("first_byte_ms", "TimeToFirstByte"))
        for p in (0.5, 0.9, 0.99)
    )
    tps = "count(DISTINCT client) / (avg(latency_ms) / 1000)"
    return f"""WITH {st.REQUESTS_SQL} SELECT {group}
      round(max(start_ms + latency_ms) - min(start_ms), 4) AS "totalTimeMills",
      count(*) AS "totalRequests", count(*) FILTER (WHERE failed) AS "failedRequests",
      count(DISTINCT client) AS "concurrentClients", CAST(sum(tokens) AS BIGINT) AS "totalTokens",
      CAST(floor(sum(tokens) / count(*)) AS BIGINT) AS "tokenPerRequest",
      round(avg(latency_ms), 4) AS "averageLatency", round(avg(first_byte_ms), 4) AS "timeToFirstByte",
      round(100.0 * count(*) FILTER (WHERE failed) / count(*), 4) AS "errorRate", round({tps}, 4) AS tps,
      round({tps} * sum(tokens) / nullif(count(*) - count(*) FILTER (WHERE failed), 0), 4) AS "tokenThroughput",
      {marks} FROM requests {by}"""


def _summary(spark, folder, keys):
    summary = runs.bench_summary(st.requests(spark, folder), keys)
    return summary.select(*keys, *_COUNTS, *[F.round(c, 4).alias(c) for c in _NUMBERS])


@query("load_summary", _summary_sql(()))
def load_summary(spark, folder):
    return _summary(spark, folder, ())


@query("load_summary_by_endpoint", _summary_sql(("endpoint",)))
def load_summary_by_endpoint(spark, folder):
    return _summary(spark, folder, ("endpoint",))


_LATENCIES = ("latency_ms", "first_byte_ms")


def _sketch_sql(sets):
    shown = ", ".join(
        f"count({c}) AS {c}_count, round(min({c}), 6) AS p0_{c}, round(max({c}), 6) AS p100_{c}, true AS {c}_within"
        for c in _LATENCIES
    )
    return f"""WITH {st.REQUESTS_SQL}, daily AS (SELECT *, start_ms // 86400000 AS day FROM requests)
      SELECT endpoint, day, {shown} FROM daily GROUP BY GROUPING SETS ({sets})"""


def _timed(requests):
    return requests.withColumn("ts", F.timestamp_millis("start_ms"))


def _against_exact(found, requests, marks=(0.5, 0.9, 0.99)):
    """Counts, extremes and whether each percentile has its rank, within three times the bound of 99 %.

    ``found`` has few rows (endpoints and days); its ranks are counted over all requests.
    """
    bound = 3 * sketches.rank_error()
    same = [F.equal_null("r.endpoint", "f.endpoint"), F.coalesce(F.col("day") == F.col("at"), F.lit(True))]
    dated = requests.withColumn("at", _day(F.timestamp_millis("start_ms")))
    both = join_small(dated.alias("r"), found.alias("f"), same)

    def held(c, p):
        value, asked = F.col(f"p{100 * p:g}_{c}"), F.max(F.col(f"{c}_count")) * p
        slack = F.max(F.col(f"{c}_count")) * bound
        below, upto = F.count_if(F.col(f"r.{c}") < value), F.count_if(F.col(f"r.{c}") <= value)
        return (below <= asked + slack) & (upto >= asked - slack)

    checks = []
    for c in _LATENCIES:
        checks.append(F.max(f"{c}_count").alias(f"{c}_count"))
        checks += [r6(F.max(f"{e}_{c}"), f"{e}_{c}") for e in ("p0", "p100")]
        within = held(c, marks[0])
        for p in marks[1:]:
            within = within & held(c, p)
        checks.append(within.alias(f"{c}_within"))
    return both.groupBy("f.endpoint", "day").agg(*checks)


def _day(time):
    return F.floor(F.unix_seconds(time) / 86400).alias("day")


def _asked(hours, period):
    merged = sketches.merged(hours, _LATENCIES, ["endpoint"], period)
    found = sketches.percentiles(merged, _LATENCIES, (0, 0.5, 0.9, 0.99, 1))
    day = _day(F.col("period")) if period else F.lit(None).cast("long").alias("day")
    return found.select("endpoint", day, *[c for c in found.columns if c not in ("endpoint", "period")])


@query("latency_sketches", _sketch_sql("(endpoint, day), (endpoint)"))
def latency_sketches(spark, folder):
    """Sketches stored by the hour, merged by day and over all days, against exact ranks."""
    requests, path = st.requests(spark, folder), scratch(spark)
    sketches.sketched(_timed(requests), _LATENCIES, ["endpoint"]).write.parquet(path)
    hours = spark.read.parquet(path)
    return _against_exact(_asked(hours, "1 day").union(_asked(hours, None)), requests)


@query("live_latency_sketches", _sketch_sql("(endpoint, day)"))
def live_latency_sketches(spark, folder):
    """Hourly sketches appended by a stream over several arrivals, merged by day."""
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    path, stream, arrive = _arriving(spark, events, [*_arrivals(events), _ended(events)])
    timed = _timed(st.requests_of(stream)).withWatermark("ts", "1 hour")
    hours = sketches.sketched(timed, _LATENCIES, ["endpoint"])
    for arrival in arrive:
        arrival()
        done = live.run_to_table(hours, f"{path}/out", f"{path}/state")
    return _against_exact(_asked(done.filter("endpoint <> 'end'"), "1 day"), st.requests(spark, folder))


@query(
    "request_gaps",
    f"""WITH {st.REQUESTS_SQL} SELECT event_id, client,
      coalesce(lead(start_ms) OVER (PARTITION BY client ORDER BY start_ms) - start_ms, -1) AS gap_ms FROM requests""",
)
def request_gaps(spark, folder):
    log = st.requests(spark, folder).select("event_id", "client", "start_ms")
    gaps = runs.request_gap(log, at="start_ms")
    return gaps.select("event_id", "client", F.coalesce("gap_ms", F.lit(-1)).alias("gap_ms"))


@query(
    "loss_series",
    f"""WITH {st.LOG_SQL} SELECT run, step, 'loss' AS series, loss AS value FROM log WHERE loss IS NOT NULL
    UNION ALL SELECT run, step, 'eval_loss', eval_loss FROM log WHERE eval_loss IS NOT NULL""",
)
def loss_series(spark, folder):
    return runs.loss_series(st.training_log(spark, folder), ["run"])


@query(
    "best_steps",
    f"""WITH {st.LOG_SQL}, ranked AS (
      SELECT *, row_number() OVER (PARTITION BY run ORDER BY eval_loss, step) AS place
      FROM log WHERE eval_loss IS NOT NULL)
    SELECT run, step AS best_step, eval_loss AS best_loss FROM ranked WHERE place = 1""",
)
def best_steps(spark, folder):
    return runs.best_step(st.training_log(spark, folder))


@query(
    "early_stops",
    f"""WITH {st.LOG_SQL}, evals AS (
      SELECT run, step, eval_loss, row_number() OVER w AS place,
             min(eval_loss) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best
      FROM log WHERE eval_loss IS NOT NULL WINDOW w AS (PARTITION BY run ORDER BY step)),
    marked AS (
      SELECT *, max(CASE WHEN best IS NULL OR best - eval_loss > 0.001 THEN place END)
                  OVER (PARTITION BY run ORDER BY step) AS last_place FROM evals)
    SELECT run, coalesce(min(CASE WHEN place - last_place >= 2 THEN step END), -1) AS stop_step
    FROM marked GROUP BY run""",
)
def early_stops(spark, folder):
    log = st.training_log(spark, folder)
    stops = runs.early_stop(log)
    return stops.select("run", F.coalesce("stop_step", F.lit(-1)).alias("stop_step"))


_LENGTHS = f"""SELECT source, count(*) AS count, round(avg(n), 6) AS mean, min(n) AS min, max(n) AS max,
    round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.9), 6) AS p90,
    round(quantile_cont(n, 0.99), 6) AS p99
    FROM (SELECT source, len({TOKENS.format('text')}) AS n FROM documents) GROUP BY source"""


@query("text_lengths", _LENGTHS)
def text_lengths(spark, folder):
    """Token counts per source with exact percentiles."""
    size = F.size(tx.rouge_tokens(F.col("text"))).cast("long")
    stats = runs.length_stats(texts(spark, folder, "text", "source"), size, ["source"])
    return stats.select(
        "source", "count", r6(F.col("mean"), "mean"), "min", "max",
        *[r6(F.col(c), c) for c in ("p50", "p90", "p99")],
    )
