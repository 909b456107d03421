"""Metric points, windows, alarms and drift, in batch and as streams."""

from pyspark.sql import functions as F

from ...operators import drift, monitor as mon
from ...streaming import arrivals as arrivals_, live, silence
from . import standins as st
from .registry import query, r6, scratch, table


def _points(spark, folder):
    return mon.to_metric_points(st.scored_responses(table(spark, folder, "events")))


def _event_stream(spark, folder):
    schema = table(spark, folder, "events").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/events.parquet*")


def _stamp(column, name):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(name)


def _bucket(step):
    return f"time_bucket(INTERVAL '{step}', ts, TIMESTAMP '1970-01-01')"


def _means_sql(step, keys=""):
    return f"""means AS (SELECT {keys}{_bucket(step)} AS period, avg(carp) AS mean, count(*) AS points
      FROM responses GROUP BY {keys}{_bucket(step)})"""


@query(
    "metric_points",
    f"""WITH {st.RESPONSES_SQL}, points AS (
      SELECT 'Hlabel_' || hypothesis_id AS metric, 'label=' || label AS dims, ts, 1.0 AS value FROM responses
      UNION ALL SELECT 'Hlabel_' || hypothesis_id, 'model_endpoint=' || endpoint || ',model_adapter=' || adapter || ',label=' || label, ts, 1.0 FROM responses
      UNION ALL SELECT 'CARP_3', '', ts, carp FROM responses
      UNION ALL SELECT 'CARP_3', 'model_endpoint=' || endpoint || ',model_adapter=' || adapter, ts, carp FROM responses)
    SELECT metric, dims, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round(value, 6) AS value FROM points""",
)
def metric_points(spark, folder):
    dims = F.array_join(
        F.transform(F.map_entries("dims"), lambda e: F.concat_ws("=", e["key"], e["value"])), ","
    )
    return _points(spark, folder).select(
        "metric", dims.alias("dims"), _stamp("ts", "ts"), r6(F.col("value"), "value")
    )


@query(
    "label_counts",
    f"""WITH {st.RESPONSES_SQL} SELECT endpoint, adapter, hypothesis_id, label, count(*) AS count
    FROM responses GROUP BY ALL""",
)
def label_counts(spark, folder):
    responses = st.scored_responses(table(spark, folder, "events"))
    answers = responses.select("endpoint", "adapter", F.explode("answers").alias("a")).select(
        "endpoint", "adapter", "a.hypothesis_id", "a.label"
    )
    return mon.label_counts(answers, ["endpoint", "adapter"])


@query(
    "label_drift",
    f"""WITH {st.RESPONSES_SQL},
    c AS (SELECT hypothesis_id, label, count(*) AS n FROM responses WHERE ts >= TIMESTAMP '2024-01-25' AND (hypothesis_id <> 'nda-3' OR label = 'entailment') GROUP BY ALL),
    b AS (SELECT hypothesis_id, label, count(*) AS n FROM responses WHERE ts < TIMESTAMP '2024-01-25' GROUP BY ALL),
    cs AS (SELECT hypothesis_id, label, n / sum(n) OVER (PARTITION BY hypothesis_id) AS share FROM c),
    bs AS (SELECT hypothesis_id, label, n / sum(n) OVER (PARTITION BY hypothesis_id) AS base_share FROM b),
    j AS (SELECT hypothesis_id, label, coalesce(share, 0) AS share, coalesce(base_share, 0) AS base_share
          FROM cs FULL JOIN bs USING (hypothesis_id, label))
    SELECT hypothesis_id, label, round(share, 6) AS share, round(base_share, 6) AS base_share,
      round(abs(share - base_share), 6) AS change, abs(share - base_share) > 0.2 AS drifted,
      share = 1.0 AS one_sided FROM j""",
)
def label_drift(spark, folder):
    """Last days against the days before; one hypothesis is made one-sided."""
    answers = st.scored_responses(table(spark, folder, "events")).select(
        "ts", F.explode("answers").alias("a")
    ).select("ts", "a.hypothesis_id", "a.label")
    recent = F.col("ts") >= F.lit("2024-01-25").cast("timestamp")
    usual = (F.col("hypothesis_id") != "nda-3") | (F.col("label") == "entailment")
    drift = mon.label_drift(
        mon.label_counts(answers.filter(recent & usual)), mon.label_counts(answers.filter(~recent))
    )
    return drift.select(
        "hypothesis_id", "label", *[r6(F.col(c), c) for c in ("share", "base_share", "change")],
        "drifted", "one_sided",
    )


_SHORT = f"""WITH {st.RESPONSES_SQL}, {_means_sql('5 minutes')}
    SELECT strftime(period, '%Y-%m-%d %H:%M:%S') AS period, round(mean, 6) AS mean, points,
      mean <= 0.7 AS breach FROM means"""
_DRIFT = f"""WITH {st.RESPONSES_SQL}, {_means_sql('1 day', 'endpoint, adapter, ')}
    SELECT endpoint, adapter, strftime(period, '%Y-%m-%d %H:%M:%S') AS period, round(mean, 6) AS mean,
      points, mean <= 0.7 AS breach FROM means"""


def _means(means, *keys):
    return means.select(*keys, _stamp("period", "period"), r6(F.col("mean"), "mean"), "points", "breach")


@query("five_minute_means", _SHORT)
def five_minute_means(spark, folder):
    return _means(mon.period_means(mon.grounding_points(_points(spark, folder), owned=False)))


@query("daily_means_by_adapter", _DRIFT)
def daily_means_by_adapter(spark, folder):
    keys = ("endpoint", "adapter")
    points = mon.grounding_points(_points(spark, folder), owned=True)
    return _means(mon.period_means(points, "1 day", keys), *keys)


def _live_points(spark, folder):
    return mon.to_metric_points(st.scored_responses(_event_stream(spark, folder)))


def _ran(spark, stream, mode):
    path = scratch(spark)
    return live.run_to_table(stream, f"{path}/out", f"{path}/state", mode)


@query("live_five_minute_means", _SHORT)
def live_five_minute_means(spark, folder):
    """The stream, run to the end of the data, equals its batch twin."""
    return _means(_ran(spark, live.short_alarm(_live_points(spark, folder)), "complete"))


@query("live_daily_means_by_adapter", _DRIFT)
def live_daily_means_by_adapter(spark, folder):
    stream = live.drift_alarm(_live_points(spark, folder))
    return _means(_ran(spark, stream, "complete"), "endpoint", "adapter")


@query(
    "live_label_counts",
    f"""WITH {st.RESPONSES_SQL} SELECT strftime({_bucket('1 day')}, '%Y-%m-%d %H:%M:%S') AS period,
      hypothesis_id, label, count(*) AS count FROM responses GROUP BY ALL""",
)
def live_label_counts(spark, folder):
    responses = st.scored_responses(_event_stream(spark, folder))
    answers = responses.select("ts", F.explode("answers").alias("a")).select(
        "ts", "a.hypothesis_id", "a.label"
    )
    counts = _ran(spark, live.label_counts_stream(answers, "1 day"), "complete")
    return counts.select(_stamp("period", "period"), "hypothesis_id", "label", "count")


def _state_sql(n, m, keep, keys=""):
    by = f"PARTITION BY {keys} " if keys else ""
    k = f"{keys}, " if keys else ""
    join = f"{keys}, period" if keys else "period"
    group = f"GROUP BY {keys}" if keys else ""
    state = f"""CASE WHEN sum(coalesce(CAST(mean <= 0.7 AS INT), 0)) OVER ({by}ORDER BY period
        ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) >= {m} THEN 'ALARM' ELSE 'OK' END"""
    kept = f"""last_value(CASE WHEN mean IS NOT NULL THEN state END IGNORE NULLS) OVER ({by}ORDER BY period
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
    return f"""{st.RESPONSES_SQL}, {_means_sql('5 minutes', k)},
    spine AS (SELECT {k}unnest(generate_series(min(period), max(period), INTERVAL 5 MINUTE)) AS period FROM means {group}),
    seen AS (SELECT {k}period, mean, {state} AS state FROM spine LEFT JOIN means USING ({join})),
    states AS (SELECT {k}period, mean, {kept if keep else 'state'} AS state FROM seen)"""


def _states(spark, folder, missing, n, m, keys=()):
    points = mon.grounding_points(_points(spark, folder), owned=bool(keys))
    means = mon.period_means(points, keys=keys)
    return mon.alarm_state(means, n=n, m=m, missing=missing, keys=keys)


_STATE_COLUMNS = "strftime(period, '%Y-%m-%d %H:%M:%S') AS period, round(mean, 6) AS mean, state"


def _state_columns(states, *keys):
    return states.select(*keys, _stamp("period", "period"), r6(F.col("mean"), "mean"), "state")


@query(
    "alarm_states",
    f"WITH {_state_sql(1, 1, False)} SELECT {_STATE_COLUMNS} FROM states",
)
def alarm_states(spark, folder):
    """One breach of one; periods without data are fine."""
    return _state_columns(_states(spark, folder, "notBreaching", 1, 1))


@query(
    "alarm_states_keeping",
    f"WITH {_state_sql(1, 1, True)} SELECT {_STATE_COLUMNS} FROM states",
)
def alarm_states_keeping(spark, folder):
    """Periods without data keep the state."""
    return _state_columns(_states(spark, folder, "missing", 1, 1))


@query(
    "alarm_states_by_adapter",
    f"WITH {_state_sql(4, 2, False, 'endpoint, adapter')} SELECT endpoint, adapter, {_STATE_COLUMNS} FROM states",
)
def alarm_states_by_adapter(spark, folder):
    """Two breaches of the last four periods, per endpoint and adapter."""
    keys = ("endpoint", "adapter")
    return _state_columns(_states(spark, folder, "notBreaching", 4, 2, keys), *keys)


@query(
    "alarm_edges",
    f"""WITH {_state_sql(4, 2, False, 'endpoint, adapter')}, moved AS (
      SELECT *, lag(state, 1, 'OK') OVER (PARTITION BY endpoint, adapter ORDER BY period) AS previous FROM states)
    SELECT endpoint, adapter, strftime(period, '%Y-%m-%d %H:%M:%S') AS period, previous, state
    FROM moved WHERE previous <> state""",
)
def alarm_edges(spark, folder):
    keys = ("endpoint", "adapter")
    edges = mon.alarm_edges(_states(spark, folder, "notBreaching", 4, 2, keys), keys)
    return edges.select(*keys, _stamp("period", "period"), "previous", "state")


def _arrivals(events):
    """Events in three parts in time order: ten days, ten days and the rest."""
    first = events.agg(F.min(F.to_date("ts"))).first()[0]
    days = F.datediff("ts", F.lit(first).cast("date"))
    part = F.least(F.floor(days / 10), F.lit(2))
    return [events.filter(part == i) for i in range(3)]


@query(
    "live_alarm_states",
    f"""WITH {_state_sql(3, 2, True, 'endpoint, adapter')}
    SELECT endpoint || '/' || adapter AS owner, {_STATE_COLUMNS} FROM states""",
)
def live_alarm_states(spark, folder):
    """Points, period means and stateful alarm in one running query, stopped and resumed.

    The first ten days of events arrive, then the next ten, then all later ones; the state goes on
    from the checkpoint. The last arrival
    is one later event that closes all periods.
    """
    path = scratch(spark)
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.limit(0).write.parquet(f"{path}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{path}/in")
    points = mon.to_metric_points(st.scored_responses(stream))
    means = live.drift_alarm(points, "5 minutes")
    owner = F.concat_ws("/", "endpoint", "adapter").alias("owner")
    spark.conf.set(*live.STATE_STORE)
    states = live.alarm_stream(
        means.select(owner, "period", "mean", "breach"), n=3, m=2, missing="missing", key="owner"
    )
    end = _ended(events)
    for arrival in (*_arrivals(events), end):
        arrival.write.mode("append").parquet(f"{path}/in")
        done = live.run_to_table(states, f"{path}/out", f"{path}/state")
    return _state_columns(done.filter("owner NOT LIKE 'end/%'"), "owner")


@query(
    "inference_log",
    """SELECT event_id::VARCHAR AS input, event_type AS endpoint, 'a' AS adapter, 's3://b/t/1' AS template_uri,
      props AS output FROM events""",
)
def inference_log(spark, folder):
    """Requests and responses appended to Parquet by a stream."""
    path = scratch(spark)
    log = _event_stream(spark, folder).select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("endpoint"),
        F.lit("a").alias("adapter"),
        F.lit("s3://b/t/1").alias("template_uri"),
        F.col("event_id").cast("string").alias("input"),
        F.col("props").alias("output"),
    )
    live.sink_inference_log(log, f"{path}/log", f"{path}/state", available_now=True).awaitTermination()
    return spark.read.schema(log.schema).parquet(f"{path}/log").drop("ts")


def _ended(events, days=2):
    """One event of its own, days after the last, that lets the watermark pass all others."""
    return events.agg(F.max("ts").alias("last")).select(
        *[
            (F.col("last") + F.expr(f"interval {days} days")).alias(f.name) if f.name == "ts"
            else F.lit("end" if f.name == "event_type" else -1).cast(f.dataType).alias(f.name)
            for f in events.schema
        ]
    )


def _arriving(spark, events, arrivals):
    """A stream over a folder, and functions that let each arrival come in."""
    path = scratch(spark)
    events.limit(0).write.parquet(f"{path}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{path}/in")
    return path, stream, [lambda a=a: a.write.mode("append").parquet(f"{path}/in") for a in arrivals]


_QUIET = "NOT (event_type IN ('error', 'click') AND ts >= (SELECT min(ts::DATE) FROM events) + INTERVAL 10 DAY)"


@query(
    "live_silent_alarms",
    f"""WITH {st.RESPONSES_SQL.replace('FROM events', f'FROM events WHERE {_QUIET}')},
    {_means_sql('5 minutes', 'endpoint, adapter, ')},
    closed AS (SELECT time_bucket(INTERVAL 5 MINUTE, max(ts) + INTERVAL 2 DAY - INTERVAL 10 MINUTE, TIMESTAMP '1970-01-01')
                      - INTERVAL 5 MINUTE AS upto FROM events),
    spine AS (SELECT endpoint, adapter, unnest(generate_series(min(period), any_value(upto), INTERVAL 5 MINUTE)) AS period
              FROM means, closed GROUP BY endpoint, adapter),
    flagged AS (SELECT endpoint, adapter, period, mean, CASE WHEN mean IS NULL OR mean <= 0.7 THEN 1 ELSE 0 END AS bad
                FROM spine LEFT JOIN means USING (endpoint, adapter, period))
    SELECT endpoint || '/' || adapter AS owner, strftime(period, '%Y-%m-%d %H:%M:%S') AS period, round(mean, 6) AS mean,
      CASE WHEN sum(bad) OVER (PARTITION BY endpoint, adapter ORDER BY period ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) >= 12
           THEN 'ALARM' ELSE 'OK' END AS state FROM flagged""",
)
def live_silent_alarms(spark, folder):
    """Two kinds of endpoint fall silent after ten days; an hour without data or below is an alarm."""
    everything = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    first = everything.agg(F.min(F.to_date("ts"))).first()[0]
    late = F.col("ts") >= F.date_add(F.lit(first), 10).cast("timestamp")
    events = everything.filter(~(F.col("event_type").isin("error", "click") & late))
    arrivals = (*_arrivals(events), _ended(everything))
    path, stream, arrive = _arriving(spark, everything, arrivals)
    means = live.drift_alarm(mon.to_metric_points(st.scored_responses(stream)), "5 minutes")
    owner = F.concat_ws("/", "endpoint", "adapter").alias("owner")
    spark.conf.set(*live.STATE_STORE)
    states = silence.watched_alarm(
        means.select(owner, "period", "mean", "breach"), n=12, m=12, missing="breaching", key="owner"
    )
    for arrival in arrive:
        arrival()
        done = live.run_to_table(states, f"{path}/out", f"{path}/state")
    return _state_columns(done.filter("owner NOT LIKE 'end/%'"), "owner")


@query("live_means_without_repeats", _SHORT)
def live_means_without_repeats(spark, folder):
    """Every third response is sent again by its caller, minutes later; means count it once."""
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    again = events.filter(F.col("event_id") % 3 == 0)
    arrivals = [
        part for a, b in zip(_arrivals(events), _arrivals(again)) for part in (a, b)
    ]
    path, stream, arrive = _arriving(spark, events, [*arrivals, _ended(events, 30)])
    # A later arrival may be as old as the one before it began: that is what is waited for.
    scored = st.scored_responses(stream, "event_id")
    once = arrivals_.distinct_responses(scored, "event_id", "12 days")
    points = mon.to_metric_points(once, whole_seconds=False)
    means = live.short_alarm(points, watermark=None)
    for arrival in arrive:
        arrival()
        done = live.run_to_table(means, f"{path}/out", f"{path}/state")
    last = events.agg(F.max("ts")).first()[0]
    return _means(done.filter(F.col("period") <= F.lit(last)))


_LABEL_COUNTS = """count(*) FILTER (WHERE label = 'entailment') AS e, count(*) FILTER (WHERE label = 'contradiction') AS c,
      count(*) FILTER (WHERE label = 'not_mentioned') AS m"""


@query(
    "live_label_drift",
    f"""WITH {st.RESPONSES_SQL}, told AS (
      SELECT ts, hypothesis_id, CASE WHEN hypothesis_id = 'nda-3' AND ts >= TIMESTAMP '2024-01-20' AND label = 'contradiction'
             THEN 'entailment' ELSE label END AS label, ts < (SELECT min(ts::DATE) FROM events) + INTERVAL 10 DAY AS old
      FROM responses),
    b AS (SELECT hypothesis_id, {_LABEL_COUNTS} FROM told WHERE old GROUP BY ALL),
    w AS (SELECT {_bucket('1 day')} AS period, hypothesis_id, {_LABEL_COUNTS} FROM told WHERE NOT old GROUP BY ALL),
    cells AS (SELECT period, w.hypothesis_id, n, x, bx, sum(x) OVER h AS total, sum(bx) OVER h AS btotal,
                     count(*) FILTER (WHERE x + bx > 0) OVER h - 1 AS degrees
              FROM w JOIN b USING (hypothesis_id), LATERAL (SELECT unnest([1, 2, 3]) AS n, unnest([w.e, w.c, w.m]) AS x, unnest([b.e, b.c, b.m]) AS bx)
              WINDOW h AS (PARTITION BY period, w.hypothesis_id)),
    tests AS (SELECT period, hypothesis_id, any_value(total) AS answers, any_value(degrees) AS degrees, any_value(total + btotal) AS everything,
                     sum(CASE WHEN x + bx > 0 THEN (x - (x + bx) * total / (total + btotal)) ** 2 / ((x + bx) * total / (total + btotal))
                            + (bx - (x + bx) * btotal / (total + btotal)) ** 2 / ((x + bx) * btotal / (total + btotal)) ELSE 0 END) AS statistic
              FROM cells GROUP BY period, hypothesis_id)
    SELECT strftime(period, '%Y-%m-%d %H:%M:%S') AS period, hypothesis_id, answers::BIGINT AS answers, round(statistic, 6) AS statistic,
      round(exp(-statistic / 2), 6) AS p_value, round(sqrt(statistic / everything), 6) AS effect, exp(-statistic / 2) < 0.001 AS drifted
    FROM tests""",
)
def live_label_drift(spark, folder):
    """Days against the first ten, which are the stored baseline; one hypothesis loses a label."""
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))

    def answers(rows):
        flat = st.scored_responses(rows).select("ts", F.explode("answers").alias("a"))
        flat = flat.select("ts", "a.hypothesis_id", "a.label")
        lost = (F.col("hypothesis_id") == "nda-3") & (F.col("ts") >= F.lit("2024-01-20").cast("timestamp"))
        told = F.when(lost & (F.col("label") == "contradiction"), "entailment").otherwise(F.col("label"))
        return flat.withColumn("label", told)

    old, *later = _arrivals(events)
    path, stream, arrive = _arriving(spark, events, [*later, _ended(events)])
    drift.label_table(answers(old)).write.parquet(f"{path}/baseline")
    baseline = spark.read.parquet(f"{path}/baseline")
    tested = live.label_drift_stream(answers(stream), baseline)
    for arrival in arrive:
        arrival()
        done = live.run_to_table(tested, f"{path}/out", f"{path}/state")
    last = events.agg(F.max("ts")).first()[0]
    return done.filter(F.col("period") <= F.lit(last)).select(
        _stamp("period", "period"), "hypothesis_id", "answers",
        *[r6(F.col(c), c) for c in ("statistic", "p_value", "effect")], "drifted",
    )
