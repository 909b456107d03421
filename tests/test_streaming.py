import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotelens.operators import monitor as mon
from quotelens.streaming import live

ANSWER = "struct<hypothesis_id:string,label:string,hypothesis:string,source_clause:string>"
SCHEMA = f"ts timestamp, endpoint string, adapter string, carp double, answers array<{ANSWER}>"


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def response(minute, carp, endpoint="e"):
    return (at(minute), endpoint, "a", carp, [("q1", "entailment", "h", "c")])


def feed(spark, folder, batches):
    """One file per batch, read one by one."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/in/part={i}")
    return (
        spark.readStream.schema(SCHEMA)
        .option("maxFilesPerTrigger", 1)
        .option("latestFirst", False)
        .parquet(f"{folder}/in/*")
    )


BATCHES = [
    [response(0, 0.5), response(1, 0.9), response(6, 0.9)],
    [response(3, 0.1), response(20, 0.6), response(21, 0.8, "f")],
    [response(60, 1.0)],
    [response(200, 1.0), response(2, 0.0)],  # the last row is too late
    [response(400, 1.0)],
]


@pytest.fixture()
def stream(spark, tmp_path):
    return feed(spark, str(tmp_path), BATCHES)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_closed_periods_equal_the_batch(spark, tmp_path, stream):
    points = mon.to_metric_points(stream)
    done = live.run_to_table(live.short_alarm(points), f"{tmp_path}/out", f"{tmp_path}/state")
    kept = spark.createDataFrame([r for b in BATCHES for r in b if r != response(2, 0.0)], SCHEMA)
    batch = mon.period_means(mon.grounding_points(mon.to_metric_points(kept), owned=False))
    closed = batch.filter(F.col("period") < F.lit(at(390)))
    assert rows(done) == rows(closed) and done.count() == 5


def test_complete_result_per_owner(spark, tmp_path, stream):
    points = mon.to_metric_points(stream)
    done = live.run_to_table(live.drift_alarm(points), f"{tmp_path}/out", f"{tmp_path}/state", "complete")
    everything = mon.to_metric_points(spark.createDataFrame([r for b in BATCHES for r in b], SCHEMA))
    batch = mon.period_means(mon.grounding_points(everything, owned=True), "1 day", ("endpoint", "adapter"))
    assert [(r.endpoint, round(r.mean, 9), r.points) for r in done.orderBy("endpoint").collect()] == [
        (r.endpoint, round(r.mean, 9), r.points) for r in batch.orderBy("endpoint").collect()
    ]


def test_label_counts(tmp_path, stream):
    answers = stream.select("ts", F.explode("answers").alias("a")).select("ts", "a.hypothesis_id", "a.label")
    done = live.run_to_table(live.label_counts_stream(answers, "1 day"), f"{tmp_path}/out", f"{tmp_path}/state", "complete")
    assert [(r.hypothesis_id, r.label, r["count"]) for r in done.collect()] == [("q1", "entailment", 10)]


@pytest.mark.parametrize("missing", ["notBreaching", "missing"])
def test_alarm_state_carries_over_batches(spark, tmp_path, missing):
    schema = "owner string, period timestamp, mean double, breach boolean"
    low = {"x": {0, 5, 30}, "y": {10, 15, 20}}
    means = [(o, at(m), 0.1 if m in low[o] else 1.0, m in low[o]) for o in "xy" for m in (0, 5, 10, 15, 20, 30, 45)]
    for i in range(0, 50, 15):
        part = [r for r in means if at(i) <= r[1] < at(i + 15)]
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/in/part={i:02d}")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    states = live.alarm_stream(source, n=3, m=2, missing=missing, key="owner")
    done = live.run_to_table(states, f"{tmp_path}/out", f"{tmp_path}/state")
    batch = mon.alarm_state(spark.createDataFrame(means, schema), n=3, m=2, missing=missing, keys=("owner",))
    plain = lambda df: [(r.owner, r.period, r.state) for r in df.orderBy("owner", "period").collect()]
    assert plain(done) == plain(batch)


def test_inference_log_goes_on_after_a_restart(spark, tmp_path, stream):
    log = stream.select(
        "ts", "endpoint", "adapter", F.lit("u").alias("template_uri"), F.lit("i").alias("input"), F.lit("o").alias("output")
    )
    for _ in range(2):
        query = live.sink_inference_log(log, f"{tmp_path}/log", f"{tmp_path}/ck", available_now=True)
        query.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/log").count() == 10
    with pytest.raises(ValueError, match="template_uri"):
        live.sink_inference_log(log.drop("template_uri"), f"{tmp_path}/l2", f"{tmp_path}/c2")


def test_scoring_a_stream(spark, tmp_path):
    schema = f"contract string, answers array<{ANSWER}>"
    spark.createDataFrame([("a b c d", [("q", "entailment", "h", "a b c")])], schema).write.parquet(f"{tmp_path}/in")
    scored = mon.carp_in_row(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"))
    done = live.run_to_table(scored, f"{tmp_path}/out", f"{tmp_path}/state")
    assert [r.carp for r in done.collect()] == [1.0]


def test_alarm_straight_from_scored_responses(spark, tmp_path, stream):
    """Period means and the stateful alarm in one running query."""
    means = live.short_alarm(mon.to_metric_points(stream))
    named = means.select(F.lit("CARP_3").alias("metric"), "period", "mean", "breach")
    states = live.alarm_stream(named, n=2, m=1)
    done = live.run_to_table(states, f"{tmp_path}/out", f"{tmp_path}/state")
    got = {(r.period - at(0)).seconds // 60: r.state for r in done.collect()}
    assert got[0] == got[5] == "ALARM" and got[10] == "OK"
    assert got[20] == got[25] == "ALARM" and got[30] == got[60] == "OK"
    assert sorted(got) == list(range(0, 205, 5))
