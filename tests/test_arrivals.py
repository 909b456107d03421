import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from quotelens.operators import drift
from quotelens.streaming import arrivals, live, silence

MEANS = "metric string, period timestamp, mean double, breach boolean"


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def feed(spark, folder, schema):
    spark.createDataFrame([], schema).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
    return stream, lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def states(spark, tmp_path, batches, **options):
    """States after each batch of (key, minute, mean) period means."""
    spark.conf.set(*live.STATE_STORE)
    stream, arrive = feed(spark, tmp_path, MEANS)
    timed = stream.withWatermark("period", "0 seconds")
    out = silence.watched_alarm(timed, 300, **options)
    for rows in batches:
        arrive([(k, at(m), v, v <= 0.7) for k, m, v in rows])
        done = live.run_to_table(out, f"{tmp_path}/out", f"{tmp_path}/state")
        yield sorted((r.metric, int((r.period - at(0)).total_seconds() // 60), r.mean, r.state) for r in done.collect())


def test_silent_key_gets_its_periods(spark, tmp_path):
    batches = [[("a", 0, 0.9), ("b", 0, 0.5)], [("a", 5, 0.9)], [("a", 30, 0.9)], [("a", 60, 0.9), ("b", 10, 0.1)]]
    *_, last = states(spark, tmp_path, batches, n=2, m=2, missing="breaching")
    b = [r for r in last if r[0] == "b"]
    assert b[0] == ("b", 0, 0.5, "OK") and b[1] == ("b", 5, None, "ALARM")
    # closed by the watermark of minute 60; the late row of minute 10 was not counted
    assert [r[1] for r in b] == list(range(0, 60, 5)) and all(r[2] is None for r in b[1:])
    a = [r for r in last if r[0] == "a"]
    assert [r[1] for r in a] == list(range(0, 65, 5))
    assert [r[3] for r in a[:4]] == ["OK", "OK", "OK", "ALARM"] and a[6][3] == "OK"


def test_gap_comes_in_bounded_steps_and_key_is_forgotten(spark, tmp_path):
    batches = [[("a", 0, 0.1)], [("a", 50_000, 0.9)], [("z", 50_010, 0.9)], [("z", 50_020, 0.9)], [("z", 50_030, 0.9)]]
    seen = list(states(spark, tmp_path, batches, missing="missing", most=4_000))
    sizes = [sum(r[0] == "a" for r in found) for found in seen]
    assert max(b - a for a, b in zip(sizes, sizes[1:])) <= 8_000
    a = [r for r in seen[-1] if r[0] == "a"]
    assert [r[1] for r in a[:10_001]] == list(range(0, 50_005, 5))
    assert a[9_999][3] == "ALARM" and a[10_000][3] == "OK"


def test_long_gap_and_many_periods_come_whole(spark, tmp_path, monkeypatch):
    """Nothing waits for a later run: neither a gap nor more periods than a frame holds."""
    monkeypatch.setattr(silence, "FRAME", 5_000)
    many = [("b", m, 0.1 if m % 7 else 0.9) for m in range(0, 60_000, 5)]
    batches = [[("a", 0, 0.1), *many[:3]], [*many[:2:-1], ("a", 60_000, 0.9)]]
    *_, last = states(spark, tmp_path, batches, n=3, m=2, missing="breaching")
    a, b = ([r[1:] for r in last if r[0] == k] for k in "ab")
    assert a == [(0, 0.1, "OK"), *((m, None, "ALARM") for m in range(5, 60_000, 5)), (60_000, 0.9, "ALARM")]
    low = [v <= 0.7 for _, _, v in many]
    assert b == [(m, v, "ALARM" if sum(low[max(0, i - 2) : i + 1]) >= 2 else "OK") for i, (_, m, v) in enumerate(many)]


def test_retired_key(spark, tmp_path):
    batches = [[("a", 0, 0.1)], [("z", 100, 0.9)], [("z", 200, 0.9)], [("a", 205, 0.9), ("z", 210, 0.9)]]
    *_, last = states(spark, tmp_path, batches, missing="missing", retire=3)
    assert [r[1:] for r in last if r[0] == "a"][:5] == [
        (0, 0.1, "ALARM"), (5, None, "ALARM"), (10, None, "ALARM"), (15, None, "ALARM"), (205, 0.9, "OK")
    ]


def test_policies_are_checked(spark):
    with pytest.raises(ValueError):
        silence.watched_alarm(spark.createDataFrame([], MEANS), missing="sometimes")


RESPONSES = "ts timestamp, request_id string, value int"


def test_repeats_and_late_rows_are_counted(spark, tmp_path):
    stream, arrive = feed(spark, tmp_path, RESPONSES)
    once = arrivals.distinct_responses(arrivals.counted(stream), within="10 minutes")
    totals = {"rows": 0, "repeats": 0, "late": 0}
    batches = [
        [(at(0), "a", 1), (at(1), "b", 2), (at(1), None, 3), (at(1), None, 3)],
        [(at(4), "a", 1), (at(5), "c", 4)],
        [(at(60), "d", 5)],
        [(at(2), "a", 1), (at(61), "e", 6)],  # too late
    ]
    for rows in batches:
        arrive(rows)
        query = (
            once.writeStream.option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True)
            .foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{tmp_path}/out/{n}")).start()
        )
        query.awaitTermination()
        for name, value in arrivals.arrival_totals(query).items():
            totals[name] += value
    done = spark.read.schema(RESPONSES).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/out")
    assert sorted(r["value"] for r in done.collect()) == [1, 2, 3, 3, 4, 5, 6]
    assert totals == {"rows": 9, "repeats": 1, "late": 1}


def test_distinct_table(spark):
    rows = [(at(3), "a", 9), (at(1), "a", 2), (at(1), "a", 1), (at(0), None, 5), (at(0), None, 5)]
    df = spark.createDataFrame(rows, RESPONSES)
    assert sorted(r["value"] for r in arrivals.distinct_responses(df).collect()) == [1, 5, 5]
    assert arrivals.distinct_responses(df.limit(0)).count() == 0


def test_p_values(spark):
    """Against sums of the density in small steps."""
    for degrees in (1, 2, 3, 4, 5):
        for x in (0.0, 0.3, 2.0, 9.0, 30.0):
            got = spark.range(1).select(drift.upper_gamma_share(degrees / 2, F.lit(x / 2))).first()[0]
            k = degrees / 2
            # substitute t = u^2, so that the density is finite at 0
            steps, top = 20_000, 12.0
            low = math.sqrt(x)
            width = (top - low) / steps
            tail = sum(
                2 * u ** (2 * k - 1) * math.exp(-u * u / 2) for u in (low + (i + 0.5) * width for i in range(steps))
            ) * width / (2**k * math.gamma(k))
            assert got == pytest.approx(tail, rel=1e-5, abs=1e-12), (degrees, x)


def test_drift_test_edges(spark):
    labels = ["entailment", "contradiction", "not_mentioned"]
    schema = "hypothesis_id string, " + ", ".join(f"{c} bigint" for c in labels)
    base = spark.createDataFrame([("q1", 500, 500, 0), ("q2", 10, 0, 0), ("q3", 0, 0, 0)], schema)
    now = spark.createDataFrame([("q1", 90, 10, 0), ("q2", 7, 0, 0), ("q3", 5, 5, 5), ("new", 1, 2, 3)], schema)
    found = {r["hypothesis_id"]: r for r in drift.drift_test(now, base).collect()}
    assert found["q1"]["drifted"] and found["q1"]["degrees"] == 1
    assert found["q1"]["statistic"] == pytest.approx(58.4912, abs=1e-4)
    assert (found["q2"]["degrees"], found["q2"]["p_value"]) == (0, 1.0)
    assert (found["q3"]["statistic"], found["q3"]["p_value"], found["q3"]["drifted"]) == (0.0, 1.0, False)
    assert found["new"]["unknown"] and found["new"]["p_value"] is None and not found["new"]["drifted"]
