import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from quotelens.operators import monitor as mon

ANSWER = "struct<hypothesis_id:string,label:string,hypothesis:string,source_clause:string>"
CONTRACT = "the receiving party shall not copy the documents of the disclosing party"


def answers(*pairs):
    return [(f"q{i}", label, "h", clause) for i, (label, clause) in enumerate(pairs)]


REQUESTS = [
    (1, CONTRACT, answers(("not_mentioned", ""), ("not_mentioned", "made up words here"))),
    (2, CONTRACT, answers(("entailment", "the receiving party shall"), ("contradiction", "of the"))),
    (3, CONTRACT, answers(("entailment", "the receiving party may not"), ("not_mentioned", ""))),
    (4, CONTRACT, answers(("entailment", None), ("entailment", CONTRACT))),
]
WANT = {1: 1.0, 2: 0.5, 3: 1 / 3, 4: 0.5}


@pytest.fixture(scope="module")
def requests(spark):
    return spark.createDataFrame(REQUESTS, f"request_id int, contract string, answers array<{ANSWER}>")


def test_grounding_in_the_row_and_over_tables(requests):
    in_row = {r.request_id: r.carp for r in mon.carp_in_row(requests).collect()}
    flat = requests.select("request_id", F.posexplode("answers").alias("position", "a")).select("request_id", "position", "a.*")
    contracts = requests.select("request_id", F.col("contract").alias("text"))
    tables = {r.request_id: r.carp for r in mon.carp(flat, contracts).collect()}
    for i, want in WANT.items():
        assert math.isclose(in_row[i], want) and math.isclose(tables[i], want)


def at(minute, day=1):
    return dt.datetime(2024, 1, day, minute // 60, minute % 60)


def test_metric_points(spark, requests):
    scored = mon.carp_in_row(requests).filter("request_id = 2").select(
        "answers", "carp", F.lit("e").alias("endpoint"), F.lit("a").alias("adapter"),
        F.lit("2024-01-01 00:00:01.75").cast("timestamp").alias("ts"),
    )
    points = [(r.metric, r.dims, r.value) for r in mon.to_metric_points(scored).collect()]
    own = {"model_endpoint": "e", "model_adapter": "a"}
    assert sorted(points, key=str) == sorted(
        [
            ("Hlabel_q0", {"label": "entailment"}, 1.0),
            ("Hlabel_q1", {"label": "contradiction"}, 1.0),
            ("Hlabel_q0", {**own, "label": "entailment"}, 1.0),
            ("Hlabel_q1", {**own, "label": "contradiction"}, 1.0),
            ("CARP_3", {}, 0.5),
            ("CARP_3", own, 0.5),
        ],
        key=str,
    )
    stamp = mon.to_metric_points(scored).select(F.date_format("ts", "ss.SSS")).first()[0]
    assert stamp == "01.000"


def states(spark, points, keys=(), **options):
    df = spark.createDataFrame(points, "ts timestamp, value double, owner string")
    means = mon.period_means(df, keys=keys)
    rows = mon.alarm_state(means, keys=keys, **options).orderBy(*keys, "period").collect()
    return [r.state for r in rows]


def test_threshold_and_missing_periods(spark):
    points = [(at(0), 0.7, "x"), (at(20), 0.9, "x"), (at(25), 0.8, "x"), (at(25), 0.6, "x"), (at(31), 0.71, "x")]
    # 0.7 breaches; 5 to 15 have no data; 25 has a mean of 0.7; 30 is fine.
    assert states(spark, points) == ["ALARM", "OK", "OK", "OK", "OK", "ALARM", "OK"]
    kept = ["ALARM", "ALARM", "ALARM", "ALARM", "OK", "ALARM", "OK"]
    assert states(spark, points, missing="missing") == kept
    assert states(spark, points, missing="ignore") == kept
    with pytest.raises(ValueError):
        states(spark, points, missing="other")


def test_m_of_n_per_owner(spark):
    low = {"x": (0, 10), "y": (5, 10, 15)}
    points = [(at(m), 0.1 if m in low[o] else 1.0, o) for o in "xy" for m in range(0, 30, 5)]
    got = states(spark, points, keys=("owner",), n=3, m=2)
    assert got[:6] == ["OK", "OK", "ALARM", "OK", "OK", "OK"]
    assert got[6:] == ["OK", "OK", "ALARM", "ALARM", "ALARM", "OK"]


def test_edges(spark):
    df = spark.createDataFrame(
        [(at(m), s, o) for o, row in {"x": "OAAOA", "y": "AOOOO"}.items() for m, s in zip(range(0, 25, 5), row)],
        "period timestamp, state string, owner string",
    )
    df = df.replace({"O": "OK", "A": "ALARM"}, subset=["state"])
    edges = mon.alarm_edges(df, ["owner"]).orderBy("owner", "period").collect()
    assert [(e.owner, e.period.minute, e.state) for e in edges] == [
        ("x", 5, "ALARM"), ("x", 15, "OK"), ("x", 20, "ALARM"), ("y", 0, "ALARM"), ("y", 5, "OK"),
    ]


def test_drift(spark):
    def counts(rows):
        return spark.createDataFrame(rows, "hypothesis_id string, label string, count long")

    now = counts([("q1", "entailment", 10), ("q2", "entailment", 5), ("q2", "contradiction", 5)])
    base = counts([("q1", "entailment", 6), ("q1", "contradiction", 4), ("q2", "entailment", 50), ("q2", "contradiction", 50)])
    got = {(r.hypothesis_id, r.label): r for r in mon.label_drift(now, base, 0.2).collect()}
    assert got["q1", "entailment"].one_sided and got["q1", "entailment"].drifted
    assert math.isclose(got["q1", "contradiction"].change, 0.4) and got["q1", "contradiction"].share == 0
    assert not got["q2", "entailment"].drifted and not got["q2", "entailment"].one_sided


def test_live_arrivals_come_in_time_order_over_months(spark):
    from quotelens.plans.queries import monitoring

    events = spark.sql("SELECT timestamp'2024-01-05 10:00:00' + make_interval(0, 0, 0, id) AS ts FROM range(70)")
    arrivals = [sorted(r["ts"] for r in a.collect()) for a in monitoring._arrivals(events)]
    assert [len(a) for a in arrivals] == [10, 10, 50]
    assert sum(arrivals, []) == sorted(r["ts"] for r in events.collect())
    assert all(a.count() == 0 for a in monitoring._arrivals(events.limit(0)))
