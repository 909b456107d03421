import math

import pytest
from pyspark.sql import functions as F

from quotelens.operators import runs

LOG = "run string, step long, loss double, eval_loss double"


def test_series_prefers_training_loss(spark):
    rows = [("r", 1, 0.5, None), ("r", 2, None, 0.4), ("r", 3, 0.3, 0.2), ("r", 4, None, None)]
    got = runs.loss_series(spark.createDataFrame(rows, LOG)).orderBy("step").collect()
    assert [tuple(r) for r in got] == [(1, "loss", 0.5), (2, "eval_loss", 0.4), (3, "loss", 0.3)]


def test_best_step_takes_the_earlier_of_equals(spark):
    rows = [("r", s, None, e) for s, e in [(10, 0.5), (20, 0.3), (30, 0.3), (40, None)]]
    assert tuple(runs.best_step(spark.createDataFrame(rows, LOG)).first()) == ("r", 20, 0.3)


def test_early_stop(spark):
    losses = {
        "never": [1.0, 0.9, 0.8, 0.7],
        "stalls": [1.0, 0.9, 0.8995, 0.8991, 0.5],
        "recovers": [1.0, 1.1, 0.9, 0.95, 0.85, 0.9],
        "rises": [1.0, 1.1, 1.2],
        "edge": [1.0, 0.999, 0.998],
    }
    rows = [(r, 10 * i, None, e) for r, es in losses.items() for i, e in enumerate(es)]
    losses[None] = losses["rises"]
    rows += [(None, 10 * i, None, e) for i, e in enumerate(losses[None])]
    rows += [("never", 5, 0.1, None)]
    df = spark.createDataFrame(rows, LOG).repartition(3)
    got = {r.run: r.stop_step for r in runs.early_stop(df).collect()}

    def brute(es):
        best, waited = None, 0
        for i, e in enumerate(es):
            if best is None or best - e > 1e-3:
                waited = 0
            else:
                waited += 1
                if waited == 2:
                    return 10 * i
            best = e if best is None else min(best, e)

    assert got == {r: brute(es) for r, es in losses.items()}
    assert got["stalls"] == 30 and got["never"] is None


@pytest.mark.parametrize(
    "requests, failed, clients, latency, tokens, want",
    [
        (40, 2, 4, 46591.43, 19456, (5.0, 0.09, 43.96, 486)),
        (35, 4, 7, 161087.93, 15872, (11.43, 0.04, 22.25, 453)),
        (20, 0, 10, 7395.78, 1236, (0.0, 1.35, 83.56, 61)),
    ],
)
def test_published_summaries(spark, requests, failed, clients, latency, tokens, want):
    """Rates follow from the published totals."""
    rows = [(i % clients, i, latency, latency, tokens if i == 0 else 0, i < failed) for i in range(requests)]
    df = spark.createDataFrame(rows, "client int, start_ms long, latency_ms double, first_byte_ms double, tokens long, failed boolean")
    row = runs.bench_summary(df).first()
    got = (row.errorRate, row.tps, row.tokenThroughput, row.tokenPerRequest)
    assert tuple(round(x, 2) for x in got) == want
    assert math.isclose(row.p99Latency, latency) and row.totalRequests == requests


def test_gaps(spark):
    rows = [("a", t) for t in (0, 5, 5, 1000, 99_999)] + [("b", 7), ("b", None)]
    df = spark.createDataFrame(rows, "client string, ts_ms long").repartition(3)
    gaps = runs.request_gap(df).fillna(-1).collect()
    assert sorted((r.client, r.ts_ms, r.gap_ms) for r in gaps) == [
        ("a", 0, 5), ("a", 5, 0), ("a", 5, 995), ("a", 1000, 98_999), ("a", 99_999, -1),
        ("b", -1, -1), ("b", 7, -1),
    ]


def test_length_statistics(spark):
    df = spark.createDataFrame([("x",) * 1 for _ in range(1)] + [("xxx",), ("xxxxx",)], "t string")
    exact = runs.length_stats(df, F.length("t")).first()
    assert (exact["count"], exact["mean"], exact["min"], exact["max"], exact["p50"]) == (3, 3.0, 1, 5, 3.0)
    assert runs.length_stats(df, F.length("t"), exact=False).first()["p50"] == 3
