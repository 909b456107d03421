import math

import numpy as np
import pytest

from quotelens.operators import sketches

SCHEMA = "endpoint string, ts timestamp, v double"
MARKS = (0, 0.25, 0.5, 0.9, 0.99, 1)


def disc(values, p):
    """The first value whose rank reaches the share ``p``."""
    values = sorted(values)
    return values[max(math.ceil(p * len(values)) - 1, 0)]


def timed(spark, rows):
    df = spark.createDataFrame(rows, "endpoint string, seconds long, v double")
    return df.selectExpr("endpoint", "timestamp_seconds(seconds) AS ts", "v").repartition(3)


def test_small_groups_are_exact_however_merged(spark):
    rng = np.random.default_rng(0)
    rows = [(str(i % 2), int(rng.integers(0, 86400)), float(rng.integers(0, 40))) for i in range(600)]
    hours = sketches.sketched(timed(spark, rows), ["v"], ["endpoint"])
    assert hours.count() > 40
    for merged, keys in (
        (sketches.merged(hours, ["v"], ["endpoint"], "1 day"), "01"),
        (sketches.merged(sketches.merged(hours, ["v"], ["endpoint"], "6 hours"), ["v"], ["endpoint"]), "01"),
        (sketches.merged(hours, ["v"]), [None]),
    ):
        out = sketches.percentiles(merged, ["v"], MARKS).collect()
        assert len(out) == len(keys)
        for row in out:
            key = row["endpoint"] if keys != [None] else None
            own = [v for e, _, v in rows if key in (None, e)]
            assert row["v_count"] == len(own)
            assert [row[f"p{100 * p:g}_v"] for p in MARKS] == [disc(own, p) for p in MARKS]


@pytest.mark.parametrize("k", [100, 800])
def test_large_groups_keep_the_bound(spark, k):
    df = spark.range(300_000, numPartitions=6).selectExpr(
        "timestamp_seconds(id % 360000) AS ts", "pow(hash(id) % 1000 / 100.0, 3) AS v"
    )
    values = np.sort([r["v"] for r in df.select("v").collect()])
    merged = sketches.merged(sketches.sketched(df, ["v"], k=k), ["v"], k=k)
    (row,) = sketches.percentiles(merged, ["v"], MARKS).collect()
    assert row["v_count"] == len(values) and (row["p0_v"], row["p100_v"]) == (values[0], values[-1])
    slack = 3 * sketches.rank_error(k)
    for p in MARKS:
        low, high = (np.searchsorted(values, row[f"p{100 * p:g}_v"], s) / len(values) for s in ("left", "right"))
        assert low <= p + slack and high >= p - slack


def test_edges(spark):
    nan, inf = math.nan, math.inf
    rows = [("b", 5, None), ("b", 6, nan), (None, 5, inf), (None, 7200, -inf), ("a", None, 1.0), ("a", 9, 2.0), ("a", 9, 2.0)]
    hours = sketches.sketched(timed(spark, rows), ["v"], ["endpoint"])
    out = sketches.percentiles(sketches.merged(hours, ["v"], ["endpoint"], "1 day"), ["v"], (0, 1))
    got = {r["endpoint"]: (r["v_count"], r["p0_v"], r["p100_v"]) for r in out.collect()}
    assert got == {"a": (2, 2.0, 2.0), "b": (0, None, None), None: (2, -inf, inf)}
    empty = sketches.sketched(timed(spark, []), ["v"])
    assert sketches.percentiles(sketches.merged(empty, ["v"]), ["v"]).count() == 0
    with pytest.raises(ValueError):
        sketches.sketched(timed(spark, rows), ["v"], ["period"])
