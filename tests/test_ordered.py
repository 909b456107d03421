import random

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from quotelens.operators import explore, ordered


@pytest.fixture(scope="module")
def hot(spark):
    """One key holds most rows."""
    rng = random.Random(5)
    rows = [
        ("hot" if rng.random() < 0.6 else rng.choice("abc"), i * rng.choice([1, 1, 1]), rng.choice([None, *range(40)]))
        for i in range(600)
    ]
    return spark.createDataFrame(rows, "k string, t long, v int").repartition(6)


def same(left, right):
    return sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


@pytest.fixture(scope="module")
def odd(spark):
    """Null keys, null and repeated order values, a burst."""
    rng = random.Random(6)
    rows = [
        (rng.choice([None, "hot", "hot", "a"]), rng.choice([None, 3, 3, rng.randrange(900)]), i)
        for i in range(700)
    ]
    return spark.createDataFrame(rows, "k string, t long, v int").repartition(5)


def test_row_numbers(hot, odd):
    want = hot.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("t")).cast("long"))
    assert same(ordered.row_numbers(hot, ["k"], ["t"], "n").select(want.columns), want)
    full = Window.partitionBy("k").orderBy("t", "v")
    want = odd.withColumn("n", F.row_number().over(full).cast("long"))
    assert same(ordered.row_numbers(odd, ["k"], ["t", "v"], "n").select(want.columns), want)
    by_text = odd.select(F.concat(F.lit("x"), F.col("v").cast("string")).alias("s"))
    want = by_text.withColumn("n", F.row_number().over(Window.orderBy(F.desc("s"))).cast("long"))
    assert same(ordered.row_numbers(by_text, [], [F.desc("s")], "n"), want)


def test_ties_are_numbered_without_gaps_and_spread_over_parts(spark):
    rows = spark.range(4_000).select(F.lit(1).alias("k"), F.lit(None).cast("int").alias("t"))
    numbers = [r["n"] for r in ordered.row_numbers(rows, ["k"], ["t"], "n").collect()]
    assert sorted(numbers) == list(range(1, 4_001))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = ordered.in_parts(rows, ["k"], ["t"]).groupBy("_part").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 2 and max(r["count"] for r in sizes) < 3_000


@pytest.fixture
def many_parts(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def _check_running(df):
    w = Window.partitionBy("k").orderBy("t", "v")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select(
        "*",
        F.min("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("lo"),
        F.max("v").over(upto).alias("hi"),
        F.coalesce(F.sum("v").over(upto), F.lit(0)).alias("total"),
    )
    columns = {
        "lo": ("min", F.col("v"), True),
        "hi": ("max", F.col("v"), False),
        "total": ("sum", F.col("v"), False),
    }
    assert same(ordered.running(df, ["k"], ["t", "v"], columns).select(want.columns), want)
    want = df.withColumn("x", F.lead("v").over(w))
    assert same(ordered.next_value(df, ["k"], ["t", "v"], F.col("v"), "x").select(want.columns), want)
    want = df.withColumn("n", F.row_number().over(w).cast("long"))
    assert same(ordered.row_numbers(df, ["k"], ["t", "v"], "n").select(want.columns), want)


def test_running_and_next(hot, odd):
    _check_running(hot)
    _check_running(odd)


def test_results_do_not_depend_on_parts(hot, odd, many_parts):
    _check_running(hot)
    _check_running(odd)


def test_percentiles_are_exact(spark):
    rng = random.Random(9)
    rows = [("hot" if i % 3 else rng.choice("ab"), rng.choice([0.0, -3.5, 1e9, rng.gauss(0, 100)]), None if i % 5 else float(i)) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, x double, y double").repartition(5)
    marks = (0.0, 0.1, 0.5, 0.9, 0.99, 1.0)
    got = {r.k: r for r in ordered.exact_percentiles(df, ["k"], {"x": "x", "y": "y"}, marks).collect()}
    for key in ("hot", "a", "b"):
        for i, name in ((1, "x"), (2, "y")):
            values = [r[i] for r in rows if r[0] == key and r[i] is not None]
            for p in marks:
                assert np.isclose(got[key][f"{name}{p * 100:g}"], np.quantile(values, p)), (key, name, p)


def test_odd_numbers_and_spread_values(spark, many_parts):
    nan, inf = float("nan"), float("inf")
    rows = [(v,) for v in [nan, inf, -inf, -0.0, 0.0, None, 1.0]]
    df = spark.createDataFrame(rows, "x double")
    got = ordered.exact_percentiles(df, [], {"x": "x"}, (0.0, 0.2, 0.4, 0.6, 0.8, 1.0)).first()
    assert [str(v) for v in got] == ["-inf", "0.0", "0.0", "1.0", "inf", "nan"]
    close = spark.range(20_000).select((100 + F.col("id") / 20_000).alias("x"))
    got = ordered.exact_percentiles(close, [], {"x": "x"}, (0.5, 0.99)).first()
    assert np.allclose(got, np.quantile(100 + np.arange(20_000) / 20_000, [0.5, 0.99]))


def test_slices(hot, odd, many_parts):
    order = [r.t for r in hot.orderBy("t").collect()]
    got = ordered.rows_between(hot, ["t"], 95, 30)
    assert sorted(r.t for r in got.collect()) == order[95:125]
    sample = sorted(r.t for r in explore.sample_slice(hot, 5, 1, ["t"]).collect())
    start = order.index(sample[0])
    assert sample == order[start : start + 5]
    again = sorted(r.t for r in explore.sample_slice(hot.repartition(2), 5, 1, ["t"]).collect())
    assert sample == again
    for seed in range(4):
        assert explore.sample_slice(odd, 5, seed, ["k", "t"]).count() == 5
    with pytest.raises(ValueError):
        explore.sample_slice(hot.limit(3), 5, 1, ["t"])


def test_first_looks(hot):
    counts = explore.value_counts(hot, "v").collect()
    assert counts[0]["count"] == max(r["count"] for r in counts)
    assert all(r.v is not None for r in counts)
    assert {r.value for r in explore.distinct_across(hot.select("k", "v"), ["k", "k"]).collect()} == {"hot", "a", "b", "c"}
    assert {(r.column, r.type, r.rows) for r in explore.profile(hot).collect()} == {
        ("k", "string", 600), ("t", "bigint", 600), ("v", "int", 600),
    }
    valid = {r.column: r.valid for r in explore.valid_counts(hot, ["k", "v"]).collect()}
    assert valid == {"k": 600, "v": hot.filter("v is not null").count()}
    assert [r.t for r in explore.tail(hot, 2, ["t"]).collect()] == [599, 598]
