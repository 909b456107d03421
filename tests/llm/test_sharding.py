from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from quotelens.llm import sharding

MASK = (1 << 64) - 1


def one_jump(key, shards):
    shard, following = -1, 0
    while following < shards:
        shard = following
        key = (key * 2862933555777941757 + 1) & MASK
        following = int((shard + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return shard


def test_jump_equals_the_scalar_rule():
    keys = np.random.default_rng(0).integers(-(2**63), 2**63 - 1, 2_000)
    for shards in (1, 2, 8, 9, 1_000):
        assert sharding.jump(keys, shards).tolist() == [
            one_jump(int(k) & MASK, shards) for k in keys
        ]


def test_a_new_shard_only_takes_rows(spark):
    df = sharding.shard_rows(spark.range(5_000), "id", 8, "shard", "grown").toPandas()
    moved = df[df.shard != df.grown]
    assert set(moved.grown) == {8} and 400 < len(moved) < 720
    assert df.shard.value_counts().min() > 500


def test_slots_are_gapless_and_edges_are_defined(spark):
    rows = [(None, "n", 1), (None, "n", 1), (1, "a", 5), (1, "a", 5), (2, None, 7), (3, "", 9)]
    df = spark.createDataFrame(rows * 30, "id bigint, text string, slot int").repartition(3)
    df = df.withColumns({"part": F.lit("x"), "before": F.lit("y"), "row": F.lit(0)})
    out = sharding.number_slots(sharding.shard_rows(df, "id", 4)).collect()
    by_shard = {}
    for r in out:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert Counter((r["id"], r["text"]) for r in out) == Counter(r[:2] for r in rows * 30)
    assert len({r["shard"] for r in out if r["id"] is None}) == 1
    assert {r["part"] for r in out} == {"x"}


def test_empty(spark):
    df = spark.createDataFrame([], "id bigint")
    assert sharding.number_slots(sharding.shard_rows(df, "id", 4, "shard", "grown")).collect() == []


def test_written_shards(spark, tmp_path):
    df = spark.range(500).withColumn("text", F.lit("t"))
    sharding.write_shards(df, f"{tmp_path}/out", "id", 5)
    back = spark.read.parquet(f"{tmp_path}/out")
    want = {r["id"]: r["shard"] for r in sharding.shard_rows(df, "id", 5).collect()}
    assert {r["id"]: r["shard"] for r in back.collect()} == want
