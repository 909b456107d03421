"""Sharding by jump consistent hashing.

A key hash and the number of shards decide the shard; there is no ring table. Going from n to
n + 1 shards moves a row either nowhere or into the new shard.

Edge cases: null keys hash like any other value, so they share a shard. Repeated rows have one
key and so one shard, with a slot each. An empty table gives an empty result. Columns of the
input that bear the name of a result are replaced by it.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window, functions as F

from ..operators.joins import join_small
from ..session import settle

_STEP = np.uint64(2862933555777941757)  # fixed value of the published algorithm


def jump(keys, shards):
    """Shard 0 .. ``shards - 1`` of each 64-bit key of an array."""
    keys = keys.astype(np.uint64)
    shard = np.zeros(len(keys), np.int64)
    following = np.zeros(len(keys), np.int64)
    moving = np.arange(len(keys))
    while len(moving):
        shard[moving] = following[moving]
        keys[moving] = keys[moving] * _STEP + np.uint64(1)
        share = float(1 << 31) / ((keys[moving] >> np.uint64(33)).astype(np.float64) + 1)
        following[moving] = ((shard[moving] + 1) * share).astype(np.int64)
        moving = moving[following[moving] < shards]
    return shard


def jump_shard(key, shards):
    """Column expression: the shard of ``key``, a column of any type.

    The key is hashed as text, so an id has one shard whatever its type.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf("int")
    def assign(hashes: pd.Series) -> pd.Series:
        return pd.Series(jump(hashes.to_numpy(np.int64), shards).astype(np.int32))

    return assign(F.xxhash64(F.col(key).cast("string")))


def shard_rows(df, key, shards, name="shard", grown=None):
    """``df`` with the shard of each row, and in ``grown`` the shard were there one more."""
    df = df.withColumn(name, jump_shard(key, shards))
    return df if grown is None else df.withColumn(grown, jump_shard(key, shards + 1))


def number_slots(df, shard="shard", name="slot"):
    """Position of each row within its shard, without gaps from 0.

    Rows are numbered inside the task that read them, and a small table with a row for each
    task and shard says how many rows come before: no shard passes through one task, and rows
    that repeat a key spread as they were read. ``df`` is written to the shared folder first,
    so that the numbers stay when a task runs again.
    """
    row, part, before = "__row", "__part", "__before"
    placed = settle(df.drop(name).withColumn(row, F.monotonically_increasing_id()))
    placed = placed.withColumn(part, F.shiftright(row, 33))
    sizes = placed.groupBy(shard, part).agg(F.count(F.lit(1)).alias(before))
    earlier = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    here = F.row_number().over(Window.partitionBy(shard, part).orderBy(row)) - 1
    numbered = placed.withColumn(name, here)
    return (
        join_small(numbered, offsets, [shard, part])
        .withColumn(name, F.col(name) + F.col(before))
        .drop(row, part, before)
    )


def write_shards(df, path, key, shards, name="shard"):
    """Parquet folders ``<name>=<i>`` with the rows of each shard.

    A shard comes as several files of about the session's advisory partition size.
    """
    placed = shard_rows(df, key, shards, name)
    placed.hint("rebalance", name).write.partitionBy(name).parquet(path)
