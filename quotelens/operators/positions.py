"""Positions of stored rows from file and row counts: numbers, batches and slices without a sort.

The order is that of storage: files by path, rows as they lie in them. Row counts of the files come
from their footers; a row's number is the count of the rows in earlier files plus its index in its own
file. So rows are numbered where they are read, nothing is shuffled, and a slice opens only the files
that hold it. For an order by columns use ``explore`` and ``prepare``, or write the table in that order.

``df`` is a Parquet scan (columns may be chosen, rows not). An index belongs to the files as they were;
after a change take a new one.

Edge cases: empty files and tables have no positions; repeated rows have one each; values, null or not,
are not looked at. Memory: one row a file, broadcast if ``joins.fits`` finds it small, else joined.
"""

import random

from pyspark.sql import Window, functions as F

from ..session import settle
from .joins import join_small

_FILE, _ROW, _BEFORE = "_position_file", "_position_row", "_position_before"
_FEW = 1_000


def index(df):
    """One row a file in the shared folder: path, ``rows`` and rows in the files before it."""
    counts = df.select(F.col("_metadata.file_path").alias(_FILE)).groupBy(_FILE).agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy(F.lit(0)).orderBy(_FILE).rowsBetween(Window.unboundedPreceding, -1)
    return settle(counts.withColumn(_BEFORE, F.coalesce(F.sum("rows").over(earlier), F.lit(0))))


def numbered(df, files, name="position"):
    """``df`` with each row's position, from 0."""
    if name in df.columns:
        raise ValueError(f"the table has a column {name}")
    placed = df.select("*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_ROW))
    joined = join_small(placed, files.select(_FILE, _BEFORE), _FILE)
    return joined.withColumn(name, F.col(_BEFORE) + F.col(_ROW)).drop(_FILE, _ROW, _BEFORE)


def batches(df, files, size, name="batch"):
    """Mini-batch number of each row, from 1."""
    if size < 1:
        raise ValueError("a batch has at least one row")
    return numbered(df, files, name).withColumn(name, F.expr(f"`{name}` div {int(size)} + 1"))


def between(df, files, first, n, name="position"):
    """The ``n`` rows from position ``first`` on, with their positions."""
    held = files.filter((F.col(_BEFORE) < first + n) & (F.col(_BEFORE) + F.col("rows") > first))
    few = [r[0] for r in held.select(_FILE).limit(_FEW + 1).collect()]
    if len(few) <= _FEW:  # others are not opened; beyond that the join leaves them out
        df = df.filter(F.col("_metadata.file_path").isin(few))
    return numbered(df, held, name).filter(F.col(name).between(first, first + n - 1))


def sample(df, files, k, seed, name="position"):
    """``k`` rows in a row from a random start, with their positions."""
    total = files.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    if total < k:
        raise ValueError(f"{k} rows asked for, table has {total}")
    return between(df, files, int(random.Random(seed).random() * (total - k + 1)), k, name)
