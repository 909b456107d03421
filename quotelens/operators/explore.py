"""Counts, distinct values and samples for a first look at a table."""

import random

from pyspark.sql import functions as F

from .ordered import rows_between


def value_counts(df, column):
    """Rows per value, most frequent first; nulls are left out."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), column)
    )


def distinct_across(df, columns, name="value"):
    """Distinct values of several columns laid end to end."""
    values = F.array(*[F.col(c).cast("string") for c in columns])
    return df.select(F.explode(values).alias(name)).distinct()


def profile(df):
    """One row per column: name, type and the number of rows of the table."""
    columns = F.array(
        *[
            F.struct(F.lit(name).alias("column"), F.lit(kind).alias("type"))
            for name, kind in df.dtypes
        ]
    )
    return df.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.inline(columns))


def valid_counts(df, columns):
    """Non-null values per column, in one pass."""
    counted = df.agg(*[F.count(c).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("valid")) for c in columns]
    )
    return counted.select(F.inline(pairs))


def head(df, n, order):
    """First n rows along the order."""
    return df.orderBy(*order).limit(n)


def tail(df, n, order):
    """Last n rows along the order."""
    return df.orderBy(*[F.desc(c) if isinstance(c, str) else c.desc() for c in order]).limit(n)


def sample_slice(df, k, seed, order):
    """k rows in a row of the order, from a random start."""
    total = df.count()
    if total < k:
        raise ValueError(f"{k} rows asked for, table has {total}")
    start = int(random.Random(seed).random() * (total - k + 1))
    return rows_between(df, order, start, k)
