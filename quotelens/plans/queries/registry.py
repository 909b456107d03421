"""Named queries over a folder of tables, each with its SQL twin where SQL can say it."""

import uuid

from pyspark.sql import functions as F

from ...session import shared_folder
from ...sources.readers import spread

QUERIES = {}
SQL = {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark, folder, *columns):
    """Columns of the documents, on all cores."""
    return spread(table(spark, folder, "documents").select("doc_id", *columns), "doc_id")


def scratch(spark):
    """A new path under the shared folder."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def r6(column, name):
    return F.round(column, 6).alias(name)


# SQL pieces ---------------------------------------------------------------------------

TOKENS = "regexp_extract_all(lower({0}), '[a-z0-9]+')"
TRIGRAMS = (
    "list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])"
)


def sql_scores(pairs):
    """CTEs ending in ``scores(pid, o, np, nt)`` from ``pairs(pid, target, prediction)``."""
    return f"""
    tt AS (SELECT pid, {TOKENS.format('target')} AS t FROM {pairs}),
    pt AS (SELECT pid, {TOKENS.format('prediction')} AS t FROM {pairs}),
    tg AS (SELECT pid, g, count(*) AS n FROM (SELECT pid, unnest({TRIGRAMS}) AS g FROM tt) GROUP BY pid, g),
    pg AS (SELECT pid, g, count(*) AS n FROM (SELECT pid, unnest({TRIGRAMS}) AS g FROM pt) GROUP BY pid, g),
    ov AS (SELECT pg.pid, sum(least(tg.n, pg.n)) AS o FROM pg JOIN tg ON pg.pid = tg.pid AND pg.g = tg.g GROUP BY pg.pid),
    scores AS (
      SELECT {pairs}.pid, coalesce(o, 0) AS o,
             greatest(coalesce(len(pt.t), 0) - 2, 0) AS np, greatest(coalesce(len(tt.t), 0) - 2, 0) AS nt
      FROM {pairs} JOIN tt ON tt.pid = {pairs}.pid JOIN pt ON pt.pid = {pairs}.pid
      LEFT JOIN ov ON ov.pid = {pairs}.pid)"""


PRECISION = "o / greatest(np, 1)"
RECALL = "o / greatest(nt, 1)"
FMEASURE = (
    f"CASE WHEN o > 0 THEN 2 * ({PRECISION}) * ({RECALL}) / (({PRECISION}) + ({RECALL})) ELSE 0.0 END"
)
