"""First-look counts, distinct values and samples."""

import random

from ...operators import explore, positions
from .registry import query, scratch, table


@query(
    "language_counts",
    "SELECT lang, count(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY lang",
)
def language_counts(spark, folder):
    return explore.value_counts(table(spark, folder, "documents"), "lang")


@query("distinct_sources", "SELECT DISTINCT source FROM documents")
def distinct_sources(spark, folder):
    return table(spark, folder, "documents").select("source").distinct()


@query(
    "distinct_across_columns",
    "SELECT DISTINCT value FROM (SELECT lang AS value FROM documents UNION ALL SELECT source FROM documents)",
)
def distinct_across_columns(spark, folder):
    return explore.distinct_across(table(spark, folder, "documents"), ["lang", "source"])


@query(
    "table_profile",
    """SELECT count(*) AS rows, c AS column, CASE c WHEN 'lang' THEN 'string' ELSE 'bigint' END AS type
    FROM documents, (VALUES ('doc_id'), ('lang'), ('n_chars')) AS v(c) GROUP BY c""",
)
def table_profile(spark, folder):
    return explore.profile(table(spark, folder, "documents").select("doc_id", "lang", "n_chars"))


@query(
    "valid_counts",
    """SELECT 'text' AS column, count(text) AS valid FROM documents
    UNION ALL SELECT 'quality', count(quality) FROM documents LEFT JOIN labels USING (doc_id)""",
)
def valid_counts(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return explore.valid_counts(docs.join(labels, "doc_id", "left"), ["text", "quality"])


@query(
    "last_documents",
    "SELECT doc_id, source FROM documents ORDER BY doc_id DESC LIMIT 4",
)
def last_documents(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return explore.tail(docs, 4, ["doc_id"])


_SEED = 11


@query(
    "sampled_slice",
    f"""WITH placed AS (SELECT doc_id, source, row_number() OVER (ORDER BY doc_id) - 1 AS place,
      floor({random.Random(_SEED).random()!r}::DOUBLE * (count(*) OVER () - 4)) AS start FROM documents)
    SELECT doc_id, source FROM placed WHERE place BETWEEN start AND start + 4""",
)
def sampled_slice(spark, folder):
    """Five documents in a row from a random start."""
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return explore.sample_slice(docs, 5, _SEED, ["doc_id"])


def _stored(spark, folder):
    """Documents stored in the order of their ids, in several files, and the index of the files."""
    path = scratch(spark)
    docs = table(spark, folder, "documents").select("doc_id", "source")
    docs.repartitionByRange(8, "doc_id").sortWithinPartitions("doc_id").write.parquet(path)
    stored = spark.read.schema(docs.schema).parquet(path)
    return stored, positions.index(stored)


@query(
    "stored_batches",
    "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 7 + 1 AS batch FROM documents",
)
def stored_batches(spark, folder):
    """Batch numbers from file and row counts, no row moved."""
    stored, files = _stored(spark, folder)
    return positions.batches(stored.select("doc_id"), files, 7)


@query(
    "stored_slice",
    f"""WITH placed AS (SELECT doc_id, source, row_number() OVER (ORDER BY doc_id) - 1 AS position,
      floor({random.Random(_SEED).random()!r}::DOUBLE * (count(*) OVER () - 4)) AS start FROM documents)
    SELECT doc_id, source, position FROM placed WHERE position BETWEEN start AND start + 4""",
)
def stored_slice(spark, folder):
    """Five stored documents in a row from a random start; only their files are opened."""
    stored, files = _stored(spark, folder)
    return positions.sample(stored, files, 5, _SEED)
