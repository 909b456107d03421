"""Raw rows to curated documents."""

from pyspark.sql import functions as F

from ...functions import chat
from ...operators import curate as cur
from . import standins as st
from .registry import query, table

_CLAUSE = "array_to_string(evidence_texts, '. ')"
_ANSWER = f"concat_ws('|', hypothesis_id, label, hypothesis, {_CLAUSE})"


@query(
    "labels_normalised",
    f"""WITH {st.RAW_SQL} SELECT document_id, turn, label FROM raw""",
)
def labels_normalised(spark, folder):
    return cur.normalise_label(st.raw_rows(spark, folder)).select("document_id", "turn", "label")


@query(
    "mentioned_rows",
    f"""WITH {st.RAW_SQL} SELECT document_id, turn, label FROM raw WHERE raw_label <> 'notmentioned'""",
)
def mentioned_rows(spark, folder):
    return cur.drop_unmentioned(st.raw_rows(spark, folder)).select("document_id", "turn", "label")


@query(
    "answer_fields",
    f"""WITH {st.RAW_SQL}
    SELECT document_id, turn, hypothesis_id, raw_label AS hypothesis_label, hypothesis,
           {_CLAUSE} AS source_clause FROM raw""",
)
def answer_fields(spark, folder):
    """Answer struct under the label name of the older files."""
    answer = chat.answer_struct(label_name="hypothesis_label")
    return st.raw_rows(spark, folder).select("document_id", "turn", answer.alias("a")).select(
        "document_id", "turn", "a.*"
    )


@query(
    "answer_texts",
    f"""WITH {st.RAW_SQL}
    SELECT document_id, turn,
           to_json({{'hypothesis': hypothesis, 'evidence': array_to_string(evidence_texts, chr(10)),
                    'hypothesis_label': raw_label}})::VARCHAR AS answer FROM raw""",
)
def answer_texts(spark, folder):
    return st.raw_rows(spark, folder).select("document_id", "turn", chat.answer_text().alias("answer"))


@query(
    "first_rows",
    f"""WITH {st.RAW_SQL}
    SELECT document_id, text FROM raw WHERE (document_id, turn) IN
      (SELECT (document_id, min(turn)) FROM raw GROUP BY document_id)""",
)
def first_rows(spark, folder):
    rows = st.raw_rows(spark, folder).select("document_id", "turn", "text")
    return cur.first_per_doc(rows, ["turn"]).select("document_id", "text")


@query(
    "grouped_answers",
    """SELECT conv_id, string_agg(role || ':' || length(text), ',' ORDER BY turn) AS turns
    FROM conversations GROUP BY conv_id""",
)
def grouped_answers(spark, folder):
    rows = table(spark, folder, "conversations")
    item = F.concat_ws(":", "role", F.length("text"))
    grouped = cur.group_answers(rows, ["turn"], item, "conv_id", "turns")
    return grouped.select("conv_id", F.array_join("turns", ",").alias("turns"))


@query(
    "curated_documents",
    f"""WITH {st.RAW_SQL}
    SELECT document_id, first(text ORDER BY turn) AS text, count(*) AS answers,
           string_agg({_ANSWER}, '#' ORDER BY turn) AS inference,
           '' AS model_repo, '' AS model_repo_version, '2024-01-01 00:00:00' AS stamp,
           'in_house' AS origin
    FROM raw GROUP BY document_id""",
)
def curated_documents(spark, folder):
    """The whole curation: recode, check, nest, provenance, one shuffle."""
    stamp = F.lit("2024-01-01").cast("timestamp")
    documents = cur.curate(st.raw_rows(spark, folder), ["turn"], ts=stamp)
    answers = F.transform(
        "inference",
        lambda a: F.concat_ws("|", a["hypothesis_id"], a["label"], a["hypothesis"], a["source_clause"]),
    )
    return documents.select(
        "document_id",
        "text",
        F.size("inference").cast("long").alias("answers"),
        F.array_join(answers, "#").alias("inference"),
        "model_repo",
        "model_repo_version",
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        "origin",
    )


@query(
    "curated_mentioned_only",
    f"""WITH {st.RAW_SQL}
    SELECT document_id, first(text ORDER BY turn) AS text, count(*) AS answers,
           string_agg({_ANSWER}, '#' ORDER BY turn) AS inference
    FROM raw WHERE label <> 'not_mentioned' GROUP BY document_id""",
)
def curated_mentioned_only(spark, folder):
    """Older variant: unmentioned rows are dropped first, documents without rows vanish."""
    rows = cur.drop_unmentioned(st.raw_rows(spark, folder))
    answers = F.transform(
        "inference",
        lambda a: F.concat_ws("|", a["hypothesis_id"], a["label"], a["hypothesis"], a["source_clause"]),
    )
    return cur.curate(rows, ["turn"]).select(
        "document_id",
        "text",
        F.size("inference").cast("long").alias("answers"),
        F.array_join(answers, "#").alias("inference"),
    )


@query(
    "curated_in_parts",
    f"""WITH {st.RAW_SQL}, placed AS (
      SELECT *, (row_number() OVER w - 1) // 4 AS part, first(text) OVER w AS first_text
      FROM raw WINDOW w AS (PARTITION BY document_id ORDER BY turn))
    SELECT document_id, part, count(*) AS answers, first_text AS text,
           string_agg(hypothesis_id, ',' ORDER BY turn) AS ids
    FROM placed GROUP BY document_id, part, first_text""",
)
def curated_in_parts(spark, folder):
    """Lists longer than the limit come as consecutive rows; nothing is lost."""
    documents = cur.curate(st.raw_rows(spark, folder), ["turn"], limit=4)
    return documents.select(
        "document_id",
        F.col("part").cast("long").alias("part"),
        F.size("inference").cast("long").alias("answers"),
        "text",
        F.array_join(F.col("inference.hypothesis_id"), ",").alias("ids"),
    )


@query(
    "exploded_answers",
    f"""WITH {st.RAW_SQL}
    SELECT document_id, hypothesis, raw_label AS label FROM raw""",
)
def exploded_answers(spark, folder):
    """Nest long-form rows and flatten them again."""
    rows = st.raw_rows(spark, folder)
    item = F.struct("hypothesis", "label")
    nested = cur.group_answers(rows, ["turn"], item, name="hypothesises/labels")
    return cur.explode_hypotheses(nested.drop("part"))


@query(
    "provenance_columns",
    """SELECT doc_id, '' AS model_repo, '' AS model_repo_version,
           '2024-01-31 09:30:00' AS stamp, source AS origin FROM documents""",
)
def provenance_columns(spark, folder):
    stamp = F.lit("2024-01-31 09:30:00").cast("timestamp")
    docs = table(spark, folder, "documents").select("doc_id", F.col("source").alias("from"))
    added = cur.with_provenance(docs, ts=stamp).withColumn("origin", F.col("from"))
    return added.select(
        "doc_id",
        "model_repo",
        "model_repo_version",
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        "origin",
    )


@query(
    "random_row_ids",
    "SELECT doc_id, source, CAST(36 AS BIGINT) AS id_length FROM documents",
)
def random_row_ids(spark, folder):
    """Ids are random, so only their form is compared."""
    rows = cur.with_row_id(table(spark, folder, "documents").select("doc_id", "source"))
    return rows.select("doc_id", "source", F.length("id").cast("long").alias("id_length"))


@query(
    "digest_row_ids",
    """SELECT sha256('{"doc_id":' || doc_id || '}') AS id, doc_id FROM documents""",
)
def digest_row_ids(spark, folder):
    return cur.with_row_id(table(spark, folder, "documents").select("doc_id"), ["doc_id"])


@query(
    "training_append",
    """SELECT doc_id, 'labelled' AS origin, CAST(quality AS BIGINT) AS quality FROM labels
    UNION ALL
    SELECT doc_id, 'production', -1 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def training_append(spark, folder):
    """Production rows join the training set unless their id is known."""
    base = table(spark, folder, "labels").select(
        "doc_id", F.lit("labelled").alias("origin"), F.col("quality").cast("long").alias("quality")
    )
    new = table(spark, folder, "documents").select(
        "doc_id", F.lit("production").alias("origin"), F.lit(-1).cast("long").alias("quality")
    )
    return cur.append_training(base, new, "doc_id")
