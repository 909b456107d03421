"""Predicted against reference answers."""

from pyspark.sql import functions as F

from ...functions import chat
from ...operators import curate as cur, evaluate as ev
from .. import jobs
from . import standins as st
from .registry import FMEASURE, query, r6, sql_scores, table

_DOC_METRICS = f"""{st.PAIRS_SQL}, {sql_scores('pairs')},
    answers AS (
      SELECT document_id, label = ref_label AS hit,
             CASE WHEN label = ref_label AND label = 'not_mentioned' THEN 1.0 ELSE {FMEASURE} END AS f
      FROM pairs JOIN scores ON scores.pid = pairs.pid),
    docs AS (
      SELECT document_id, avg(CAST(hit AS INT)) AS accuracy, avg(f) AS average_fmeasure,
             coalesce(avg(f) FILTER (WHERE hit), 0) AS t_average_fmeasure,
             coalesce(avg(CAST(f > 0.75 AS INT)) FILTER (WHERE hit), 0) AS t_perc_above_75fmeasure,
             coalesce(avg(f) FILTER (WHERE NOT hit), 0) AS f_average_fmeasure,
             coalesce(avg(CAST(f > 0.75 AS INT)) FILTER (WHERE NOT hit), 0) AS f_perc_above_75fmeasure,
             count(*) AS length, count(*) FILTER (WHERE hit) AS true_predictions,
             count(*) FILTER (WHERE hit AND f > 0.75) AS true_predictions_above_75fmeasure
      FROM answers GROUP BY document_id)"""

_MEANS = (
    "accuracy",
    "average_fmeasure",
    "t_average_fmeasure",
    "t_perc_above_75fmeasure",
    "f_average_fmeasure",
    "f_perc_above_75fmeasure",
)
_DATASET = f"""WITH {_DOC_METRICS}, dataset AS (
    SELECT count(*) AS count, avg(accuracy) AS average_accuracy,
           avg(average_fmeasure) AS average_fmeasure, avg(t_average_fmeasure) AS t_average_fmeasure,
           avg(t_perc_above_75fmeasure) AS t_average_perc_above_75fmeasure,
           avg(f_average_fmeasure) AS f_average_fmeasure,
           avg(f_perc_above_75fmeasure) AS f_average_perc_above_75fmeasure,
           min(accuracy) AS min_accuracy, min(t_average_fmeasure) AS min_t_average_fmeasure,
           min(t_perc_above_75fmeasure) AS min_t_perc_above_75fmeasure,
           min(f_average_fmeasure) AS min_f_average_fmeasure,
           min(f_perc_above_75fmeasure) AS min_f_perc_above_75fmeasure FROM docs)"""
_DATASET_COLUMNS = (
    "average_accuracy",
    "average_fmeasure",
    "t_average_fmeasure",
    "t_average_perc_above_75fmeasure",
    "f_average_fmeasure",
    "f_average_perc_above_75fmeasure",
    "min_accuracy",
    "min_t_average_fmeasure",
    "min_t_perc_above_75fmeasure",
    "min_f_average_fmeasure",
    "min_f_perc_above_75fmeasure",
)


def _pairs(spark, folder):
    return ev.match_reference(
        st.reference_answers(spark, folder), st.predicted_answers(spark, folder)
    )


@query(
    "matched_answers",
    f"""WITH {st.PAIRS_SQL} SELECT pid, label, ref_label, target AS ref_clause FROM pairs""",
)
def matched_answers(spark, folder):
    """First reference answer of the same id wins over its later duplicate."""
    return _pairs(spark, folder).select(
        (F.col("document_id") * 1000 + F.col("position")).alias("pid"),
        "label",
        F.col("reference.label").alias("ref_label"),
        F.col("reference.source_clause").alias("ref_clause"),
    )


@query(
    "unmatched_documents",
    f"""WITH {st.PAIRS_SQL} SELECT document_id, count(*) AS unmatched FROM pairs
    WHERE pid % 7 = 0 GROUP BY document_id""",
)
def unmatched_documents(spark, folder):
    """Documents that cannot be scored because a reference answer is absent."""
    reference = st.reference_answers(spark, folder).filter(
        "(document_id * 1000 + position % 1000 + 1) % 7 <> 0"
    )
    pairs = ev.match_reference(reference, st.predicted_answers(spark, folder))
    return ev.unmatched_documents(pairs)


@query(
    "paired_outputs",
    "SELECT doc_id, source, CAST(quality AS BIGINT) AS quality FROM documents JOIN labels USING (doc_id)",
)
def paired_outputs(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source")
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").cast("long"))
    return ev.pair_outputs(docs, labels, "doc_id")


_DOCUMENTS = f"""WITH {_DOC_METRICS} SELECT document_id, length, true_predictions,
    true_predictions_above_75fmeasure, {', '.join(f'round({c}, 6) AS {c}' for c in _MEANS)} FROM docs"""


@query("document_metrics", _DOCUMENTS)
def document_metrics(spark, folder):
    return _rounded(ev.document_metrics(_pairs(spark, folder)))


def _rounded(metrics):
    return metrics.select(
        "document_id",
        "length",
        "true_predictions",
        "true_predictions_above_75fmeasure",
        *[r6(F.col(c), c) for c in _MEANS],
    )


def _lists(spark, folder, limit):
    """Outputs as JSON text and references as lists, cut into parts of ``limit`` answers."""
    answer = F.struct("hypothesis_id", "label", F.lit("h").alias("hypothesis"), "source_clause")
    reference = cur.group_answers(st.reference_answers(spark, folder), ["position"], answer, limit=limit)
    outputs = cur.group_answers(
        st.predicted_answers(spark, folder), ["position"], answer, name="answers", limit=limit
    )
    generated = chat.answers_json(F.col("answers"), wrap=True).alias("generated")
    return outputs.select("document_id", "part", generated), reference


@query("evaluated_outputs", _DOCUMENTS)
def evaluated_outputs(spark, folder):
    """The same from generated JSON text and nested reference lists, cut into small parts."""
    return _rounded(jobs.evaluate_outputs(*_lists(spark, folder, limit=2)))


@query(
    "release_check",
    f"""WITH {_DOC_METRICS}, outcomes AS (
      SELECT conv_id AS document_id,
             CASE WHEN conv_id % 7 = 0 OR d.document_id IS NULL THEN 'missing' WHEN conv_id % 5 = 0 THEN 'failed'
                  WHEN conv_id % 11 = 0 THEN 'unmatched' ELSE 'scored' END AS outcome, d.*
      FROM (SELECT DISTINCT conv_id FROM conversations WHERE role = 'user') c
      LEFT JOIN docs d ON d.document_id = c.conv_id),
    checked AS (
      SELECT count(*) FILTER (WHERE outcome = 'scored') AS count, count(*) AS documents,
             count(*) FILTER (WHERE outcome = 'failed') AS failed_documents,
             count(*) FILTER (WHERE outcome = 'missing') AS missing_documents,
             count(*) FILTER (WHERE outcome = 'unmatched') AS unmatched_documents,
             avg(accuracy) FILTER (WHERE outcome = 'scored') AS average_accuracy,
             avg(average_fmeasure) FILTER (WHERE outcome = 'scored') AS average_fmeasure,
             avg(CAST(outcome = 'scored' AS INT)) AS scored_share FROM outcomes)
    SELECT count, documents, failed_documents, missing_documents, unmatched_documents,
           round(average_accuracy, 6) AS average_accuracy, round(scored_share, 6) AS scored_share,
           scored_share >= 0.95 AS check_scored_share,
           count >= 1 AND average_accuracy >= 0.7 AND average_fmeasure >= 0.7 AND scored_share >= 0.95 AS passed
    FROM checked""",
)
def release_check(spark, folder):
    """Metrics, what was left out of them, and the gate, with broken and missing outputs."""
    outputs, reference = _lists(spark, folder, limit=3)
    doc = F.col("document_id")
    text = F.col("generated")
    cut = F.substring(text, F.lit(1), F.length(text) - 2)
    odd = F.replace(text, F.lit('"hypothesis_id":"'), F.lit('"hypothesis_id":"x'))
    spoilt = F.when(doc % 5 == 0, cut).when(doc % 11 == 0, odd).otherwise(text)
    outputs = outputs.filter(doc % 7 != 0).withColumn("generated", spoilt)
    row = jobs.release_check(outputs, reference)
    return row.select(
        "count",
        "documents",
        "failed_documents",
        "missing_documents",
        "unmatched_documents",
        r6(F.col("average_accuracy"), "average_accuracy"),
        r6(F.col("scored_share"), "scored_share"),
        "check_scored_share",
        "passed",
    )


@query(
    "dataset_metrics",
    f"""{_DATASET} SELECT count,
    {', '.join(f'round({c}, 6) AS {c}' for c in _DATASET_COLUMNS)} FROM dataset""",
)
def dataset_metrics(spark, folder):
    metrics = ev.dataset_metrics(ev.document_metrics(_pairs(spark, folder)))
    return metrics.select("count", *[r6(F.col(c), c) for c in _DATASET_COLUMNS])


@query(
    "release_gate",
    f"""{_DATASET} SELECT count >= 1 AS check_count, average_accuracy >= 0.7 AS check_average_accuracy,
    average_fmeasure >= 0.7 AS check_average_fmeasure,
    count >= 1 AND average_accuracy >= 0.7 AND average_fmeasure >= 0.7 AS passed FROM dataset""",
)
def release_gate(spark, folder):
    metrics = ev.dataset_metrics(ev.document_metrics(_pairs(spark, folder)))
    return ev.gate(metrics).select(
        "check_count", "check_average_accuracy", "check_average_fmeasure", "passed"
    )
