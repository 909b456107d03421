"""Answers against reference answers: pairs, document metrics, dataset metrics, gate."""

from pyspark.sql import functions as F

from ..functions import text as tx
from ..schemas import CLOSE_QUOTE, DEFAULT_LEGEND, LEGEND, NOT_MENTIONED
from .joins import join_small
from .ordered import one_column


def pair_outputs(outputs, references, on):
    """Outputs with their references by id; positions are not stable across a shuffle."""
    return outputs.join(references, on)


def match_reference(reference, predicted, doc="document_id", order=("position",)):
    """Each predicted answer with the first reference answer of the same id, or nulls."""
    first = reference.groupBy(doc, "hypothesis_id").agg(
        F.min_by(F.struct("label", "source_clause"), one_column(order)).alias("reference")
    )
    return predicted.join(first, [doc, "hypothesis_id"], "left")


def default_legend(spark):
    return spark.createDataFrame(list(DEFAULT_LEGEND), LEGEND)


def legend_mismatch(answers, legend):
    """Answers whose text differs from the legend's for that id, or whose id it lacks."""
    wanted = legend.withColumnRenamed("hypothesis", "expected")
    joined = join_small(answers, wanted, "hypothesis_id", "left")
    return joined.filter(~F.col("hypothesis").eqNullSafe(F.col("expected")))


def score_pairs(pairs):
    """Add ``matched`` and ``fmeasure`` to rows of label, source_clause and reference.

    Two ``not_mentioned`` labels agree fully whatever their clauses hold.
    """
    matched = F.col("label").eqNullSafe(F.col("reference.label"))
    both_silent = matched & (F.col("label") == NOT_MENTIONED)
    score = tx.rouge_n(F.col("reference.source_clause"), F.col("source_clause"))["fmeasure"]
    return pairs.withColumns(
        {"matched": matched, "fmeasure": F.when(both_silent, F.lit(1.0)).otherwise(score)}
    )


def document_metrics(pairs, doc="document_id"):
    """Metrics per document from matched pairs.

    A document with an answer that has no reference cannot be scored; see
    :func:`unmatched_documents`. Documents without answers have no pairs and no row.
    """
    scored = score_pairs(pairs)
    hit = F.col("matched")
    close = (F.col("fmeasure") > CLOSE_QUOTE).cast("double")

    def share(value, condition):
        return F.coalesce(F.avg(F.when(condition, value)), F.lit(0.0))

    return (
        scored.groupBy(doc)
        .agg(
            F.avg(hit.cast("double")).alias("accuracy"),
            F.avg("fmeasure").alias("average_fmeasure"),
            share(F.col("fmeasure"), hit).alias("t_average_fmeasure"),
            share(close, hit).alias("t_perc_above_75fmeasure"),
            share(F.col("fmeasure"), ~hit).alias("f_average_fmeasure"),
            share(close, ~hit).alias("f_perc_above_75fmeasure"),
            F.count(F.lit(1)).alias("length"),
            F.count_if(hit).alias("true_predictions"),
            F.count_if(hit & (close == 1)).alias("true_predictions_above_75fmeasure"),
            F.count_if(F.col("reference").isNull()).alias("_unmatched"),
        )
        .filter("_unmatched = 0")
        .drop("_unmatched")
    )


def unmatched_documents(pairs, doc="document_id"):
    """Documents left out of the metrics, with the number of answers without reference."""
    return (
        pairs.filter(F.col("reference").isNull())
        .groupBy(doc)
        .agg(F.count(F.lit(1)).alias("unmatched"))
    )


def dataset_metrics(documents):
    """One row: document count, unweighted means and minima; all 0 without documents.

    With an ``outcome`` column (``jobs.document_outcomes``) only scored documents count in these,
    and the numbers of documents, of those with each other outcome, and the share that was
    scored stand beside them.
    """
    means = {
        "average_accuracy": "accuracy",
        "average_fmeasure": "average_fmeasure",
        "t_average_fmeasure": "t_average_fmeasure",
        "t_average_perc_above_75fmeasure": "t_perc_above_75fmeasure",
        "f_average_fmeasure": "f_average_fmeasure",
        "f_average_perc_above_75fmeasure": "f_perc_above_75fmeasure",
    }
    minima = [
        "accuracy",
        "t_average_fmeasure",
        "t_perc_above_75fmeasure",
        "f_average_fmeasure",
        "f_perc_above_75fmeasure",
    ]
    zero = F.lit(0.0)
    left_out = []
    if "outcome" in documents.columns:
        outcomes = {o: F.count_if(F.col("outcome") == o) for o in ("failed", "missing", "unmatched")}
        left_out = [
            F.count(F.lit(1)).alias("documents"),
            *[n.alias(f"{o}_documents") for o, n in outcomes.items()],
            F.coalesce(F.avg((F.col("outcome") == "scored").cast("int")), zero).alias("scored_share"),
        ]
    return documents.agg(
        F.count("accuracy").alias("count"),
        *[F.coalesce(F.avg(c), zero).alias(name) for name, c in means.items()],
        *[F.coalesce(F.min(c), zero).alias(f"min_{c}") for c in minima],
        *left_out,
    )


# The least a model must reach before release.
RELEASE_RULES = (("count", 1), ("average_accuracy", 0.7), ("average_fmeasure", 0.7))


def gate(metrics, rules=RELEASE_RULES):
    """Add one ``check_*`` column per rule and ``passed``."""
    checks = {f"check_{name}": F.col(name) >= least for name, least in rules}
    passed = F.lit(True)
    for check in checks.values():
        passed = passed & check
    return metrics.withColumns({**checks, "passed": passed})
