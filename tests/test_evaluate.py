import math

from pyspark.sql import functions as F

from quotelens.operators import evaluate as ev
from quotelens.plans import jobs

ANSWER = "document_id int, position int, hypothesis_id string, label string, source_clause string"

COPY = (
    "The Recipient will not copy or reproduce the Confidential Information except as reasonably "
    "required for the purposes contemplated in this Agreement"
)
# 12 tokens, 10 trigrams; the prediction keeps the first six of them.
LONG = "all information shall be returned or destroyed upon request by the party"
SHORT = "all information shall be returned or destroyed upon"


def metrics(spark, reference, predicted):
    pairs = ev.match_reference(
        spark.createDataFrame(reference, ANSWER).repartition(3),
        spark.createDataFrame(predicted, ANSWER).repartition(3),
    )
    return pairs, {r.document_id: r for r in ev.document_metrics(pairs).collect()}


def test_two_answer_document(spark):
    reference = [(1, 0, "q1", "entailment", COPY), (1, 1, "q2", "contradiction", LONG)]
    predicted = [(1, 0, "q1", "entailment", COPY), (1, 1, "q2", "contradiction", SHORT)]
    _, docs = metrics(spark, reference, predicted)
    f = 2 * 1.0 * 0.6 / 1.6  # precision 6/6, recall 6/10
    row = docs[1]
    assert (row.accuracy, row.length, row.true_predictions) == (1.0, 2, 2)
    assert row.true_predictions_above_75fmeasure == 1  # 0.75 is not above 0.75
    assert math.isclose(f, 0.75) and row.t_perc_above_75fmeasure == 0.5
    assert math.isclose(row.average_fmeasure, (1 + f) / 2)
    assert (row.f_average_fmeasure, row.f_perc_above_75fmeasure) == (0, 0)


def test_first_reference_wins_and_repeats_count(spark):
    reference = [(1, 5, "q1", "contradiction", "late"), (1, 0, "q1", "entailment", COPY)]
    predicted = [(1, i, "q1", "entailment", COPY) for i in range(3)]
    _, docs = metrics(spark, reference, predicted)
    assert (docs[1].length, docs[1].accuracy, docs[1].average_fmeasure) == (3, 1.0, 1.0)


def test_labels_decide(spark):
    reference = [
        (1, 0, "q1", "not_mentioned", "ignored text here"), (1, 1, "q2", "not_mentioned", ""),
        (2, 0, "q1", "entailment", COPY), (2, 1, "q2", "entailment", COPY),
    ]
    predicted = [
        (1, 0, "q1", "not_mentioned", ""), (1, 1, "q2", "not_mentioned", "x"),
        (2, 0, "q1", "contradiction", COPY), (2, 1, "q2", "not_mentioned", ""),
    ]
    _, docs = metrics(spark, reference, predicted)
    assert (docs[1].accuracy, docs[1].average_fmeasure, docs[1].t_perc_above_75fmeasure) == (1, 1, 1)
    assert (docs[2].accuracy, docs[2].t_average_fmeasure, docs[2].true_predictions) == (0, 0, 0)
    assert (docs[2].f_average_fmeasure, docs[2].f_perc_above_75fmeasure) == (0.5, 0.5)


def test_unmatched_documents_are_reported(spark):
    reference = [(1, 0, "q1", "entailment", COPY), (2, 0, "q1", "entailment", COPY)]
    predicted = [(1, 0, "q1", "entailment", COPY), (1, 1, "q9", "entailment", COPY), (2, 0, "q1", "entailment", COPY)]
    pairs, docs = metrics(spark, reference, predicted)
    assert set(docs) == {2}
    assert [tuple(r) for r in ev.unmatched_documents(pairs).collect()] == [(1, 1)]


def test_dataset_and_gate(spark):
    reference = [(d, 0, "q1", "entailment", COPY) for d in (1, 2)]
    predicted = [(1, 0, "q1", "entailment", COPY), (2, 0, "q1", "contradiction", "x y z")]
    pairs, _ = metrics(spark, reference, predicted)
    dataset = ev.dataset_metrics(ev.document_metrics(pairs))
    row = dataset.first()
    assert (row["count"], row.average_accuracy, row.t_average_fmeasure, row.min_accuracy) == (2, 0.5, 0.5, 0)
    assert "min_average_fmeasure" not in dataset.columns
    assert ev.gate(dataset).first().passed is False
    assert ev.gate(dataset, [("count", 2), ("average_accuracy", 0.5)]).first().passed is True
    empty = ev.dataset_metrics(ev.document_metrics(pairs.limit(0))).first()
    assert all(v == 0 for v in empty)
    assert ev.gate(ev.dataset_metrics(ev.document_metrics(pairs.limit(0)))).first().passed is False


def test_lists_in_one_row(spark):
    answer = "struct<hypothesis_id:string,label:string,hypothesis:string,source_clause:string>"
    good = ("q1", "entailment", "h", COPY)
    generated = '{"Hypotheses": [{"hypothesis_id": "q1", "label": "entailment", "hypothesis": "h", "source_clause": "%s"}]}'
    rows = [(1, generated % COPY, [good, ("q1", "contradiction", "h", "later")]), (2, "{", [good])]
    df = spark.createDataFrame(rows, f"document_id int, generated string, inference array<{answer}>")
    got = jobs.evaluate_outputs(df).collect()
    assert [(r.document_id, r.accuracy, r.average_fmeasure) for r in got] == [(1, 1.0, 1.0)]

    # Two parts with answers in another order than the references; a missing and an odd document.
    said = [(1, 0, generated % COPY), (1, 7, generated.replace("q1", "q2") % LONG), (2, 0, "{"),
            (2, 1, generated % COPY), (4, 0, generated.replace("q1", "q9") % COPY)]
    asked = [(1, 0, [("q2", "entailment", "h", LONG)]), (1, 1, [good]), (2, 0, [good]), (3, 0, [good]), (4, 0, [good])]
    outputs = spark.createDataFrame(said, "document_id int, part int, generated string")
    references = spark.createDataFrame(asked, f"document_id int, part int, inference array<{answer}>")
    outcomes = {r.document_id: r.outcome for r in jobs.document_outcomes(outputs, references).collect()}
    assert outcomes == {1: "scored", 2: "failed", 3: "missing", 4: "unmatched"}
    row = jobs.release_check(outputs, references, least_scored=0.5).first()
    assert (row["count"], row.documents, row.average_accuracy, row.scored_share) == (1, 4, 1.0, 0.25)
    assert (row.failed_documents, row.missing_documents, row.unmatched_documents) == (1, 1, 1)
    assert row.check_average_accuracy and not row.check_scored_share and not row.passed
    assert jobs.release_check(outputs, references, least_scored=0.2).first().passed
    assert jobs.release_check(outputs.limit(0), references.limit(0)).first().scored_share == 0


def test_result_does_not_depend_on_partitions(spark):
    reference = [(d, p, f"q{p}", "entailment", LONG) for d in range(5) for p in range(4)]
    predicted = [(d, p, f"q{p}", "entailment", " ".join(LONG.split()[p : p + 3 + d])) for d in range(5) for p in range(4)]
    first, _ = metrics(spark, reference, predicted)
    rows = lambda n: sorted(map(tuple, ev.document_metrics(first.repartition(n)).collect()))
    assert all(
        math.isclose(a, b, abs_tol=1e-12) for x, y in zip(rows(1), rows(7)) for a, b in zip(x, y)
    )
    assert first.filter(F.col("reference").isNull()).count() == 0
