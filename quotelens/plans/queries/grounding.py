"""Are quotes really in their source text?"""

from pyspark.sql import functions as F

from ...functions import text as tx
from ...operators import monitor as mon, overlap
from . import standins as st
from .registry import FMEASURE, PRECISION, RECALL, TOKENS, TRIGRAMS, query, r6, sql_scores, table, texts

_PAIRS = f"""{st.QUOTES_SQL}, pairs AS (
    SELECT q.doc_id AS pid, d.text AS target, q.text AS prediction
    FROM quotes q JOIN documents d ON d.doc_id = q.doc_id)"""


def _documents(spark, folder):
    return texts(spark, folder, "text")


@query(
    "quote_grounding_by_source",
    f"""WITH {_PAIRS}, {sql_scores('pairs')}
    SELECT source, round(avg({PRECISION}), 6) AS carp, count(*) AS quotes,
           count(*) FILTER (WHERE {PRECISION} <= 0.7) AS ungrounded
    FROM scores JOIN documents ON doc_id = pid GROUP BY source""",
)
def quote_grounding_by_source(spark, folder):
    """Mean quote precision per source, and quotes at or below the alarm threshold."""
    # One quote per document, so its source can stand for the quote id and needs no join back.
    quotes = st.quotes(spark, folder).withColumn("quote_id", F.col("source"))
    documents = table(spark, folder, "documents").select("doc_id", "text")
    scored = overlap.ngram_overlap(quotes, documents, "doc_id")
    precision = F.col("rouge.precision")
    return scored.groupBy(F.col("quote_id").alias("source")).agg(
        r6(F.avg(precision), "carp"),
        F.count(F.lit(1)).alias("quotes"),
        F.count_if(precision <= 0.7).alias("ungrounded"),
    )


@query(
    "quote_overlap",
    f"""WITH {_PAIRS}, {sql_scores('pairs')}
    SELECT pid AS doc_id, CAST(o AS BIGINT) AS overlap, np AS quote_grams, nt AS target_grams,
           round({PRECISION}, 6) AS precision, round({RECALL}, 6) AS recall,
           round({FMEASURE}, 6) AS fmeasure FROM scores""",
)
def quote_overlap(spark, folder):
    """Clipped trigram overlap and ROUGE-3 of every quote."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    scored = overlap.ngram_overlap(st.quotes(spark, folder), documents, "doc_id")
    return scored.select(
        "doc_id",
        *[F.col(c).cast("long").alias(c) for c in ("overlap", "quote_grams", "target_grams")],
        *[r6(F.col(f"rouge.{c}"), c) for c in ("precision", "recall", "fmeasure")],
    )


@query(
    "request_grounding",
    f"""WITH {st.QUOTES_SQL},
    answers AS (SELECT d.doc_id, 0 AS position, 'entailment' AS label, q.text AS clause
                FROM documents d JOIN quotes q ON q.doc_id = d.doc_id
                UNION ALL
                SELECT doc_id, 1, 'not_mentioned', '' FROM documents
                UNION ALL
                SELECT doc_id, 2, CASE WHEN lang = 'en' THEN 'contradiction' ELSE 'not_mentioned' END,
                       'one two' FROM documents),
    pairs AS (SELECT a.doc_id * 10 + a.position AS pid, d.text AS target, a.clause AS prediction
              FROM answers a JOIN documents d ON d.doc_id = a.doc_id WHERE a.label <> 'not_mentioned'),
    {sql_scores('pairs')}
    SELECT pid // 10 AS doc_id, round(avg({PRECISION}), 6) AS carp FROM scores GROUP BY 1""",
)
def request_grounding(spark, folder):
    """Grounding per request from flat answers; quotes too short for a trigram score 0."""
    third = F.when(F.col("lang") == "en", "contradiction").otherwise("not_mentioned")
    listed = F.array(
        *[
            F.struct(F.lit(i).alias("position"), label.alias("label"), clause.alias("source_clause"))
            for i, (label, clause) in enumerate(
                [
                    (F.lit("entailment"), F.col("text")),
                    (F.lit("not_mentioned"), F.lit("")),
                    (third, F.lit("one two")),
                ]
            )
        ]
    )
    answers = st.quotes(spark, folder).select("doc_id", F.inline(listed))
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return mon.carp(answers, docs, "doc_id").select("doc_id", r6(F.col("carp"), "carp"))


@query(
    "in_row_grounding",
    f"""WITH pairs AS (
      SELECT doc_id * 10 AS pid, text AS target, {st.span_sql('text', 'doc_id', 120)} AS prediction FROM documents WHERE lang <> 'de'
      UNION ALL
      SELECT doc_id * 10 + 1, text, 'a b c ' || {st.span_sql('text', '(doc_id + 1)', 80)} FROM documents WHERE lang <> 'de'),
    {sql_scores('pairs')}, means AS (SELECT pid // 10 AS doc_id, avg({PRECISION}) AS carp FROM scores GROUP BY 1)
    SELECT doc_id, round(coalesce(carp, 1.0), 6) AS carp FROM documents LEFT JOIN means USING (doc_id)""",
)
def in_row_grounding(spark, folder):
    """Grounding of answer lists held in the same row as their text: no shuffle at all."""

    def answer(clause):
        label = F.when(F.col("lang") == "de", "not_mentioned").otherwise("entailment")
        return F.struct(label.alias("label"), clause.alias("source_clause"))

    answers = F.array(
        answer(st.span(F.col("text"), F.col("doc_id"), 120)),
        answer(F.concat(F.lit("a b c "), st.span(F.col("text"), F.col("doc_id") + 1, 80))),
    )
    docs = texts(spark, folder, "text", "lang").withColumn("answers", answers)
    return mon.carp_in_row(docs, "text").select("doc_id", r6(F.col("carp"), "carp"))


@query(
    "turn_pair_rouge",
    f"""WITH {st.PAIRS_SQL}, {sql_scores('pairs')}
    SELECT pid, round({PRECISION}, 6) AS precision, round({RECALL}, 6) AS recall,
           round({FMEASURE}, 6) AS fmeasure FROM scores""",
)
def turn_pair_rouge(spark, folder):
    """ROUGE-3 of two texts of one row."""
    first = st.reference_answers(spark, folder).filter("position < 1000").select(
        "document_id", "hypothesis_id", F.col("source_clause").alias("target")
    )
    pairs = st.predicted_answers(spark, folder).join(first, ["document_id", "hypothesis_id"])
    scored = overlap.rouge_pairs(pairs, "target", "source_clause")
    return scored.select(
        (F.col("document_id") * 1000 + F.col("position")).alias("pid"),
        *[r6(F.col(f"rouge.{c}"), c) for c in ("precision", "recall", "fmeasure")],
    )


@query(
    "document_tokens",
    f"""SELECT doc_id, len({TOKENS.format('text')}) AS tokens,
           array_to_string({TOKENS.format('text')}, ' ') AS joined FROM documents""",
)
def document_tokens(spark, folder):
    """Score tokens of every document, whole texts."""
    tokens = tx.rouge_tokens(F.col("text"))
    return _documents(spark, folder).select(
        "doc_id", F.size(tokens).cast("long").alias("tokens"), F.array_join(tokens, " ").alias("joined")
    )


@query(
    "document_trigrams",
    f"""WITH tok AS (SELECT doc_id, {TOKENS.format('text')} AS t FROM documents)
    SELECT doc_id, len({TRIGRAMS}) AS grams, len(list_distinct({TRIGRAMS})) AS different,
           coalesce(array_to_string({TRIGRAMS}, '|'), '') AS joined FROM tok""",
)
def document_trigrams(spark, folder):
    """Trigrams of every document in text order."""
    grams = tx.ngrams(tx.rouge_tokens(F.col("text")))
    return _documents(spark, folder).select("doc_id", grams.alias("g")).select(
        "doc_id",
        F.size("g").cast("long").alias("grams"),
        F.size(F.array_distinct("g")).cast("long").alias("different"),
        F.array_join("g", "|").alias("joined"),
    )
