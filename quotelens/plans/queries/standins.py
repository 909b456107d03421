"""Tables in the shapes the operators expect, derived from the given ones.

Every view exists twice, as a DataFrame and as SQL text with the same rows.
"""

from pyspark.sql import functions as F

from .registry import table

SPAN = 200  # characters of a document used as its quote


def span(text, number, length):
    """``length`` characters from anywhere in a text, the place depending on ``number``."""
    last = F.greatest(F.length(text) - (length - 1), F.lit(1))
    return F.substring(text, (1 + (number * 37) % last).cast("int"), F.lit(length))


def span_sql(text, number, length):
    last = f"greatest(length({text}) - {length - 1}, 1)"
    return f"substring({text}, 1 + ({number} * 37) % {last}, {length})"


def quotes(spark, folder):
    """One quote per document; every fifth is taken from the following document."""
    docs = table(spark, folder, "documents").select(
        "doc_id", "source", "lang", span(F.col("text"), F.col("doc_id"), SPAN).alias("own")
    )
    other = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("own").alias("other"))
    foreign = (F.col("doc_id") % 5 == 0) & F.col("other").isNotNull()
    return docs.join(other, "doc_id", "left").select(
        "doc_id",
        "source",
        "lang",
        F.lit(0).alias("quote_id"),
        F.when(foreign, F.col("other")).otherwise(F.col("own")).alias("text"),
    )


QUOTES_SQL = f"""quotes AS (
    SELECT d.doc_id, d.source,
           CASE WHEN d.doc_id % 5 = 0 AND o.doc_id IS NOT NULL THEN {span_sql('o.text', 'o.doc_id', SPAN)}
                ELSE {span_sql('d.text', 'd.doc_id', SPAN)} END AS text
    FROM documents d LEFT JOIN documents o ON o.doc_id = d.doc_id + 1)"""

_LABEL = (
    "CASE role WHEN 'user' THEN 'entailment' WHEN 'assistant' THEN 'contradiction' "
    "ELSE 'notmentioned' END"
)
_CLEAN = _LABEL.replace("notmentioned", "not_mentioned")


def raw_rows(spark, folder):
    """Conversations as raw question rows: turn is the order, the lines are the evidence."""
    return table(spark, folder, "conversations").select(
        F.col("conv_id").alias("document_id"),
        "turn",
        "text",
        F.concat(F.lit("Statement of the "), "role").alias("hypothesis"),
        F.concat(F.lit("nda-"), (F.col("turn") + 1).cast("string")).alias("hypothesis_id"),
        F.expr(_LABEL).alias("label"),
        F.split("text", "\n").alias("evidence_texts"),
    )


RAW_SQL = f"""raw AS (
    SELECT conv_id AS document_id, turn, text, 'Statement of the ' || role AS hypothesis,
           'nda-' || (turn + 1) AS hypothesis_id, {_LABEL} AS raw_label, {_CLEAN} AS label,
           string_split(text, chr(10)) AS evidence_texts
    FROM conversations)"""


def reference_answers(spark, folder):
    """User turns as reference answers, with a later duplicate that must lose."""
    users = table(spark, folder, "conversations").filter("role = 'user'")
    first = users.select(
        F.col("conv_id").alias("document_id"),
        F.col("turn").alias("position"),
        F.concat(F.lit("nda-"), (F.col("turn") + 1).cast("string")).alias("hypothesis_id"),
        _label_of((F.col("conv_id") + F.col("turn")) % 3).alias("label"),
        F.col("text").alias("source_clause"),
    )
    later = first.withColumns(
        {
            "position": F.col("position") + 1000,
            "label": F.lit("entailment"),
            "source_clause": F.lit("a later duplicate"),
        }
    )
    return first.unionByName(later)


def predicted_answers(spark, folder):
    """The following assistant turn as the prediction; even conversations quote the user."""
    turns = table(spark, folder, "conversations")
    user = turns.filter("role = 'user'").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("asked")
    )
    said = turns.filter("role = 'assistant'").join(user, ["conv_id", "turn"])
    quote = F.when(F.col("conv_id") % 2 == 0, span(F.col("asked"), F.col("conv_id"), 150)).otherwise(F.col("text"))
    return said.select(
        F.col("conv_id").alias("document_id"),
        F.col("turn").alias("position"),
        F.concat(F.lit("nda-"), F.col("turn").cast("string")).alias("hypothesis_id"),
        _label_of((F.col("conv_id") + F.col("turn") - 1 + F.col("turn") % 4 / 3) % 3).alias("label"),
        quote.alias("source_clause"),
    )


def _label_of(number):
    return (
        F.when(F.floor(number) == 0, "entailment")
        .when(F.floor(number) == 1, "contradiction")
        .otherwise("not_mentioned")
    )


def _label_sql(number):
    return (
        f"CASE CAST(floor({number}) AS INT) WHEN 0 THEN 'entailment' "
        "WHEN 1 THEN 'contradiction' ELSE 'not_mentioned' END"
    )


PAIRS_SQL = f"""pairs AS (
    SELECT a.conv_id AS document_id, a.conv_id * 1000 + a.turn AS pid,
           {_label_sql('((a.conv_id + a.turn - 1 + (a.turn % 4) / 3.0) % 3)')} AS label,
           {_label_sql('((u.conv_id + u.turn) % 3)')} AS ref_label,
           u.text AS target,
           CASE WHEN a.conv_id % 2 = 0 THEN {span_sql('u.text', 'a.conv_id', 150)} ELSE a.text END AS prediction
    FROM conversations a JOIN conversations u
      ON u.conv_id = a.conv_id AND u.turn = a.turn - 1 AND u.role = 'user'
    WHERE a.role = 'assistant')"""


def requests(spark, folder):
    """Events as requests: the user is the client, the value its latency."""
    return requests_of(table(spark, folder, "events"))


def requests_of(events):
    return events.select(
        "event_id",
        F.col("event_type").alias("endpoint"),
        F.col("user_id").alias("client"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("start_ms"),
        F.col("value").alias("latency_ms"),
        (F.col("value") / 2).alias("first_byte_ms"),
        F.get_json_object("props", "$.k").cast("long").alias("tokens"),
        (F.col("event_type") == "error").alias("failed"),
    )


REQUESTS_SQL = """requests AS (
    SELECT event_id, event_type AS endpoint, user_id AS client, epoch_us(ts) // 1000 AS start_ms,
           value AS latency_ms, value / 2 AS first_byte_ms,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS tokens,
           event_type = 'error' AS failed
    FROM events)"""


def scored_responses(events, *keep):
    """Events (table or stream) as scored responses with one answer each."""
    answer = F.struct(
        F.concat(F.lit("nda-"), (F.col("user_id") % 5).cast("string")).alias("hypothesis_id"),
        _label_of(F.col("event_id") % 3).alias("label"),
        F.lit("h").alias("hypothesis"),
        F.lit("c").alias("source_clause"),
    )
    return events.select(
        *keep,
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("endpoint"),
        F.concat(F.lit("adapter-"), (F.col("user_id") % 2).cast("string")).alias("adapter"),
        F.least(F.col("value") / 60, F.lit(1.0)).alias("carp"),
        F.array(answer).alias("answers"),
    )


RESPONSES_SQL = f"""responses AS (
    SELECT ts, event_type AS endpoint, 'adapter-' || (user_id % 2) AS adapter,
           least(value / 60, 1.0) AS carp, 'nda-' || (user_id % 5) AS hypothesis_id,
           {_label_sql('(event_id % 3)')} AS label
    FROM events)"""


def training_log(spark, folder):
    """Events as training history: the user is the run, evaluations are the error rows."""
    evaluated = F.col("event_type") == "error"
    return table(spark, folder, "events").select(
        F.col("user_id").alias("run"),
        F.col("event_id").alias("step"),
        F.when(~evaluated, F.col("value")).alias("loss"),
        F.when(evaluated, F.col("value")).alias("eval_loss"),
    )


LOG_SQL = """log AS (
    SELECT user_id AS run, event_id AS step,
           CASE WHEN event_type <> 'error' THEN value END AS loss,
           CASE WHEN event_type = 'error' THEN value END AS eval_loss
    FROM events)"""
