"""Model responses: parsing, status, validation, chat text."""

from pyspark.sql import Window, functions as F

from ...functions import chat
from ...operators import answers as ans, calls, curate as cur, evaluate as ev, explore, near
from . import standins as st
from .registry import TOKENS, query, table, texts


def _responses(spark, folder):
    """Conversation turns as responses, broken in a different way for every tenth."""
    answer = F.struct(
        F.col("role").alias("hypothesis"),
        F.concat(F.lit("nda-"), F.col("turn").cast("string")).alias("hypothesis_id"),
        F.lit("entailment").alias("label"),
        F.col("text").alias("source_clause"),
    )
    inner = chat.answers_json(F.array(answer), wrap=True)
    whole = F.to_json(F.struct(inner.alias("generated_text")))
    broken = {
        0: F.lit(""),
        1: F.expr("substring(whole, 1, length(whole) - 5)"),
        2: F.lit('{"other": 1}'),
        3: F.lit('{"generated_text": "not json {"}'),
        4: F.lit('{"generated_text": "{\\"Other\\": 1}"}'),
        5: F.lit('{"generated_text": "{\\"Hypotheses\\": {}}"}'),
        6: F.lit('{"generated_text": "{\\"Hypotheses\\": []}"}'),
        7: F.expr("concat(whole, ' x')"),
    }
    kind = (F.col("conv_id") + F.col("turn")) % 10
    output = F.col("whole")
    for number, text in broken.items():
        output = F.when(kind == number, text).otherwise(output)
    return (
        table(spark, folder, "conversations")
        .withColumn("whole", whole)
        .select("conv_id", "turn", output.alias("output"))
    )


_STATUS = """CASE (conv_id + turn) % 10 WHEN 0 THEN 'bad_outer' WHEN 1 THEN 'bad_outer'
    WHEN 2 THEN 'no_generated_text' WHEN 3 THEN 'bad_inner' WHEN 4 THEN 'no_hypotheses'
    WHEN 5 THEN 'not_a_list' WHEN 6 THEN 'empty_list' WHEN 7 THEN 'bad_outer' ELSE 'ok' END"""


@query(
    "response_status",
    f"SELECT conv_id, turn, {_STATUS} AS status FROM conversations",
)
def response_status(spark, folder):
    return ans.parse_response(_responses(spark, folder)).select("conv_id", "turn", "status")


@query(
    "parsed_answers",
    f"""SELECT conv_id, turn, role AS hypothesis, 'nda-' || turn AS hypothesis_id,
           'entailment' AS label, text AS source_clause FROM conversations WHERE {_STATUS} = 'ok'""",
)
def parsed_answers(spark, folder):
    parsed = ans.drop_failed(ans.parse_response(_responses(spark, folder)))
    return ans.explode_answers(parsed).select(
        "conv_id", "turn", "hypothesis", "hypothesis_id", "label", "source_clause"
    )


@query(
    "valid_output_pairs",
    f"""SELECT conv_id, turn, length(text) AS reference, CAST(1 AS BIGINT) AS answers FROM conversations
    WHERE {_STATUS} = 'ok'""",
)
def valid_output_pairs(spark, folder):
    """Unusable outputs go together with their own reference."""
    generated = F.from_json("output", "generated_text string")["generated_text"]
    whole = F.when(ans.is_json(F.col("output")), generated)  # null for an output that is cut
    rows = _responses(spark, folder).withColumn("generated", whole)
    reference = table(spark, folder, "conversations").select(
        "conv_id", "turn", F.length("text").cast("long").alias("reference")
    )
    paired = ev.pair_outputs(rows, reference, ["conv_id", "turn"])
    return ans.valid_pairs(paired).select(
        "conv_id", "turn", "reference", F.size("answers").cast("long").alias("answers")
    )


@query(
    "schema_violations",
    """SELECT conv_id,
      concat_ws(',', CASE WHEN bool_or(role = 'system') THEN 'missing_field' END,
        CASE WHEN bool_or(turn = 3) THEN 'unknown_label' END,
        CASE WHEN bool_or(turn = 5) THEN 'unknown_id' END,
        CASE WHEN count(DISTINCT least(turn, 5)) < count(*) THEN 'repeated_id' END,
        CASE WHEN count(DISTINCT least(turn, 5)) FILTER (WHERE turn < 5) < 5 THEN 'incomplete' END) AS violations
    FROM conversations GROUP BY conv_id""",
)
def schema_violations(spark, folder):
    """Answer lists built to break each rule at a known turn."""
    rows = table(spark, folder, "conversations")
    answer = F.struct(
        F.concat(F.lit("q"), F.least("turn", F.lit(5)).cast("string")).alias("hypothesis_id"),
        F.when(F.col("turn") == 3, "maybe").otherwise("entailment").alias("label"),
        F.when(F.col("role") != "system", F.col("role")).alias("hypothesis"),
        F.col("text").alias("source_clause"),
    )
    lists = cur.group_answers(rows, ["turn"], answer, "conv_id", "answers")
    checked = ans.schema_violations(lists, ids=("q0", "q1", "q2", "q3", "q4"))
    return checked.select("conv_id", F.array_join("violations", ",").alias("violations"))


@query(
    "failed_rows_dropped",
    """SELECT event_id, value FROM events WHERE event_type <> 'error'""",
)
def failed_rows_dropped(spark, folder):
    status = F.when(F.col("event_type") == "error", "failed").otherwise("ok")
    events = table(spark, folder, "events").select("event_id", "value", status.alias("status"))
    return ans.drop_failed(events).drop("status")


@query(
    "mapped_rows",
    """SELECT item_id, CASE WHEN item_id % 7 = 0 THEN -1 ELSE length(text) END AS letters,
           CASE WHEN item_id % 7 = 0 THEN 'failed' ELSE 'ok' END AS status,
           CASE WHEN item_id % 7 = 0 THEN 'ZeroDivisionError' END AS error FROM benchmark""",
)
def mapped_rows(spark, folder):
    """A Python function per row in parallel; rows that fail are marked."""

    def letters(row):
        return {"letters": len(row["text"]) * (row["item_id"] % 7) // (row["item_id"] % 7)}

    mapped = ans.map_rows(table(spark, folder, "benchmark"), letters, "letters bigint")
    return mapped.select(
        "item_id",
        F.coalesce("letters", F.lit(-1)).alias("letters"),
        "status",
        F.substring_index("error", ":", 1).alias("error"),
    )


@query(
    "called_rows",
    """SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN -1 ELSE coalesce(length(text), 0) END AS letters,
           CASE WHEN doc_id % 7 = 0 THEN 'failed' ELSE 'ok' END AS status,
           CASE WHEN doc_id % 7 = 0 THEN 3 WHEN doc_id % 5 = 0 THEN 2 ELSE 1 END AS attempts,
           CASE WHEN doc_id % 7 = 0 THEN 'ConnectionError' END AS error FROM documents""",
)
def called_rows(spark, folder):
    """Every document sent to a service that refuses some and answers others at the second call."""

    def service():
        seen = set()

        def call(row):
            first = row["doc_id"] not in seen
            seen.add(row["doc_id"])
            if row["doc_id"] % 7 == 0 or (row["doc_id"] % 5 == 0 and first):
                raise ConnectionError("busy")
            return {"letters": len(row["text"] or "")}

        return call

    called = calls.call_rows(
        texts(spark, folder, "text"), service, "letters bigint", at_once=16, time_limit=600, backoff=0.001
    )
    return called.select(
        "doc_id",
        F.coalesce("letters", F.lit(-1)).alias("letters"),
        "status",
        "attempts",
        F.substring_index("error", ":", 1).alias("error"),
    )


@query(
    "legend_mismatches",
    f"""WITH {st.RAW_SQL}, legend AS (
      SELECT hypothesis_id, min(hypothesis) AS expected FROM raw WHERE turn < 6 GROUP BY 1)
    SELECT document_id, turn, hypothesis_id, hypothesis, expected
    FROM raw LEFT JOIN legend USING (hypothesis_id)
    WHERE hypothesis IS DISTINCT FROM expected""",
)
def legend_mismatches(spark, folder):
    rows = st.raw_rows(spark, folder)
    legend = rows.filter("turn < 6").groupBy("hypothesis_id").agg(
        F.min("hypothesis").alias("hypothesis")
    )
    answers = rows.select("document_id", "turn", "hypothesis_id", "hypothesis")
    return ev.legend_mismatch(answers, legend).select(
        "document_id", "turn", "hypothesis_id", "hypothesis", "expected"
    )


# Answers to statements of their own conversation: each fourth right, the others the next one's text,
# the text without its last word, or one sentence for several statements.
_NEAR_WORDS = "list_distinct(regexp_extract_all(lower({0}), '[a-z0-9]+'))"
_NEAR_SQL = f"""legend AS (
      SELECT conv_id * 1000 + turn AS hypothesis_id, min(text) AS hypothesis FROM conversations GROUP BY 1),
    given AS (
      SELECT conv_id AS document_id, conv_id * 1000 + turn AS hypothesis_id,
             CASE (conv_id + turn) % 4 WHEN 0 THEN text WHEN 1 THEN lead(text) OVER w
               WHEN 2 THEN regexp_replace(text, ' [^ ]+$', '') ELSE 'See ' || min(text) OVER c END AS hypothesis
      FROM conversations
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn, text), c AS (PARTITION BY conv_id)),
    wrong AS (
      SELECT given.*, legend.hypothesis AS expected FROM given LEFT JOIN legend USING (hypothesis_id)
      WHERE given.hypothesis IS DISTINCT FROM legend.hypothesis),
    mine AS (
      SELECT hypothesis AS text, {_NEAR_WORDS.format('hypothesis')} AS words
      FROM wrong WHERE hypothesis IS NOT NULL GROUP BY ALL),
    theirs AS (
      SELECT hypothesis AS other, min(hypothesis_id) AS near_id, {_NEAR_WORDS.format('hypothesis')} AS others
      FROM legend WHERE hypothesis IS NOT NULL GROUP BY hypothesis),
    sized AS (
      SELECT text, other, near_id, len(list_intersect(words, others)) AS shared,
             len(list_distinct(list_concat(words, others))) AS together
      FROM mine CROSS JOIN theirs),
    alike AS (
      SELECT *, CASE WHEN text = other THEN 2.0 ELSE shared / together END AS closeness
      FROM sized WHERE text = other OR (shared > 0 AND shared * 100 >= together * 80)),
    best AS (
      SELECT * FROM alike QUALIFY row_number() OVER (PARTITION BY text ORDER BY closeness DESC, near_id) = 1),
    times AS (SELECT document_id, hypothesis, count(*) AS times FROM given GROUP BY 1, 2),
    near AS (
      SELECT wrong.*, CASE WHEN best.closeness = 2 THEN 'swapped' WHEN times.times > 1 THEN 'repeated'
               WHEN own.text IS NOT NULL THEN 'edited' WHEN best.text IS NOT NULL THEN 'near_other'
               ELSE 'unknown' END AS kind,
             CASE WHEN own.closeness = best.closeness THEN wrong.hypothesis_id ELSE best.near_id END AS near_id,
             CASE WHEN own.closeness = best.closeness THEN own.shared ELSE best.shared END AS shared,
             CASE WHEN own.closeness = best.closeness THEN own.together ELSE best.together END AS together
      FROM wrong LEFT JOIN times USING (document_id, hypothesis)
      LEFT JOIN best ON best.text = wrong.hypothesis
      LEFT JOIN alike own ON own.text = wrong.hypothesis AND own.other = wrong.expected)"""


@query(
    "explained_mismatches",
    f"""WITH {_NEAR_SQL}
    SELECT document_id, hypothesis_id, kind, near_id, shared, together FROM near""",
)
def explained_mismatches(spark, folder):
    rows = table(spark, folder, "conversations")
    key = (F.col("conv_id") * 1000 + F.col("turn")).alias("hypothesis_id")
    legend = rows.groupBy(key).agg(F.min("text").alias("hypothesis"))
    mine = Window.partitionBy("conv_id")
    case = (F.col("conv_id") + F.col("turn")) % 4
    given = (
        F.when(case == 0, F.col("text"))
        .when(case == 1, F.lead("text").over(mine.orderBy("turn", "text")))
        .when(case == 2, F.regexp_replace("text", " [^ ]+$", ""))
        .otherwise(F.concat(F.lit("See "), F.min("text").over(mine)))
    )
    answers = rows.select(F.col("conv_id").alias("document_id"), key, given.alias("hypothesis"))
    found = near.explain_mismatches(answers, legend)
    counts = [F.col(c).cast("long").alias(c) for c in ("shared", "together")]
    return found.select("document_id", "hypothesis_id", "kind", "near_id", *counts)


_CHAT = (
    "'<|im_start|>system' || chr(10) || source || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) "
    "|| text || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)"
)


@query(
    "chat_prompts",
    f"""SELECT doc_id, {_CHAT} AS prompt, {_CHAT} || lang || '<|im_end|>' || chr(10) AS conversation
    FROM documents""",
)
def chat_prompts(spark, folder):
    system, user = F.col("source"), F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id",
        chat.chatml(system, user).alias("prompt"),
        chat.chatml(system, user, F.col("lang")).alias("conversation"),
    )


@query(
    "chat_sections",
    "SELECT doc_id, source AS system, text AS user FROM documents",
)
def chat_sections(spark, folder):
    """Sections recovered from rendered prompts."""
    prompt = chat.chatml(F.col("source"), F.col("text"))
    return table(spark, folder, "documents").select(
        "doc_id", chat.split_chatml(prompt).alias("s")
    ).select("doc_id", "s.*")


@query(
    "chat_messages",
    """SELECT doc_id, 0 AS place, 'system' AS role, source AS content FROM documents
    UNION ALL SELECT doc_id, 1, 'user', text FROM documents
    UNION ALL SELECT doc_id, 2, 'assistant', lang FROM documents""",
)
def chat_messages(spark, folder):
    turns = chat.messages(F.col("source"), F.col("text"), F.col("lang"))
    return table(spark, folder, "documents").select(
        "doc_id", F.posexplode(turns).alias("place", "m")
    ).select("doc_id", "place", "m.role", "m.content")


@query(
    "filled_templates",
    """SELECT item_id, 'Read: ' || text || ' -- ' || text || ' {other}' AS prompt FROM benchmark""",
)
def filled_templates(spark, folder):
    template = F.lit("Read: {contract} -- {contract} {other}")
    return table(spark, folder, "benchmark").select(
        "item_id", chat.fill_template(template, F.col("text")).alias("prompt")
    )


@query(
    "storage_keys",
    """SELECT page_id, array_to_string(list_slice(string_split(url, '/'), 4, len(string_split(url, '/'))), '/') AS key
    FROM pages""",
)
def storage_keys(spark, folder):
    return table(spark, folder, "pages").select("page_id", chat.uri_key(F.col("url")).alias("key"))


@query(
    "answer_json",
    """SELECT conv_id, turn,
      to_json([{'role': role, 'text': text}])::VARCHAR AS bare,
      to_json({'Hypotheses': [{'role': role, 'text': text}]})::VARCHAR AS wrapped FROM conversations""",
)
def answer_json(spark, folder):
    answers = F.array(F.struct("role", "text"))
    return table(spark, folder, "conversations").select(
        "conv_id",
        "turn",
        chat.answers_json(answers).alias("bare"),
        chat.answers_json(answers, wrap=True).alias("wrapped"),
    )


@query(
    "capped_outputs",
    "SELECT doc_id, least(n_chars, 2000) AS allowed FROM documents",
)
def capped_outputs(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", chat.cap_output(F.col("n_chars"), 2000).alias("allowed")
    )


@query(
    "short_requests",
    f"""SELECT doc_id, len({TOKENS.format('text')}) AS tokens FROM documents
    WHERE len({TOKENS.format('text')}) < 400""",
)
def short_requests(spark, folder):
    from ...functions import text as tx

    rows = table(spark, folder, "documents").select(
        "doc_id", tx.rouge_tokens(F.col("text")).alias("prompt_ids")
    )
    return ans.filter_request_len(rows, 400).select(
        "doc_id", F.size("prompt_ids").cast("long").alias("tokens")
    )


@query(
    "document_lookup",
    "SELECT doc_id, lang, source FROM documents WHERE source = 'src3' AND lang = 'fr'",
)
def document_lookup(spark, folder):
    """Point lookup and column subset; the filter reaches the scan."""
    docs = table(spark, folder, "documents")
    return docs.filter("source = 'src3' and lang = 'fr'").select("doc_id", "lang", "source")


@query(
    "renamed_columns",
    "SELECT doc_id AS document_id, text AS source_clause FROM documents",
)
def renamed_columns(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return docs.withColumnsRenamed({"doc_id": "document_id", "text": "source_clause"})


@query(
    "first_documents",
    "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 5",
)
def first_documents(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    return explore.head(docs, 5, [F.desc("n_chars"), F.col("doc_id")])
