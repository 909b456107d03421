"""Round trips through every writer and reader."""

from pyspark.sql import functions as F, types as T

from ...functions import chat
from ...operators import prepare as prep, runs
from ...sources import appends, readers, writers
from ...streaming import live
from .. import jobs
from . import standins as st
from .registry import PRECISION, query, r6, scratch, sql_scores, table, texts


@query(
    "raw_parquet_scan",
    "SELECT doc_id, source FROM documents",
)
def raw_parquet_scan(spark, folder):
    schema = T.StructType().add("doc_id", "long").add("source", "string")
    path = f"{folder}/documents.parquet"
    ordered = readers.read_raw(spark, path, schema=schema, with_order=True)
    return ordered.filter("row >= 0").select("doc_id", "source")


@query(
    "raw_csv_scan",
    f"WITH {st.RAW_SQL} SELECT document_id, hypothesis_id, text, raw_label AS label, len(evidence_texts) AS evidence FROM raw",
)
def raw_csv_scan(spark, folder):
    """Raw rows through CSV, evidence lists as JSON text."""
    path = scratch(spark)
    rows = st.raw_rows(spark, folder).drop("turn")
    columns = [
        F.to_json(c).alias(c) if c == "evidence_texts" else F.col(c)
        for c in ("document_id", "text", "hypothesis", "hypothesis_id", "label", "evidence_texts")
    ]
    rows.select(*columns).write.options(header="true", escape='"').csv(path)
    return readers.read_raw(spark, path, "csv").select(
        "document_id", "hypothesis_id", "text", "label", F.size("evidence_texts").cast("long").alias("evidence")
    )


def _split():
    return (
        F.when(F.col("doc_id") % 10 == 0, "test")
        .when(F.col("doc_id") % 10 == 1, "validation")
        .otherwise("train")
    )


def _versions(spark, folder):
    root = scratch(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text", "source", _split().alias("split"))
    writers.write_version(docs.filter("lang = 'en'"), root, "docs", "20240101_0900")
    writers.write_version(docs, root, "docs", "20240301_0900")
    writers.write_version(docs.drop("split"), root, "other", "20240201", split="train")
    return root


_SPLIT = "CASE doc_id % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'validation' ELSE 'train' END"


@query(
    "latest_version",
    f"SELECT doc_id, text, {_SPLIT} AS split, '20240301_0900' AS version FROM documents",
)
def latest_version(spark, folder):
    version = readers.read_version(spark, _versions(spark, folder), "docs")
    return version.select("doc_id", "text", "split", "version")


@query(
    "tagged_version_split",
    "SELECT doc_id, text FROM documents WHERE lang = 'en' AND doc_id % 10 = 1",
)
def tagged_version_split(spark, folder):
    splits = readers.read_splits(spark, _versions(spark, folder), "docs", "20240101_0900")
    return splits["validation"].select("doc_id", "text")


@query(
    "versions_listed",
    """SELECT k AS key, v AS version FROM (VALUES ('docs', '20240101_0900'), ('docs', '20240301_0900'),
      ('other', '20240201')) AS t(k, v) WHERE EXISTS (SELECT 1 FROM documents)""",
)
def versions_listed(spark, folder):
    return readers.list_versions(spark, _versions(spark, folder))


@query("jsonl_round_trip", "SELECT conv_id, turn, role, text FROM conversations")
def jsonl_round_trip(spark, folder):
    rows = table(spark, folder, "conversations")
    path = scratch(spark)
    writers.write_jsonl(rows, path)
    return readers.read_jsonl(spark, path, rows.schema)


@query(
    "checked_tokens_round_trip",
    """SELECT len(regexp_extract_all(lower(text), '[a-z0-9]+')) AS tokens, count(*) AS rows
    FROM conversations GROUP BY 1""",
)
def checked_tokens_round_trip(spark, folder):
    """Training arrays written and read back behind the column check."""
    from ...functions import text as tx

    letters = F.transform(tx.rouge_tokens(F.col("text")), lambda t: F.length(t))
    rows = table(spark, folder, "conversations").select(
        letters.alias("full_ids"), F.slice(letters, 1, 3).alias("prompt_ids")
    )
    path = scratch(spark)
    writers.write_tokens(prep.training_arrays(rows), path)
    stored = readers.read_checked(spark, path, ("input_ids", "attention_mask", "labels"))
    return stored.groupBy(F.size("labels").cast("long").alias("tokens")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@query(
    "metrics_round_trip",
    "SELECT count(*) AS count, round(avg(n_chars), 6) AS average, NULL::DOUBLE AS unset FROM documents",
)
def metrics_round_trip(spark, folder):
    metrics = table(spark, folder, "documents").agg(
        F.count(F.lit(1)).alias("count"), r6(F.avg("n_chars"), "average")
    )
    metrics = metrics.withColumn("unset", F.lit(None).cast("double"))
    path = scratch(spark)
    writers.write_metrics(metrics, path)
    return readers.read_jsonl(spark, path, metrics.schema)


@query(
    "prompts_round_trip",
    """SELECT text AS inputs, 0.2::DOUBLE AS temperature, least(n_chars, 2000) AS max_new_tokens FROM documents""",
)
def prompts_round_trip(spark, folder):
    parameters = F.struct(
        F.lit(0.2).alias("temperature"), F.least("n_chars", F.lit(2000)).alias("max_new_tokens")
    )
    payloads = table(spark, folder, "documents").select(
        F.col("text").alias("inputs"), parameters.alias("parameters")
    )
    path = scratch(spark)
    writers.write_prompts(payloads, path)
    return readers.read_prompts(spark, path).select(
        "inputs", "parameters.temperature", "parameters.max_new_tokens"
    )


@query(
    "request_log_scan",
    """SELECT epoch_us(ts) // 1000 AS ts_ms, '{"inputs": "' || event_type || '"}' AS input,
      CASE WHEN event_type = 'error' THEN '' ELSE props END AS output FROM events""",
)
def request_log_scan(spark, folder):
    """Events written as log blocks and read back."""
    path = scratch(spark)
    _log_blocks(table(spark, folder, "events")).write.text(path)
    return readers.read_request_log(spark, path).select("ts_ms", "input", "output")


def _log_blocks(events):
    block = F.concat(
        F.lit("timestamp: "),
        F.unix_millis(F.col("ts").cast("timestamp")).cast("string"),
        F.lit('\ninput: {"inputs": "'),
        F.col("event_type"),
        F.lit('"}\noutput: '),
        F.when(F.col("event_type") == "error", "").otherwise(F.col("props")),
        F.lit("\n"),
    )
    return events.select(block.alias("value"))


@query(
    "request_log_blocks",
    """SELECT epoch_us(ts) // 1000 AS ts_ms, '{"inputs": "' || event_type || '"}' AS input,
      CASE WHEN event_type = 'error' THEN '' ELSE props END AS output, way
    FROM events, (VALUES ('batch'), ('stream')) ways(way)""",
)
def request_log_blocks(spark, folder):
    """The log in byte ranges, once read whole and once as a stream over two arrivals."""
    path = scratch(spark)
    events = table(spark, folder, "events")
    late = F.col("event_id") % 3 == 0
    log = None
    for arrival in (events.filter(~late), events.filter(late)):
        _log_blocks(arrival).write.mode("append").text(f"{path}/log")
        log = log or readers.stream_request_blocks(spark, f"{path}/log", range_bytes=1 << 20)
        streamed = live.run_to_table(log, f"{path}/out", f"{path}/state")
    whole = readers.read_request_blocks(spark, f"{path}/log", range_bytes=1 << 20)
    ways = whole.withColumn("way", F.lit("batch")).union(streamed.withColumn("way", F.lit("stream")))
    return ways.select("ts_ms", "input", "output", "way")


@query(
    "scored_request_log",
    f"""WITH {st.QUOTES_SQL}, pairs AS (
      SELECT q.doc_id AS pid, d.text AS target, q.text AS prediction
      FROM quotes q JOIN documents d ON d.doc_id = q.doc_id), {sql_scores('pairs')}
    SELECT pid AS ts_ms, round({PRECISION}, 6) AS carp FROM scores""",
)
def scored_request_log(spark, folder):
    """Documents as logged requests, one quote each: from log text to grounding."""
    answer = F.struct(
        F.lit("h").alias("hypothesis"),
        F.lit("nda-1").alias("hypothesis_id"),
        F.lit("entailment").alias("label"),
        F.col("quote").alias("source_clause"),
    )
    generated = chat.answers_json(F.array(answer), wrap=True).alias("generated_text")
    prompt = chat.chatml(F.lit("Find quotes."), F.col("text")).alias("inputs")
    block = F.concat(
        F.lit("timestamp: "),
        F.col("doc_id").cast("string"),
        F.lit("\ninput: "),
        F.to_json(F.struct(prompt)),
        F.lit("\noutput: "),
        F.to_json(F.struct(generated)),
        F.lit("\n"),
    )
    quotes = st.quotes(spark, folder).select("doc_id", F.col("text").alias("quote"))
    path = scratch(spark)
    documents = texts(spark, folder, "text").join(quotes, "doc_id")
    documents.select(block.alias("value")).write.text(path)
    scored = jobs.score_log(readers.read_request_log(spark, path))
    return scored.select("ts_ms", r6(F.col("carp"), "carp"))


@query(
    "summary_files",
    """SELECT event_type AS tokenizer, count(*) AS "totalRequests", round(avg(value), 6) AS "averageLatency"
    FROM events GROUP BY event_type""",
)
def summary_files(spark, folder):
    """Summaries written one per file behind a noise line and read back."""
    summary = runs.bench_summary(st.requests(spark, folder), ["endpoint"]).withColumnRenamed(
        "endpoint", "tokenizer"
    )
    noisy = F.concat(F.lit("Loading from: prompts\n"), F.to_json(F.struct(*summary.columns)))
    path = scratch(spark)
    summary.select(F.col("tokenizer").alias("part"), noisy.alias("value")).write.partitionBy(
        "part"
    ).text(path)
    return readers.read_bench_summary(spark, path).select(
        "tokenizer", "totalRequests", r6(F.col("averageLatency"), "averageLatency")
    )


@query(
    "training_log_scan",
    f"WITH {st.LOG_SQL} SELECT step, loss, eval_loss FROM log",
)
def training_log_scan(spark, folder):
    """History files, one JSON array each."""
    entry = F.to_json(F.struct("step", "loss", "eval_loss"))
    part = F.floor(F.col("step") / 1000).alias("part")
    lists = st.training_log(spark, folder).groupBy(part).agg(F.collect_list(entry).alias("e"))
    array = F.concat(F.lit("["), F.array_join("e", ","), F.lit("]"))
    path = scratch(spark)
    lists.select("part", array.alias("value")).write.partitionBy("part").text(path)
    return readers.read_training_log(spark, path).drop("run")


@query(
    "appended_versions",
    """SELECT d.doc_id, 'labelled' AS origin, CAST(l.quality AS BIGINT) AS quality, 'v9' AS version
    FROM documents d JOIN labels l USING (doc_id)
    UNION ALL SELECT doc_id, 'production', -1, CASE WHEN lang = 'en' THEN 'v10' ELSE 'v11' END
    FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def appended_versions(spark, folder):
    """Labelled rows, then production rows in two appends; known ids are found by Bloom filters."""
    root = scratch(spark)
    documents = table(spark, folder, "documents")
    labelled = documents.join(table(spark, folder, "labels"), "doc_id").select(
        "doc_id", F.lit("labelled").alias("origin"), F.col("quality").cast("long").alias("quality")
    )
    new = documents.select(
        "doc_id", F.lit("production").alias("origin"), F.lit(-1).cast("long").alias("quality"), "lang"
    )
    appends.append_new(labelled, root, "training", "doc_id", "v9")
    appends.append_new(new.filter("lang = 'en'").drop("lang"), root, "training", "doc_id", "v10")
    appends.append_new(new.drop("lang"), root, "training", "doc_id", "v11")
    return appends.read_appended(spark, root, "training")


@query(
    "published_last",
    "SELECT doc_id, 'v10' AS version FROM documents WHERE lang = 'en'",
)
def published_last(spark, folder):
    """The latest version is the one published last, not the largest tag; a broken attempt is passed over."""
    root = scratch(spark)
    documents = table(spark, folder, "documents").select("doc_id", "lang", _split().alias("split"))
    writers.write_version(documents, root, "docs", "v9")
    broken, _ = writers.new_attempt(root, "docs", "v10")
    documents.filter("split = 'train'").drop("split").write.parquet(f"{broken}/split=train")
    writers.write_version(documents.filter("lang = 'en'"), root, "docs", "v10")
    return readers.read_version(spark, root, "docs").select("doc_id", "version")
