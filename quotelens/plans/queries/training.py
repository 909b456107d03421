"""Vocabulary, token ids and padded training arrays."""

from pyspark.sql import functions as F

from ...functions import arrays, text as tx
from ...operators import prepare as prep
from ...operators.joins import BROADCAST_ROWS
from ...session import settle
from .. import jobs
from .registry import TOKENS, query, table, texts

_VOCAB = """vocab AS (
    SELECT token, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, token) AS token_id
    FROM (SELECT unnest({0}) AS token FROM {1}) GROUP BY token)"""

# Every document, cut without loss; its first tokens (up to 49) count as the prompt.
_PIECES = r"""regexp_extract_all(coalesce(text, ''), '<\|im_(?:start|end)\|>|[ \t\n\x0B\f\r]+|[\p{L}\p{N}_]+|[^ \t\n\x0B\f\r\p{L}\p{N}_]')"""
_ROWS = f"""pieces AS (
    SELECT doc_id, full_tokens, len(full_tokens) % 50 AS n_prompt
    FROM (SELECT doc_id, {_PIECES} AS full_tokens FROM documents))"""
_CODED = f"""{_ROWS}, {_VOCAB.format('full_tokens', 'pieces')},
    positions AS (SELECT doc_id, unnest(full_tokens) AS token,
                         unnest(range(0, len(full_tokens))) AS pos FROM pieces),
    coded AS (SELECT doc_id, pos, token_id FROM positions JOIN vocab USING (token)),
    rows_ AS (SELECT p.doc_id, p.n_prompt, count(c.pos) AS n_full,
                     list(c.token_id ORDER BY c.pos) FILTER (WHERE c.pos IS NOT NULL) AS ids
              FROM pieces p LEFT JOIN coded c ON c.doc_id = p.doc_id GROUP BY 1, 2)"""


def _rows(spark, folder):
    """Documents with ``full_tokens`` and, of these, ``prompt_tokens``."""
    pieces = texts(spark, folder, "text").select(
        "doc_id", tx.chat_pieces(F.col("text")).alias("full_tokens")
    )
    n_prompt = F.size("full_tokens") % 50
    return pieces.withColumn("prompt_tokens", F.slice("full_tokens", F.lit(1), n_prompt))


def _coded(spark, folder, limit=BROADCAST_ROWS):
    rows = settle(_rows(spark, folder))
    vocab = settle(prep.fit_vocab(rows, "full_tokens"))
    rows = prep.encode(rows, vocab, "doc_id", "full_tokens", "full_ids", limit=limit)
    n_prompt = F.size("prompt_tokens")
    return rows.withColumn("prompt_ids", F.slice("full_ids", F.lit(1), n_prompt))


def _text(ids, name):
    return F.md5(F.array_join(F.transform(ids, lambda t: t.cast("string")), ",")).alias(name)


def _sql_text(ids):
    return f"md5(coalesce(array_to_string({ids}, ','), ''))"


@query(
    "vocabulary",
    f"""WITH {_VOCAB.format(TOKENS.format('text'), 'documents')} SELECT token, count, token_id FROM vocab""",
)
def vocabulary(spark, folder):
    tokens = texts(spark, folder, "text").select(tx.rouge_tokens(F.col("text")).alias("tokens"))
    return prep.fit_vocab(tokens).select("token", "count", F.col("token_id").cast("long").alias("token_id"))


_IDS = f"WITH {_CODED} SELECT doc_id, n_full, {_sql_text('ids')} AS ids FROM rows_"


def _ids(coded):
    return coded.select("doc_id", F.size("full_ids").cast("long").alias("n_full"), _text("full_ids", "ids"))


@query("token_ids", _IDS)
def token_ids(spark, folder):
    """Ids through the size-checked vocabulary in memory."""
    return _ids(_coded(spark, folder))


@query("token_ids_by_lookup", _IDS)
def token_ids_by_lookup(spark, folder):
    """The same with few tokens in memory and a join for the rest."""
    return _ids(_coded(spark, folder, limit=500))


@query(
    "outside_token_ids",
    "SELECT doc_id, strlen(coalesce(text, '')) AS n_ids, true AS decoded FROM documents",
)
def outside_token_ids(spark, folder):
    """Ids of an outside tokenizer (here: the bytes of the text), from which the text comes back."""
    docs = texts(spark, folder, "text").withColumn("text", F.coalesce("text", F.lit("")))
    coded = prep.encode_with(docs, lambda values: [list(v.encode()) for v in values])
    back = F.array_join(F.transform("ids", lambda b: F.lpad(F.hex(b), 2, "0")), "")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        (F.decode(F.unhex(back), "utf-8") == F.col("text")).alias("decoded"),
    )


@query(
    "prompt_prefixes",
    f"WITH {_ROWS} SELECT doc_id, true AS starts, false AS shifted FROM pieces WHERE n_prompt > 0",
)
def prompt_prefixes(spark, folder):
    """Full ids start with the prompt ids, and not with altered ones."""
    rows = prep.assert_prefix(_coded(spark, folder)).filter(F.size("prompt_ids") > 0)
    altered = F.transform("prompt_ids", lambda t: t + 1)
    return rows.select(
        "doc_id",
        arrays.starts_with(F.col("full_ids"), F.col("prompt_ids")).alias("starts"),
        arrays.starts_with(F.col("full_ids"), altered).alias("shifted"),
    )


_LABELS = "list_transform(ids, lambda v, i: CASE WHEN i <= n_prompt THEN -100 ELSE v END)"


@query(
    "training_arrays",
    f"""WITH {_CODED} SELECT doc_id, {_sql_text('list_slice(ids, 1, 120)')} AS input_ids,
      md5(rtrim(repeat('1,', CAST(least(n_full, 120) AS INT)), ',')) AS attention_mask,
      {_sql_text(f'list_slice({_LABELS}, 1, 120)')} AS labels
    FROM rows_""",
)
def training_arrays(spark, folder):
    """Loss mask over the prompt, cut, attention mask."""
    rows = prep.training_arrays(_coded(spark, folder), limit=120)
    return rows.select(
        "doc_id", *[_text(c, c) for c in ("input_ids", "attention_mask", "labels")]
    )


@query(
    "training_set",
    f"""WITH {_CODED} SELECT doc_id, {_sql_text('ids')} AS input_ids, {_sql_text(_LABELS)} AS labels
    FROM rows_ WHERE n_prompt <= 40""",
)
def training_set(spark, folder):
    """The job without a sequence limit: nothing is cut, long prompts are dropped as asked."""
    rows = jobs.training_set(_coded(spark, folder), max_prompt=40)
    return rows.select("doc_id", _text("input_ids", "input_ids"), _text("labels", "labels"))


@query(
    "training_report",
    f"""WITH {_ROWS} SELECT count(*) AS rows, count(*) FILTER (WHERE n_prompt > 40) AS dropped,
      count(*) FILTER (WHERE n_prompt <= 40 AND len(full_tokens) > 300) AS cut FROM pieces""",
)
def training_report(spark, folder):
    """What limits would drop and cut."""
    rows = _rows(spark, folder).withColumnsRenamed(
        {"full_tokens": "full_ids", "prompt_tokens": "prompt_ids"}
    )
    return jobs.training_report(rows, max_prompt=40, max_sequence=300)


@query(
    "long_prompts_dropped",
    f"""WITH {_ROWS} SELECT doc_id, n_prompt FROM pieces WHERE n_prompt <= 20""",
)
def long_prompts_dropped(spark, folder):
    rows = _rows(spark, folder).withColumnRenamed("prompt_tokens", "prompt_ids")
    return prep.filter_prompt_len(rows, 20).select(
        "doc_id", F.size("prompt_ids").cast("long").alias("n_prompt")
    )


@query(
    "padded_batches",
    f"""WITH {_CODED}, wide AS (
      SELECT *, CAST(ceil(max(n_full) OVER (PARTITION BY doc_id // 4) / 8.0) * 8 AS INT) AS width FROM rows_)
    SELECT doc_id, width,
      md5(rtrim(coalesce(array_to_string(ids, ','), '') || repeat(',0', CAST(width - n_full AS INT)), ',')) AS input_ids,
      CAST(n_full AS BIGINT) AS attended, CAST(n_prompt + width - n_full AS BIGINT) AS ignored
    FROM wide WHERE n_full > 0""",
)
def padded_batches(spark, folder):
    """Every four documents are a batch, padded to its longest row and a multiple of 8."""
    rows = prep.training_arrays(_coded(spark, folder), limit=None)
    padded = prep.pad_batches(rows.withColumn("batch", F.floor(F.col("doc_id") / 4)), "batch")

    def count(column, wanted):
        return F.size(F.filter(column, lambda t: t == wanted)).cast("long")

    return padded.filter(F.size("full_ids") > 0).select(
        "doc_id",
        F.col("width"),
        _text("input_ids", "input_ids"),
        count("attention_mask", 1).alias("attended"),
        count("labels", -100).alias("ignored"),
    )


@query(
    "batch_numbers",
    "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 7 + 1 AS batch FROM documents",
)
def batch_numbers(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id")
    return prep.batch_no(docs, ["doc_id"], 7)
