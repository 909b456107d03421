"""Training arrays: vocabulary, token ids, loss masks, length filters, padded batches."""

from pyspark.sql import Window, functions as F

from ..functions import arrays, chat, text as tx
from ..schemas import IGNORED_LABEL, MAX_PROMPT_TOKENS, MAX_SEQUENCE, PAD_MULTIPLE
from ..session import settle
from .joins import BROADCAST_ROWS, fits
from .ordered import row_numbers

LONG_TOKEN = 256
CHUNK_ROWS = 1024  # rows that ask for their tokens together
CALL_BYTES = 1 << 20  # text handed to an outside tokenizer at once
BATCH_BYTES = 8 << 20  # token lists handed to a worker at once


def fit_vocab(df, tokens="tokens", first_id=1):
    """Token ids by falling count, then by token; ids below ``first_id`` stay free.

    """
    # An outer explode gets no filter on the array, which would compute the tokens twice.
    words = df.select(F.explode_outer(tokens).alias("token")).filter("token is not null")
    counts = words.groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    ranked = row_numbers(counts, [], [F.desc("count"), "token"], "_rank")
    return ranked.select(
        "token", "count", (F.col("_rank") - 1 + first_id).cast("int").alias("token_id")
    )


def _chunk():
    return F.expr(f"monotonically_increasing_id() div {CHUNK_ROWS}")


def _joined_ids(rare, vocab, key, unknown_id):
    """Rows of key, positions and their tokens to one ordered list of (position, id) per key.

    A chunk of rows asks for each of its tokens once. So what is joined by token are the different
    tokens of the chunks, and a frequent token has no more rows than there are chunks.
    """
    missing = (
        F.raise_error(F.concat(F.lit("token not in vocabulary: "), F.col("token"))).cast("int")
        if unknown_id is None
        else F.lit(unknown_id)
    )
    rows = rare if "_chunk" in rare.columns else settle(rare.withColumn("_chunk", _chunk()))
    rows = rows.select("_chunk", F.col(key).alias("_key"), "_pos", "_tokens")
    wanted = rows.select(F.col("_chunk").alias("_asker"), F.explode("_tokens").alias("token")).distinct()
    known = wanted.join(vocab.select("token", "token_id"), "token", "left")
    known = known.select("_asker", "token", F.coalesce("token_id", missing).cast("int").alias("_id"))
    schema = f"_key {rows.schema['_key'].dataType.simpleString()}, _at array<struct<_pos: int, _id: int>>"
    found = rows.groupBy("_chunk").cogroup(known.groupBy("_asker")).applyInArrow(_ids_of_chunk, schema)
    return found.groupBy(F.col("_key").alias(key)).agg(F.sort_array(F.flatten(F.collect_list("_at"))).alias("_at"))


def _ids_of_chunk(rows, known):
    import pyarrow as pa
    import pyarrow.compute as pc

    rows, known = rows.combine_chunks(), known.combine_chunks()
    tokens, positions, words, ids = (
        t[c].combine_chunks() for t, c in ((rows, "_tokens"), (rows, "_pos"), (known, "token"), (known, "_id"))
    )
    found = ids.take(pc.index_in(tokens.flatten(), value_set=words))
    entries = pa.StructArray.from_arrays([positions.flatten(), found], ["_pos", "_id"])
    return pa.table({"_key": rows["_key"], "_at": _lists(_ends(tokens), entries)})


def _ends(lists):
    """Where the lists of an Arrow array without nulls begin and end in its flat values."""
    import numpy as np
    import pyarrow.compute as pc

    return np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])


def _lists(ends, values):
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def encode(df, vocab, key, tokens="tokens", name="ids", unknown_id=None, limit=BROADCAST_ROWS):
    """Token ids of every row, in token order; ``key`` identifies a row.

    The ``limit`` first tokens of the vocabulary are held in memory. A fitted vocabulary starts
    with its most frequent tokens, so the positions that are left for the join are few and no
    token is hot; one that fits whole needs no shuffle. Tokens of more than ``LONG_TOKEN`` bytes
    are always joined, so the memory is bounded. A token outside the vocabulary gets
    ``unknown_id`` or fails; a null list has no ids. Where tokens are joined, what memory gives is
    stored first, with ``df``.
    """
    short = F.octet_length("token") <= LONG_TOKEN
    whole = fits(vocab, limit) is not None and vocab.filter(~short).isEmpty()
    first = vocab if whole else vocab.filter(short).orderBy("token_id").limit(limit)
    listed = df.withColumn(tokens, F.coalesce(tokens, F.array().cast("array<string>")))
    found = listed.withColumn("_found", _memory_ids(first)(tokens)).withColumn(name, F.col("_found.ids"))
    rare = F.col("_found._tokens")
    if whole:
        fallback = (
            F.raise_error(F.concat(F.lit("token not in vocabulary: "), F.get(rare, F.lit(0))))
            if unknown_id is None
            else F.transform(name, lambda t: F.coalesce(t, F.lit(unknown_id)))
        )
        ids = F.when(F.size(rare) > 0, fallback.cast("array<int>")).otherwise(F.col(name))
        return found.withColumn(name, ids).drop("_found")
    stored = found.select("*", "_found._pos", "_found._tokens", _chunk().alias("_chunk"))
    found = _settle_in_batches(stored.drop("_found"))
    left = found.filter(F.size("_pos") > 0).select("_chunk", key, "_pos", "_tokens")
    lists = _joined_ids(left, vocab, key, unknown_id)
    memory = F.filter(
        F.transform(name, lambda t, i: F.struct(i.alias("_pos"), t.alias("_id"))),
        lambda p: p["_id"].isNotNull(),
    )
    merged = F.sort_array(F.concat(memory, F.col("_at")))["_id"]
    return (
        found.join(lists, key, "left")
        .withColumn(name, F.when(F.col("_at").isNull(), F.col(name)).otherwise(merged))
        .drop("_at", "_pos", "_tokens", "_chunk")
    )


def _settle_in_batches(df):
    """``df`` settled while Arrow batches end at ``BATCH_BYTES``; by rows alone, 10,000 lists make one.

    Executors hold a batch several times, outside their heap and in the worker.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(name, None)
    conf.set(name, str(BATCH_BYTES))
    try:
        return settle(df, compression="zstd")
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def _memory_ids(vocab):
    """Arrow function from token lists to id lists, and what is not held: positions and tokens.

    Ids are null there. Tokens stay in Arrow's buffers; no Python object is made of any.
    """
    table = vocab.select("token", "token_id").toArrow().combine_chunks()
    held = [table[c].combine_chunks() for c in table.column_names]
    shared = vocab.sparkSession.sparkContext.broadcast((held[0], held[1].cast("int32")))

    def lookup(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        words, ids = shared.value
        for lists in batches:
            flat, ends = lists.flatten(), _ends(lists)
            found = ids.take(pc.index_in(flat, value_set=words))
            at = np.flatnonzero(found.is_null().to_numpy(zero_copy_only=False))
            row = np.searchsorted(ends, at, "right") - 1
            rare = np.searchsorted(at, ends)
            columns = {
                "ids": _lists(ends, found),
                "_pos": _lists(rare, pa.array(at - ends[row], pa.int32())),
                "_tokens": _lists(rare, flat.take(pa.array(at))),
            }
            yield pa.StructArray.from_arrays([*columns.values()], [*columns])

    return _arrow_udf(lookup, "ids array<int>, _pos array<int>, _tokens array<string>")


def encode_with(df, tokenize, text="text", name="ids"):
    """Ids from an outside tokenizer: ``tokenize`` maps a list of texts to lists of ids.

    It is called with ``CALL_BYTES`` of text at a time, or with one longer text.
    """

    def run(batches):
        import pyarrow as pa

        for texts in batches:
            for some in _slices(texts, CALL_BYTES):
                yield pa.array(list(tokenize(some.to_pylist())), pa.list_(pa.int32()), from_pandas=True)

    return df.withColumn(name, _arrow_udf(run, "array<int>")(text))


def _slices(texts, most):
    """Parts of an Arrow array of texts, in order, of at most ``most`` bytes or one text."""
    import pyarrow.compute as pc

    start, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)):
        if i > start and held + n > most:
            yield texts.slice(start, i - start)
            start, held = i, 0
        held += n
    if len(texts) > start:
        yield texts.slice(start)


def _arrow_udf(fn, kind):
    from collections.abc import Iterator

    import pyarrow as pa

    fn.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(fn, kind)


def chat_texts(df, system, answers="inference", text="text", wrap=False):
    """Add ``prompt_text`` and ``full_text``, the rendered conversation without and with answers."""
    turn = chat.answers_json(F.col(answers), wrap)
    return df.withColumns(
        {
            "prompt_text": chat.chatml(system, F.col(text)),
            "full_text": chat.chatml(system, F.col(text), turn),
        }
    )


def chat_tokens(df, system, answers="inference", text="text", wrap=False, cut=tx.chat_pieces):
    """Add ``prompt_tokens`` and ``full_tokens`` of the rendered conversation; nothing is lost."""
    rendered = chat_texts(df, system, answers, text, wrap)
    tokens = {f"{side}_tokens": cut(F.col(f"{side}_text")) for side in ("prompt", "full")}
    return rendered.withColumns(tokens).drop("prompt_text", "full_text")


def assert_prefix(df, full="full_ids", prompt="prompt_ids"):
    """Fail the job where the full ids do not begin with the prompt ids."""
    problem = F.raise_error("full ids do not start with the prompt ids").cast(df.schema[full].dataType)
    checked = F.when(arrays.starts_with(F.col(full), F.col(prompt)), F.col(full)).otherwise(problem)
    return df.withColumn(full, checked)


def filter_prompt_len(df, limit=MAX_PROMPT_TOKENS, ids="prompt_ids"):
    """Rows whose prompt has at most ``limit`` tokens."""
    return df.filter(F.size(ids) <= limit)


def training_arrays(df, pad_id=0, limit=MAX_SEQUENCE, full="full_ids", prompt="prompt_ids"):
    """Add ``input_ids``, ``attention_mask`` and ``labels``, cut to ``limit`` unless it is None."""
    labels, ids = arrays.loss_labels(F.col(full), F.col(prompt), pad_id), F.col(full)
    if limit is not None:
        labels, ids = arrays.truncate(labels, limit), arrays.truncate(ids, limit)
    return df.withColumns(
        {"input_ids": ids, "attention_mask": arrays.attention(ids, pad_id), "labels": labels}
    )


def batch_no(df, order, size, name="batch"):
    """Mini-batch number along the order, from 1."""
    numbered = row_numbers(df, [], order, "_row")
    return numbered.withColumn(name, F.expr(f"(_row - 1) div {int(size)} + 1")).drop("_row")


def pad_batches(df, batch="batch", multiple=PAD_MULTIPLE, pad_id=0):
    """Pad the three arrays to the longest row of the batch, up to a multiple.

    A batch is padded in one task, as it is trained on in one step.
    """
    longest = F.max(F.size("input_ids")).over(Window.partitionBy(batch))
    fill = {"input_ids": pad_id, "attention_mask": 0, "labels": IGNORED_LABEL}
    return df.withColumn("width", arrays.padded_width(longest, multiple)).withColumns(
        {c: arrays.pad_to(F.col(c), F.col("width"), value) for c, value in fill.items()}
    )
