"""End-to-end jobs put together from the operators."""

from pyspark.sql import functions as F

from ..functions import chat
from ..operators import answers as ans, curate as cur, evaluate as ev, monitor as mon
from ..operators import prepare as prep
from ..session import settle
from ..sources import readers, writers


def curate_splits(spark, inputs, root, key, tag, fmt="parquet", origin="in_house", ts=None):
    """Raw files of several splits to one dataset version; ``inputs`` maps split to path.

    One job per split, each writing its own partition; the version is published after the last. A
    job that breaks off between splits can be run again under the same tag.
    """
    writers.refuse_published(spark, root, key, tag)
    target, attempt = writers.new_attempt(root, key, tag)
    for split, path in inputs.items():
        raw = readers.read_raw(spark, path, fmt, with_order=True)
        documents = cur.curate(raw, ["file", "row"], origin, ts)
        rows = cur.with_row_id(documents).withColumn("split", F.lit(split))
        rows.drop("split").write.mode("errorifexists").parquet(f"{target}/split={split}")
    writers.publish(spark, root, key, tag, attempt)
    return readers.read_version(spark, root, key, tag)


def coded_set(documents, system, vocab=None, tokenize=None):
    """Curated documents with ``prompt_ids`` and ``full_ids``, in the shared folder.

    ``tokenize`` maps a list of texts to lists of ids. Without it texts are cut without loss and
    numbered by ``vocab``, which is fitted on the documents unless given.
    """
    if tokenize is not None:
        coded = prep.chat_texts(documents, system)
        for side in ("prompt", "full"):
            coded = prep.encode_with(coded, tokenize, f"{side}_text", f"{side}_ids")
        return settle(prep.assert_prefix(coded.drop("prompt_text", "full_text")))
    tokens = prep.chat_tokens(documents, system).withColumn("_row", F.monotonically_increasing_id())
    tokens = settle(prep.assert_prefix(tokens, "full_tokens", "prompt_tokens"))
    if vocab is None:
        vocab = settle(prep.fit_vocab(tokens, "full_tokens"))
    coded = prep.encode(tokens, vocab, "_row", "full_tokens", "full_ids")
    prompt = F.slice("full_ids", F.lit(1), F.size("prompt_tokens"))
    return settle(coded.withColumn("prompt_ids", prompt).drop("_row"))


def training_set(coded, pad_id=0, max_prompt=None, max_sequence=None):
    """Training arrays of a coded set; see :func:`training_report` for what the limits cost."""
    kept = coded if max_prompt is None else prep.filter_prompt_len(coded, max_prompt)
    return prep.training_arrays(kept, pad_id, max_sequence)


def training_report(coded, max_prompt=None, max_sequence=None):
    """One row: documents, those that a prompt limit drops, and those that are cut."""
    nothing = F.lit(False)
    dropped = nothing if max_prompt is None else F.size("prompt_ids") > max_prompt
    cut = nothing if max_sequence is None else F.size("full_ids") > max_sequence
    return coded.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(dropped).alias("dropped"),
        F.count_if(cut & ~dropped).alias("cut"),
    )


def test_prompts(documents, system):
    """Evaluation inputs: rendered prompt and reference answers per document."""
    return documents.select(
        "document_id", chat.chatml(system, F.col("text")).alias("text"), "inference"
    )


def _output_pairs(outputs, references, doc):
    """Parsed outputs with their status, and the answers of whole documents with references.

    A document may come in several parts on either side; answers are matched by id over all of
    them, and one part that cannot be read leaves the document out.
    """
    texts = _numbered(outputs).select(doc, "part", "generated")
    parsed = settle(ans.parse_response(texts, "generated", wrapped=False))
    broken = parsed.filter(F.col("status") != "ok").select(doc).distinct()
    read = ans.explode_answers(ans.drop_failed(parsed).select(doc, "part", "answers"))
    given = ans.explode_answers(_numbered(references).select(doc, "part", "inference"), "inference")
    pairs = ev.match_reference(given, read.join(broken, doc, "left_anti"), doc, ("part", "position"))
    return parsed, pairs.select(doc, "label", "source_clause", "reference")


def _numbered(df):
    return df if "part" in df.columns else df.withColumn("part", F.lit(0))


def evaluate_outputs(outputs, references=None, doc="document_id"):
    """Generated texts and reference answers to document metrics.

    ``outputs`` has (document, generated), ``references`` (document, inference), each with a
    ``part`` where documents are cut; without ``references`` the outputs have both columns.
    """
    _, pairs = _output_pairs(outputs, outputs if references is None else references, doc)
    return ev.document_metrics(pairs, doc)


def document_outcomes(outputs, references=None, doc="document_id"):
    """The metrics of every reference document, and its ``outcome``.

    ``missing``: no output; ``failed``: an output cannot be read; ``unmatched``: an answer has
    no reference; ``scored``: it has metrics, which are null otherwise.
    """
    references = outputs if references is None else references
    parsed, pairs = _output_pairs(outputs, references, doc)
    answered = parsed.groupBy(doc).agg(F.max((F.col("status") != "ok").cast("int")).alias("_broken"))
    metrics = ev.document_metrics(pairs, doc)
    known = references.select(doc).distinct().join(answered, doc, "left").join(metrics, doc, "left")
    outcome = (
        F.when(F.col("_broken").isNull(), "missing")
        .when(F.col("_broken") == 1, "failed")
        .when(F.col("accuracy").isNull(), "unmatched")
        .otherwise("scored")
    )
    return known.withColumn("outcome", outcome).drop("_broken")


def release_check(
    outputs, references=None, doc="document_id", rules=ev.RELEASE_RULES, least_scored=0.95
):
    """One row: dataset metrics, documents left out and why, and the gate on both."""
    outcomes = document_outcomes(outputs, references, doc)
    return ev.gate(ev.dataset_metrics(outcomes), (*rules, ("scored_share", least_scored)))


def score_log(log):
    """Request log rows to scored responses: contract, status, answers, grounding."""
    contract = chat.split_chatml(F.get_json_object("input", "$.inputs"))["user"]
    parsed = ans.parse_response(log.withColumn("contract", contract))
    return mon.carp_in_row(ans.drop_failed(parsed))

