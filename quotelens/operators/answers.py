"""Model responses: strict parsing, one status per row, and checks on the answers."""

from pyspark.sql import functions as F, types as T

from ..functions.text import bind
from ..schemas import ANSWER, ANSWER_FIELDS, DEFAULT_LEGEND, LABELS, MAX_REQUEST_TOKENS

_ANSWERS = T.ArrayType(ANSWER)
# Spark's JSON reader keeps the last of repeated keys, as json.loads does.
_STRICT = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "bad"}


def is_json(text):
    """Whether the text is exactly one JSON value: not cut off, nothing after it.

    Readers stop after the first value, so it is read as a member of an object and as the
    only element of an array; only a single whole value fits in both places.
    """
    as_member = F.from_json(
        F.concat(F.lit('{"v":'), text, F.lit("}")), "v string, bad string", _STRICT
    )
    as_element = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    return F.coalesce(
        (F.trim(text) != "") & as_member.isNotNull() & as_member["bad"].isNull() & (as_element == 1),
        F.lit(False),
    )


def _is_object(text):
    return text.rlike(r"^[ \t\r\n]*\{")


def _kind(text, path):
    """JSON type at a path; null when absent or when a key repeats."""
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(text), path, "variant"))


def _failed(status):
    return F.struct(F.lit(status).alias("status"), F.lit(None).cast(_ANSWERS).alias("answers"))


def read_generated(generated):
    """Struct of status and answers for generated text."""
    seen = F.struct(
        is_json(generated).alias("valid"),
        _is_object(generated).alias("object"),
        F.array_contains(F.json_object_keys(generated), "Hypotheses").alias("named"),
        F.from_json(generated, "Hypotheses array<string>", _STRICT)["Hypotheses"].alias("list"),
        F.from_json(generated, T.StructType().add("Hypotheses", _ANSWERS), _STRICT)[
            "Hypotheses"
        ].alias("answers"),
    )

    def judge(s):
        usable = s["answers"].isNotNull() & ~F.exists(s["answers"], lambda a: a.isNull())
        return (
            F.when(~s["valid"], _failed("bad_inner"))
            .when(~s["object"] | ~F.coalesce(s["named"], F.lit(False)), _failed("no_hypotheses"))
            .when(s["list"].isNull(), _failed("not_a_list"))
            .when(F.size(s["list"]) == 0, _failed("empty_list"))
            .when(~usable, _failed("bad_item"))
            .otherwise(F.struct(F.lit("ok").alias("status"), s["answers"].alias("answers")))
        )

    return bind(seen, judge)


def read_response(response):
    """The same for a whole response, whose ``generated_text`` is JSON again."""
    generated = F.from_json(response, "generated_text string", _STRICT)["generated_text"]
    seen = F.struct(
        is_json(response).alias("valid"),
        F.when(_is_object(response), generated).alias("generated"),
        F.coalesce(_kind(response, "$.generated_text") == "STRING", F.lit(True)).alias("text"),
    )

    def judge(s):
        return (
            F.when(~s["valid"], _failed("bad_outer"))
            .when(s["generated"].isNull(), _failed("no_generated_text"))
            .when(~s["text"], _failed("bad_inner"))
            .otherwise(read_generated(s["generated"]))
        )

    return bind(seen, judge)


def parse_response(df, column="output", wrapped=True):
    """Add ``status`` and ``answers`` (null unless ok); no row is dropped.

    The statuses: bad_outer, no_generated_text, bad_inner, no_hypotheses, not_a_list,
    empty_list, bad_item, ok. Without ``wrapped`` the column holds generated text.

    A generator keeps later filters on the status from repeating the parse below it.
    """
    read = read_response if wrapped else read_generated
    return df.select("*", F.inline(F.array(bind(F.col(column), read))))


def drop_failed(df):
    return df.filter(F.col("status") == "ok")


def valid_pairs(df, column="generated"):
    """Usable outputs with their own reference: both sit in one row, so none can slip."""
    return drop_failed(parse_response(df, column, wrapped=False))


def explode_answers(df, answers="answers"):
    """One row per answer with its position in the list."""
    rest = [c for c in df.columns if c != answers]
    return df.select(*rest, F.posexplode(answers).alias("position", "_answer")).select(
        *rest, "position", "_answer.*"
    )


def schema_violations(df, ids=tuple(i for i, _ in DEFAULT_LEGEND), answers="answers"):
    """Add ``violations``: which rules the answer list of the row breaks.

    Missing fields and unknown labels break the declared schema; a null list (``no_list``),
    unknown ids, repeated ids and a list without all ids are our own checks.
    """
    items = F.col(answers)
    seen = F.transform(items, lambda a: a["hypothesis_id"])
    missing = F.exists(
        items, lambda a: F.greatest(*[a[f].isNull().cast("int") for f in ANSWER_FIELDS]) == 1
    )
    rules = [
        (items.isNull(), "no_list"),
        (missing, "missing_field"),
        (F.exists(items, lambda a: ~a["label"].isin(*LABELS)), "unknown_label"),
        (F.exists(seen, lambda i: ~i.isin(*ids)), "unknown_id"),
        (F.size(F.array_distinct(seen)) < F.size(seen), "repeated_id"),
        (F.size(F.array_except(F.array(*map(F.lit, ids)), seen)) > 0, "incomplete"),
    ]
    return df.withColumn(
        "violations",
        F.array_compact(F.array(*[F.when(broken, F.lit(name)) for broken, name in rules])),
    )


def filter_request_len(df, limit=MAX_REQUEST_TOKENS, ids="prompt_ids"):
    """Requests below the limit; one at the limit is skipped."""
    return df.filter(F.size(ids) < limit)


def map_rows(df, fn, schema):
    """Apply a Python function to rows in parallel; a failing row is marked, not fatal.

    ``fn`` maps a dict to a dict with the fields of ``schema``; an error in it and a result of
    the wrong type mark the row. Result: the input columns, those fields, ``status``, ``error``.
    """
    added = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    out = T.StructType(
        [
            *df.schema.fields,
            *added.fields,
            T.StructField("status", T.StringType()),
            T.StructField("error", T.StringType()),
        ]
    )
    names = [f.name for f in added.fields]

    def call(row):
        try:
            result = fn(row)
            return {**row, **{n: result[n] for n in names}, "status": "ok", "error": None}
        except Exception as problem:
            failed = {**row, **dict.fromkeys(names), "status": "failed"}
            return {**failed, "error": f"{type(problem).__name__}: {problem}"}

    def batches(record_batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow_schema = to_arrow_schema(out)
        for batch in record_batches:
            yield from typed_batches([call(r) for r in batch.to_pylist()], arrow_schema, names)

    return df.mapInArrow(batches, out)


def typed_batches(rows, schema, names):
    """Rows as Arrow batches; one whose ``names`` have the wrong types is marked as failed."""
    import pyarrow as pa

    wrong = (pa.ArrowException, TypeError, ValueError, OverflowError)

    def typed(row):
        try:
            return pa.RecordBatch.from_pylist([row], schema)
        except wrong as problem:
            failed = {**row, **dict.fromkeys(names), "status": "failed"}
            failed["error"] = f"{type(problem).__name__}: {problem}"
            return pa.RecordBatch.from_pylist([failed], schema)

    try:
        yield pa.RecordBatch.from_pylist(rows, schema)
    except wrong:
        yield from map(typed, rows)
