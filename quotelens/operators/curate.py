"""Raw question rows to one nested row per document, and training-set upkeep."""

from pyspark.sql import functions as F

from ..functions import chat
from ..schemas import NOT_MENTIONED, RAW_NOT_MENTIONED
from .joins import fits, hinted
from .ordered import one_column, running

LIMIT, LIMIT_BYTES = 65_536, 64 << 20  # of one answer list


def normalise_label(df, column="label"):
    return df.replace({RAW_NOT_MENTIONED: NOT_MENTIONED}, subset=[column])


def drop_unmentioned(df, column="label"):
    """Keep rows with evidence; null labels stay, as an inequality in pandas keeps them."""
    unmentioned = F.col(column).isin(NOT_MENTIONED, RAW_NOT_MENTIONED)
    return df.filter(F.coalesce(~unmentioned, F.lit(True)))


def assert_fields(df):
    """Fail the job on a row whose answer would hold a null (a null quote included)."""
    broken = (
        F.col("hypothesis_id").isNull()
        | F.col("hypothesis").isNull()
        | F.col("label").isNull()
        | F.col("evidence_texts").isNull()
        | F.exists("evidence_texts", lambda e: e.isNull())
    )
    message = F.concat(
        F.lit("answer with a null field in document "),
        F.coalesce(F.col("document_id").cast("string"), F.lit("?")),
    )
    # The check sits on a column that every consumer keeps, so pruning cannot remove it.
    checked = F.when(broken, F.raise_error(message).cast("string")).otherwise(F.col("label"))
    return df.withColumn("label", checked)


def first_per_doc(df, order, key="document_id"):
    """First row per document by position; other columns may be null."""
    others = [c for c in df.columns if c != key]
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min_by(F.struct(*others), one_column(order)).alias("_row"))
        .select(key, "_row.*")
    )


def group_answers(
    df, order, item, key="document_id", name="inference", limit=LIMIT, limit_bytes=LIMIT_BYTES
):
    """Collect ``item`` into lists per document, in input order.

    Every row has a ``part``, 0 for a document within the limits. A list with more than ``limit``
    entries or ``limit_bytes`` bytes of text goes on in rows with higher parts (numbers may be
    skipped); the parts in order are the whole list.
    """
    rows = df.filter(F.col(key).isNotNull())
    parted, _ = _with_parts(rows, key, order, item, limit, limit_bytes)
    grouped = parted.groupBy(key, "part").agg(
        F.array_sort(F.collect_list(F.struct(*order, item.alias("_item")))).alias("_items")
    )
    return grouped.select(key, "part", F.col("_items._item").alias(name))


def _large_keys(rows, key, weight, limit, limit_bytes):
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), F.sum(weight).alias("_bytes"))
    return sizes.filter((F.col("_rows") > limit) | (F.col("_bytes") > limit_bytes)).select(key)


def _with_parts(rows, key, order, item, limit, limit_bytes):
    """``rows`` with a ``part``, and whether any document is beyond the limits.

    Only the rows of such documents are put in order.
    """
    weight = F.coalesce(F.octet_length(F.to_json(F.struct(item.alias("v")))), F.lit(0))
    large = _large_keys(rows, key, weight, limit, limit_bytes)
    n_large = fits(large)
    if n_large == 0:
        return rows.withColumn("part", F.lit(0)), False
    large = hinted(large, n_large)
    before = {
        "_row": ("sum", F.lit(1), True),
        "_bytes": ("sum", weight, True),
    }
    cut = running(rows.join(large, key, "left_semi"), [key], order, before)
    part = F.expr(f"_row div {int(limit)} + _bytes div {int(limit_bytes)}").cast("int")
    others = rows.join(large, key, "left_anti").withColumn("part", F.lit(0))
    return others.unionByName(cut.withColumn("part", part).drop("_row", "_bytes")), True


def curate(
    df, order, origin="in_house", ts=None, limit=LIMIT, limit_bytes=LIMIT_BYTES, label_name="label"
):
    """Raw rows to curated documents.

    ``order`` names the columns that give the input order. Lists are cut into parts as in
    :func:`group_answers`; every part has the text of the document's first row.
    """
    rows = assert_fields(normalise_label(df.filter(F.col("document_id").isNotNull())))
    answer = chat.answer_struct(label_name=label_name)
    parted, cut = _with_parts(rows, "document_id", order, answer, limit, limit_bytes)
    grouped = parted.select(
        "document_id", "part", "text", one_column(order).alias("_at"), answer.alias("_answer")
    ).groupBy("document_id", "part").agg(
        F.min_by("text", "_at").alias("text"),
        F.array_sort(F.collect_list(F.struct("_at", "_answer"))).alias("_list"),
    )
    if cut:
        later = grouped.filter("part > 0").select("document_id").distinct()
        first = grouped.filter("part = 0").join(later, "document_id", "left_semi")
        first = first.select("document_id", F.col("text").alias("_first"))
        grouped = grouped.join(first, "document_id", "left").withColumn(
            "text", F.when(F.col("part") > 0, F.col("_first")).otherwise(F.col("text"))
        )
    documents = grouped.select("document_id", "text", F.col("_list._answer").alias("inference"), "part")
    return with_provenance(documents, origin, ts)


def with_provenance(df, origin="in_house", ts=None):
    """Empty model fields, the time of the run and the origin."""
    stamp = F.current_timestamp() if ts is None else ts
    return df.withColumns(
        {
            "model_repo": F.lit(""),
            "model_repo_version": F.lit(""),
            "timestamp": stamp,
            "origin": F.lit(origin),
        }
    )


def with_row_id(df, key=None):
    """Row id in front: random, or a digest of the ``key`` columns that a rerun repeats."""
    if key is None:
        row_id = F.uuid()
    else:
        row_id = F.sha2(F.to_json(F.struct(*key)), 256)
    return df.select(row_id.alias("id"), *df.columns)


def explode_hypotheses(df, column="hypothesises/labels"):
    """One row per entry of the nested list of a long-form row."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    return df.select(*rest, F.explode(F.col(f"`{column}`")).alias("_entry")).select(
        *rest, "_entry.*"
    )


def append_training(base, new, key):
    """Base rows plus those new rows whose key the base does not have yet.

    Of new rows with one key the smallest row stays, columns compared from left to right.
    """
    keys = [key] if isinstance(key, str) else list(key)
    fresh = new.join(base.select(*keys).distinct(), keys, "left_anti")
    rest = [c for c in new.columns if c not in keys]
    if rest:
        one = fresh.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
        fresh = one.select(*keys, "_row.*")
    else:
        fresh = fresh.distinct()
    return base.unionByName(fresh)

