"""Raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before kept and returns those it keeps, with the same
columns; the last returns packed pieces. Every stage is written as Parquet and read again, so a
lost executor costs part of a stage at most.

Edge cases are those of the operators: null and empty texts, repeated rows, null ids and empty
tables pass through every stage. ``documents`` may have any further columns, which the stages keep.
"""

import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from quotelens.llm import decontaminate, line_runs, quality, queries, simhash  # noqa: E402
from quotelens.session import shared_folder  # noqa: E402


def quality_stage(spark, docs, sf_dir):
    """Documents that the attention model scores at the threshold or above stay."""
    labels = queries.table(spark, sf_dir, "labels")
    model = quality.train(docs, labels)
    scored = docs.withColumn("__score", quality.score(model, F.col("text")))
    return scored.filter(F.col("__score") >= queries.QUALITY_THRESHOLD).drop("__score")


def line_stage(spark, docs, sf_dir):
    """Lines that ten or more documents share go; ``n_chars`` follows the text."""
    kept = line_runs.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def near_duplicate_stage(spark, docs, sf_dir):
    """One document of each SimHash group stays."""
    return simhash.drop_near_duplicates(docs)


def decontamination_stage(spark, docs, sf_dir):
    """Documents that hold a benchmark item, whole or edited, go."""
    return decontaminate.drop_contaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def packing_stage(spark, docs, sf_dir):
    """What is left as pieces of full windows."""
    return queries.packed_pieces(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL cannot train the classifier or tokenise; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents; intermediate tables go to the shared folder."""
    docs = queries.table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
