"""Readers. Every schema is declared; nothing is inferred from data."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F, types as T

from ..schemas import BENCH_SUMMARY, PROMPT_PAYLOAD, RAW_NLI, TRAINING_LOG
from . import block_log

SPLITS = ("train", "validation", "test")


def spread(df, *keys):
    """Put a scan that has far fewer splits than there are cores on all of them.

    For CPU-bound work on a few large row groups; a table with enough splits, a stream or
    anything but a plain scan should not be and is not moved.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    if 2 * df.rdd.getNumPartitions() > cores:
        return df
    return df.repartition(cores, *keys)


def read_raw(spark, path, fmt="parquet", schema=RAW_NLI, with_order=False, multi_line=True):
    """Raw dataset file; in CSV, list columns are JSON text.

    A CSV file whose texts may hold line ends has to be read by one task. ``multi_line=False`` is
    for files without any: they are split like other text files.

    ``with_order`` adds ``file`` and ``row``: the input order, which Parquet files keep.
    """
    if fmt == "parquet":
        df = spark.read.schema(schema).parquet(path)
        if with_order:
            df = df.select(
                "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
            )
        return df
    if fmt != "csv":
        raise ValueError(f"unknown format: {fmt}")
    if with_order:
        raise ValueError("CSV files carry no row numbers; put an order column in the data")
    lists = {f.name: f.dataType for f in schema if isinstance(f.dataType, T.ArrayType)}
    flat = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in lists else f.dataType) for f in schema]
    )
    options = {"header": "true", "multiLine": str(multi_line).lower(), "escape": '"'}
    df = spark.read.schema(flat).options(**options).csv(path)
    return df.withColumns({name: F.from_json(name, kind) for name, kind in lists.items()})


def read_checked(spark, path, required=("text", "inference")):
    """Parquet with the required columns, or an error that names the missing one."""
    df = spark.read.parquet(path)
    for column in required:
        if column not in df.columns:
            raise ValueError(f"missing required column: {column}")
    return df


def read_jsonl(spark, path, schema):
    return spark.read.schema(schema).json(path)


MANIFEST = "key string, version string, published timestamp, attempt string"


def versions(spark, root):
    """Published versions: ``key``, ``version``, ``published``, ``attempt`` and ``path`` below the root.

    Of several attempts at a version the one published first counts. Reads the manifest only.
    """
    try:
        manifest = spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        manifest = spark.createDataFrame([], MANIFEST)
    first = manifest.groupBy("key", "version").agg(F.min(F.struct("published", "attempt")).alias("_first"))
    folder = F.concat(F.lit("key="), F.col("key"), F.lit("/version="), F.col("version"))
    # Versions from before there were attempts have none.
    path = F.concat(folder, F.coalesce(F.concat(F.lit("/attempt="), F.col("attempt")), F.lit("")))
    return first.select("key", "version", "_first.*").withColumn("path", path)


def list_versions(spark, root):
    """Keys and versions published; reads the manifest only."""
    return versions(spark, root).select("key", "version")


def published_attempt(spark, root, key, tag):
    """The attempt that is the version, or None if it is not published."""
    row = versions(spark, root).filter((F.col("key") == key) & (F.col("version") == tag)).first()
    return None if row is None else row["attempt"] or ""


def read_version(spark, root, key, tag="latest"):
    """One published version of a dataset, in its own schema; no other version is touched.

    ``latest`` is the one published last, whatever its tag.
    """
    mine = versions(spark, root).filter(F.col("key") == key)
    if tag == "latest":
        row = mine.orderBy(F.col("published").desc(), F.col("version").desc()).first()
    else:
        row = mine.filter(F.col("version") == tag).first()
    if row is None:
        raise ValueError(f"no such published version of {key}")
    tag, path = row["version"], f"{root}/{row['path']}"
    found = spark.read.parquet(path).schema
    # The split is text: a name of digits must not turn into a number.
    text = T.StructType(
        [T.StructField(f.name, T.StringType()) if f.name == "split" else f for f in found]
    )
    version = spark.read.schema(text).parquet(path)
    return version.withColumns({"key": F.lit(key), "version": F.lit(tag)})


def read_splits(spark, root, key, tag="latest"):
    """Train, validation and test of one version, each pruned to its directory."""
    version = read_version(spark, root, key, tag)
    return {s: version.filter(F.col("split") == s).drop("split") for s in SPLITS}


def read_request_log(spark, path):
    """Request log blocks: client (file number), ts_ms, input and output text."""
    blocks = spark.read.option("lineSep", "\n\n").text(path)
    return _request_fields(blocks, F.col("_metadata.file_name"))


def _request_fields(blocks, file):
    # With a line end before the first line too, a name is found as a fixed text.
    lines = F.concat(F.lit("\n"), "value")

    def field(name, pattern):
        return F.regexp_extract(lines, rf"\n{name}: ?({pattern})", 1)

    return blocks.filter(F.col("value").contains("timestamp: ")).select(
        F.regexp_extract(file, r"(\d+)$", 1).alias("client"),
        field("timestamp", r"\d+").cast("long").alias("ts_ms"),
        field("input", r"[^\n]*").alias("input"),
        field("output", r"[^\n]*").alias("output"),
    )


def read_request_blocks(spark, path, range_bytes=64 << 20):
    """As ``read_request_log``, in byte ranges that end at block borders (``block_log``)."""
    block_log.register(spark)
    blocks = spark.read.format("block_log").options(path=path, range_bytes=range_bytes).load()
    return _request_fields(blocks, F.col("file"))


def stream_request_blocks(spark, path, range_bytes=64 << 20, final=False):
    """The same rows as a stream that follows files while they grow."""
    block_log.register(spark)
    options = {"path": path, "range_bytes": range_bytes, "final": final}
    return _request_fields(spark.readStream.format("block_log").options(**options).load(), F.col("file"))


def read_bench_summary(spark, path):
    """Load-test summaries, one file each; anything before the first brace is noise."""
    whole = spark.read.text(path, wholetext=True)
    body = F.regexp_extract("value", r"(?s)(\{.*)", 1)
    return whole.select(
        F.col("_metadata.file_name").alias("file"), F.from_json(body, BENCH_SUMMARY).alias("s")
    ).select("file", "s.*")


def read_training_log(spark, path):
    """Training history files (a JSON array each); ``run`` is the file name."""
    entries = spark.read.schema(TRAINING_LOG).json(path, multiLine=True)
    return entries.select(F.col("_metadata.file_name").alias("run"), *TRAINING_LOG.names)


def read_prompts(spark, path):
    """Prompt payloads: one JSON object per line or file."""
    return spark.read.schema(PROMPT_PAYLOAD).json(path)
