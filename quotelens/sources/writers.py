"""Writers. None of them gathers rows: every task writes its own file."""

import time
import uuid

from pyspark.sql import functions as F

from .readers import published_attempt, versions


def version_tag(ts=None):
    """Version stamp like 20240131_0930 as a column."""
    return F.date_format(F.current_timestamp() if ts is None else ts, "yyyyMMdd_HHmm")


class AlreadyPublished(ValueError):
    """Another attempt has published this version."""


def new_attempt(root, key, tag):
    """Folder for one attempt to write a version, and the attempt's name."""
    attempt = uuid.uuid4().hex
    return f"{root}/key={key}/version={tag}/attempt={attempt}", attempt


def write_version(df, root, key, tag, split=None):
    """New version of a dataset under root/key=/version=/attempt=/split=; a published one fails.

    Without ``split`` the frame must have that column. The version is published last, so readers
    never see part of it. An attempt that breaks off leaves files that nobody reads (see
    :func:`vacuum`) and can be repeated under the same tag.
    """
    spark = df.sparkSession
    refuse_published(spark, root, key, tag)
    rows = df if split is None else df.withColumn("split", F.lit(split))
    path, attempt = new_attempt(root, key, tag)
    rows.write.mode("errorifexists").partitionBy("split").parquet(path)
    publish(spark, root, key, tag, attempt)
    return path


def refuse_published(spark, root, key, tag):
    if published_attempt(spark, root, key, tag) is not None:
        raise AlreadyPublished(f"version {tag} of {key} already exists")


def publish(spark, root, key, tag, attempt):
    """Add a complete attempt to the manifest, one small row a version.

    Of several attempts at one version the one published first is the version: readers take no
    other, and the others get an error. Attempts published at the same microsecond are ordered by
    name. Clocks of writers of one version have to agree within the time that publishing takes.
    """
    refuse_published(spark, root, key, tag)
    row = spark.range(1).select(
        F.lit(key).alias("key"),
        F.lit(tag).alias("version"),
        F.current_timestamp().alias("published"),
        F.lit(attempt).alias("attempt"),
    )
    row.write.mode("append").parquet(f"{root}/manifest")
    if published_attempt(spark, root, key, tag) != attempt:
        raise AlreadyPublished(f"{key} {tag} was published by another attempt")


def vacuum(spark, root, older_than_hours=24):
    """Delete files of attempts that are not published and older than that; returns their paths.

    An attempt's age is that of its newest entry, so one that is still being written is left alone
    if it writes more often than that.
    """
    kept = {r["path"] for r in versions(spark, root).select("path").collect()}  # a row a version
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    before = (time.time() - older_than_hours * 3600) * 1000
    gone = []
    for found in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/key=*/version=*/attempt=*")) or []:
        path = found.getPath()
        name = "/".join(path.toString().rsplit("/", 3)[1:])
        entries = [found, *fs.listStatus(path)]
        if name not in kept and max(e.getModificationTime() for e in entries) < before:
            fs.delete(path, True)
            gone.append(name)
    return sorted(gone)


def write_jsonl(df, path):
    df.write.mode("errorifexists").json(path)


def write_tokens(df, path):
    """Training arrays as Parquet, which Arrow readers load directly."""
    columns = ("input_ids", "attention_mask", "labels")
    df.select(*columns).write.mode("errorifexists").parquet(path)


def write_metrics(df, path):
    """The single metrics row as JSON; unset values are written as null."""
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def write_prompts(df, path):
    """Prompt payloads from ``inputs`` and ``parameters``, one JSON object per line."""
    payload = F.to_json(F.struct("inputs", "parameters"))
    df.select(payload.alias("value")).write.mode("errorifexists").text(path)
