"""Session settings, and where shared intermediate tables go."""

import tempfile
import uuid

from pyspark.sql import SparkSession

from .streaming.live import STATE_STORE


def local_session(cpus="*", memory="16g", partitions=8, app="quotelens"):
    """A single-machine session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Scoring costs far more time per byte than Spark expects of a partition.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config(*STATE_STORE)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark):
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a session without that setting on a local master gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="quotelens-"))
    return context.getCheckpointDir()


def settle(df, **options):
    """Write ``df`` to the shared folder and read it back.

    For a result used several times: it is computed once, outlives lost executors and tells
    later joins its size. The caller may delete the files once done.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)
