"""Streaming twins of the monitoring jobs.

The stateless steps (:func:`quotelens.operators.monitor.carp_in_row`,
:func:`~quotelens.operators.monitor.to_metric_points`) take a stream as they are. Rows later
than the watermark are dropped; a period is emitted once the watermark has passed it.
"""

from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators.drift import drift_test, label_table
from ..operators.monitor import grounding_points, period_means
from ..schemas import ALARM_THRESHOLD

WATERMARK = "10 minutes"
STATE_STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)
LOG_COLUMNS = ("ts", "endpoint", "adapter", "template_uri", "input", "output")


def short_alarm(points, period="5 minutes", threshold=ALARM_THRESHOLD, watermark=WATERMARK):
    """Grounding mean per period over all traffic; ``watermark`` is None where there is one already."""
    mine = grounding_points(points, owned=False)
    if watermark is not None:
        mine = mine.withWatermark("ts", watermark)
    return period_means(mine, period, (), threshold)


def drift_alarm(points, period="1 day", threshold=ALARM_THRESHOLD, watermark=WATERMARK):
    """Grounding mean per day, endpoint and adapter."""
    mine = grounding_points(points, owned=True).withWatermark("ts", watermark)
    return period_means(mine, period, ("endpoint", "adapter"), threshold)


def label_counts_stream(answers, period="5 minutes", dims=(), watermark=WATERMARK):
    """Answers per period, hypothesis and label."""
    timed = answers.withWatermark("ts", watermark)
    counts = timed.groupBy(
        F.window("ts", period).alias("_w"), *dims, "hypothesis_id", "label"
    ).agg(F.count(F.lit(1)).alias("count"))
    return counts.select(
        F.col("_w.start").alias("period"), *dims, "hypothesis_id", "label", "count"
    )


def alarm_stream(means, seconds=300, n=1, m=1, missing="notBreaching", key="metric"):
    """Live alarm states per key from closed periods (key, period, mean, breach).

    State per key: the last n breach flags, the last state and the last period. A gap is
    filled when the next period arrives, as :func:`~quotelens.operators.monitor.alarm_state`
    fills it. At most one row per key and period reaches this operator, which may follow
    :func:`short_alarm` directly; a period that is not after the last one is late and skipped.
    The session must have the RocksDB state store (``STATE_STORE``), which is left to the caller
    because other streams of the session may have state in another one.
    """
    if missing not in ("notBreaching", "missing", "ignore"):
        raise ValueError(f"unknown policy for missing data: {missing}")
    if means.sparkSession.conf.get(STATE_STORE[0], "") != STATE_STORE[1]:
        raise ValueError(f"set {STATE_STORE[0]} to {STATE_STORE[1]}")
    return (
        means.select(key, "period", "mean", "breach")
        .groupBy(key)
        .transformWithStateInPandas(
            AlarmProcessor(key, seconds, n, m, missing != "notBreaching"),
            f"{key} string, period timestamp, mean double, state string",
            "Append",
            "None",
        )
    )


class AlarmProcessor(StatefulProcessor):
    """Advances one key's alarm by the periods that have closed."""

    def __init__(self, key, seconds, n, m, keep):
        self.key, self.seconds, self.n, self.m, self.keep = key, seconds, n, m, keep

    def init(self, handle):
        self.memory = handle.getValueState(
            "alarm", "flags array<boolean>, last_state string, last_period bigint"
        )

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd

        flags, last_state, last_period = self.memory.get() or ([], "OK", None)
        flags = list(flags)
        closed = pd.concat(list(rows)).sort_values("period")
        out = []

        def push(at, mean, breach):
            nonlocal last_state, flags
            flags = [*flags, bool(breach)][-self.n :]
            if mean is not None or not self.keep:
                last_state = "ALARM" if sum(flags) >= self.m else "OK"
            out.append((key[0], at, mean, last_state))

        for at, mean, breach in zip(closed["period"], closed["mean"], closed["breach"]):
            at_s = int(at.timestamp())
            if last_period is not None and at_s <= last_period:
                continue
            if last_period is not None:
                for gap in range(last_period + self.seconds, at_s, self.seconds):
                    push(pd.Timestamp(gap, unit="s"), None, False)
            push(at, mean, breach)
            last_period = at_s
        self.memory.update((flags, last_state, last_period))
        frame = pd.DataFrame(out, columns=[self.key, "period", "mean", "state"])
        yield frame.astype({"mean": "float64"})

    def close(self):
        pass


def sink_inference_log(stream, path, checkpoint, available_now=False):
    """Append requests and responses with endpoint, adapter and template address to Parquet."""
    columns = [c for c in LOG_COLUMNS if c in stream.columns]
    missing = set(LOG_COLUMNS) - set(columns)
    if missing:
        raise ValueError(f"missing log columns: {sorted(missing)}")
    writer = (
        stream.select(*columns)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def run_to_table(stream, path, checkpoint, mode="append"):
    """Run a stream over everything available and return its result as a table.

    Each batch is written under its own number, so a repeated batch replaces itself.
    In ``complete`` mode the last batch on storage holds the whole result.
    """

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    reader = stream.sparkSession.read.schema(stream.schema)
    if mode == "complete":
        batches = reader.parquet(path)
        last = batches.agg(F.max("batch")).first()[0]
        return batches.filter(F.col("batch") == last).drop("batch")
    return reader.option("recursiveFileLookup", "true").parquet(path)


def label_drift_stream(answers, baseline, period="1 day", alpha=0.001, dims=(), watermark=WATERMARK):
    """Drift test of every closed period against a stored baseline, one row a hypothesis.

    ``baseline`` is a table of label counts that is read again in every micro-batch, so a newer one
    under the same path is used from the next batch on.
    """
    window = F.window("ts", period).alias("_w")
    counts = label_table(answers.withWatermark("ts", watermark), (window, *dims))
    tested = drift_test(counts, baseline, alpha)
    return tested.select(F.col("_w.start").alias("period"), *[c for c in tested.columns if c != "_w"])
