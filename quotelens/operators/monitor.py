"""Quote grounding, label counts, drift and alarms, for tables and streams alike."""

from pyspark.sql import Window, functions as F

from ..functions import text as tx
from ..schemas import ALARM_THRESHOLD, NOT_MENTIONED
from .overlap import ngram_overlap

# Metric names.
GROUNDING = "CARP_3"
LABEL_PREFIX = "Hlabel_"


def _scored(label):
    """Answers that claim evidence; an absent label counts as a claim."""
    return F.coalesce(label != NOT_MENTIONED, F.lit(True))


def carp_in_row(df, contract="contract", answers="answers", name="carp"):
    """Mean ROUGE-3 precision of the quotes of each row against the row's own contract.

    1.0 for a row without quotes. Contract and answers share the row, so nothing shuffles.
    """
    quotes = F.transform(
        F.filter(answers, lambda a: _scored(a["label"])), lambda a: a["source_clause"]
    )
    mean = tx.bind(
        tx.quote_precisions(F.col(contract), quotes),
        lambda p: F.when(F.size(p) == 0, F.lit(1.0)).otherwise(
            F.aggregate(p, F.lit(0.0), lambda total, x: total + x) / F.size(p)
        ),
    )
    return df.withColumn(name, mean)


def carp(answers, contracts, key="request_id", quote_id="position"):
    """The same for flat answers (key, quote id, label, source_clause) and a text table."""
    quotes = answers.filter(_scored(F.col("label"))).select(
        key, quote_id, F.col("source_clause").alias("text")
    )
    means = (
        ngram_overlap(quotes, contracts, key, 3, quote_id)
        .groupBy(key)
        .agg(F.avg("rouge.precision").alias("carp"))
    )
    return (
        answers.select(key)
        .distinct()
        .join(means, key, "left")
        .withColumn("carp", F.coalesce("carp", F.lit(1.0)))
    )


def to_metric_points(df, keep=(), whole_seconds=True):
    """Scored responses (answers, carp, endpoint, adapter, ts) to metric points.

    One count per answer with dimension label and one with endpoint, adapter and label; the
    grounding mean without dimensions and with endpoint and adapter. Stateless.

    Times are cut to seconds, which takes a watermark off; ``whole_seconds=False`` leaves them and it.
    """
    owner = [F.lit("model_endpoint"), F.col("endpoint"), F.lit("model_adapter"), F.col("adapter")]
    no_dims = F.create_map().cast("map<string,string>")

    def point(metric, dims, value):
        return F.struct(metric.alias("metric"), dims.alias("dims"), value.alias("value"))

    def label_points(owned):
        return F.transform(
            "answers",
            lambda a: point(
                F.concat(F.lit(LABEL_PREFIX), a["hypothesis_id"]),
                F.create_map(*(owner if owned else []), F.lit("label"), a["label"]),
                F.lit(1.0),
            ),
        )

    grounding = F.array(
        point(F.lit(GROUNDING), no_dims, F.col("carp")),
        point(F.lit(GROUNDING), F.create_map(*owner), F.col("carp")),
    )
    points = F.concat(label_points(False), label_points(True), grounding)
    return df.select(
        *keep,
        F.date_trunc("second", "ts").alias("ts") if whole_seconds else "ts",
        F.explode(points).alias("_point"),
    ).select(*keep, "_point.metric", "_point.dims", "ts", "_point.value")


def grounding_points(points, owned):
    """Grounding points without dimensions, or per endpoint and adapter."""
    mine = points.filter((F.col("metric") == GROUNDING) & (F.size("dims") == (2 if owned else 0)))
    if not owned:
        return mine.select("ts", "value")
    return mine.select(
        "ts",
        "value",
        F.col("dims")["model_endpoint"].alias("endpoint"),
        F.col("dims")["model_adapter"].alias("adapter"),
    )


def period_means(points, period="5 minutes", keys=(), threshold=ALARM_THRESHOLD):
    """Mean per tumbling period, and whether it breaches (at or below the threshold)."""
    means = points.groupBy(F.window("ts", period).alias("_w"), *keys).agg(
        F.avg("value").alias("mean"), F.count(F.lit(1)).alias("points")
    )
    return means.select(
        *keys,
        F.col("_w.start").alias("period"),
        "mean",
        "points",
        (F.col("mean") <= threshold).alias("breach"),
    )


def label_counts(answers, dims=()):
    """Number of answers per hypothesis and label, optionally per endpoint and so on."""
    return answers.groupBy(*dims, "hypothesis_id", "label").agg(
        F.count(F.lit(1)).alias("count")
    )


def label_drift(current, base, limit=0.2):
    """Share of each label per hypothesis against a baseline; both sides are label counts.

    ``drifted``: the share moved by more than ``limit``. ``one_sided``: only one label.
    """

    def shares(counts, name):
        total = F.sum("count").over(Window.partitionBy("hypothesis_id"))
        return counts.select("hypothesis_id", "label", (F.col("count") / total).alias(name))

    both = shares(current, "share").join(
        shares(base, "base_share"), ["hypothesis_id", "label"], "full"
    )
    both = both.fillna(0.0, ["share", "base_share"])
    change = F.abs(F.col("share") - F.col("base_share"))
    return both.withColumns(
        {"change": change, "drifted": change > limit, "one_sided": F.col("share") == 1.0}
    )


def alarm_state(means, period="5 minutes", n=1, m=1, missing="notBreaching", keys=()):
    """Alarm state of every period from period means: m breaches in the last n periods.

    Periods without data are filled in first. ``notBreaching`` counts them as fine;
    ``missing`` and ``ignore`` keep the previous state. Windows run over periods, whose
    number is bounded by the time span, never over raw points.
    """
    if missing not in ("notBreaching", "missing", "ignore"):
        raise ValueError(f"unknown policy for missing data: {missing}")
    step = F.expr(f"interval {period}")
    constant = F.lit(1).alias("_one")
    spans = means.groupBy(*keys, constant).agg(
        F.min("period").alias("_from"), F.max("period").alias("_to")
    )
    spine = spans.select(*keys, F.explode(F.sequence("_from", "_to", step)).alias("period"))
    filled = spine.join(means.select(*keys, "period", "mean", "breach"), [*keys, "period"], "left")
    in_order = Window.partitionBy(*keys).orderBy("period")
    breaches = F.sum(F.coalesce(F.col("breach").cast("int"), F.lit(0))).over(
        in_order.rowsBetween(1 - n, 0)
    )
    state = F.when(breaches >= m, "ALARM").otherwise("OK")
    if missing != "notBreaching":
        filled = filled.withColumn("_seen", F.when(F.col("mean").isNotNull(), state))
        state = F.last("_seen", ignorenulls=True).over(
            in_order.rowsBetween(Window.unboundedPreceding, 0)
        )
    return filled.select(*keys, "period", "mean", state.alias("state"))


def alarm_edges(states, keys=()):
    """Periods where the state changes; an alarm is taken to start as OK."""
    before = F.lag("state", 1, "OK").over(Window.partitionBy(*keys).orderBy("period"))
    return (
        states.withColumn("previous", before)
        .filter(F.col("previous") != F.col("state"))
        .select(*keys, "period", "previous", "state")
    )
