"""URL verdicts: listed rules first, gradient-boosted trees on lexical features for the rest.

The trees learn from labelled URLs (1: unwanted). Features are lengths, path depth, digit ratio,
entropy, parameter counts and suffix statistics, that is how many labelled URLs a domain and a
top-level name have and what share of them is unwanted. A labelled URL sees statistics of the
other folds only. The trees are grown level by level from histograms of gradients, which Spark
aggregates; a fitted tree is a CASE expression, so scoring is plain SQL.

Only built-in functions run (the sums of vectors are those of Spark's ``Summarizer``). Training takes about ``train_rows`` different labelled URLs, chosen
by hash; statistics and verdicts cover all rows.

Edge cases: a null URL or one without ``://`` has an empty host and path, which no rule fits, and
is judged by its features. Very long URLs are read whole. Repeated rows get one verdict each, and
a URL trains once. Without labelled URLs every verdict is allow. An empty table gives an empty
result. Other columns of the input are not read.
"""

import math

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from ..operators.joins import join_small
from ..session import settle
from .graph import join_unique
from .text import lower_ascii, whole

FOLDS = 5
FEATURES = [
    "url_length",
    "host_length",
    "path_depth",
    "digit_ratio",
    "hyphens",
    "entropy",
    "parameters",
    "query_length",
    "host_labels",
    "domain_rate",
    "domain_log_count",
    "tld_rate",
    "tld_log_count",
]


def host_and_path(url):
    """Host (A-Z in lower case) and path of a URL; both empty without ``://``."""
    address = F.regexp_extract(url, r"(?s)^.*?://([^?#]*)", 1)
    host = lower_ascii(F.regexp_extract(address, r"(?s)^[^/]*", 0))
    return host, F.regexp_extract(address, r"(?s)^[^/]*(.*)$", 1)


def apply_rules(rows, rules):
    """Adds ``rule`` and ``listed``; rules are (``allow`` | ``block``, ``host/path``) pairs.

    The list is part of the plan and so limited to a thousand rules.
    """
    if len(rules) > 1_000:
        raise ValueError("more than 1000 rules")
    rule = listed = F.lit(None).cast("string")
    for verdict, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, path = text.partition("/")
        here = (F.col("host") == name) | F.endswith("host", F.lit("." + name))
        fits = here & F.startswith("path", F.lit(slash + path))
        rule, listed = F.when(fits, text).otherwise(rule), F.when(fits, verdict).otherwise(listed)
    return rows.withColumns({"rule": rule, "listed": listed})


def _count(text, mark):
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def lexical(rows):
    """``rows`` (columns ``url``, ``host``, ``path``) with the features of the text alone."""
    url, n = F.col("url"), F.greatest(F.length("url"), F.lit(1))
    query = F.regexp_extract("url", r"(?s)\?([^#]*)", 1)
    shares = F.transform(
        F.array_distinct(F.split("url", "")),
        lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / n,
    )
    entropy = F.aggregate(
        F.filter(shares, lambda p: p > 0), F.lit(0.0), lambda total, p: total - p * F.log2(p)
    )
    labels = F.split("host", r"\.", -1)
    return rows.withColumns(
        {
            "url_length": F.length("url").cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_depth": _count(F.col("path"), "/").cast("double"),
            "digit_ratio": F.length(F.regexp_replace("url", "[^0-9]", "")) / n,
            "hyphens": _count(url, "-").cast("double"),
            "entropy": entropy,
            "parameters": F.size(F.filter(F.split(query, "&", -1), lambda p: p != "")).cast("double"),
            "query_length": F.length(query).cast("double"),
            "host_labels": F.size(labels).cast("double"),
            "domain": F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2), "."),
            "tld": F.element_at(labels, -1),
        }
    )


def _suffix_statistics(rows):
    """Per domain: rows, and labelled and unwanted URLs by fold, of it and its top-level name."""
    sums = [F.count(F.lit(1)).alias("rows")]
    for i in range(FOLDS):
        here = (F.col("fold") == i) & F.col("label").isNotNull()
        sums.append(F.count_if(here).alias(f"domain_n{i}"))
        sums.append(F.count_if(here & (F.col("label") == 1)).alias(f"domain_b{i}"))
    domains = settle(rows.groupBy("domain", "tld").agg(*sums))
    tops = domains.groupBy("tld").agg(
        *[F.sum(f"domain_{k}{i}").alias(f"tld_{k}{i}") for i in range(FOLDS) for k in "nb"]
    )
    return join_small(domains, tops, "tld").drop("tld")


def _rates(rows, prior, weight=10):
    """Shrunk unwanted rate and count of a suffix, without the row's own fold if it is labelled."""
    columns = {}
    for suffix in ("domain", "tld"):
        n, b = (
            sum(
                F.when(F.col("label").isNull() | (F.col("fold") != i), F.col(f"{suffix}_{k}{i}"))
                .otherwise(0)
                for i in range(FOLDS)
            )
            for k in "nb"
        )
        columns[f"{suffix}_rate"] = (b + F.lit(weight * prior)) / (n + weight)
        columns[f"{suffix}_log_count"] = F.log1p(n.cast("double"))
    return rows.withColumns(columns)


class Trees:
    """Boosted trees over numeric columns: nested (feature, cut, low, high) or leaf values."""

    def __init__(self, bias=0.0, trees=()):
        self.bias, self.trees = bias, list(trees)

    def margin(self):
        return sum((_expression(t) for t in self.trees), F.lit(self.bias))


def _expression(tree):
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    feature, cut, low, high = tree
    return F.when(F.col(feature) <= F.lit(cut), _expression(low)).otherwise(_expression(high))


def _assemble(splits, leaf, node=1):
    """The tree below ``node``; node n has the children 2n and 2n + 1."""
    if node not in splits:
        return leaf(node)
    feature, cut = splits[node]
    return feature, cut, _assemble(splits, leaf, 2 * node), _assemble(splits, leaf, 2 * node + 1)


def _best_split(histogram, total, penalty, least):
    """Feature, bin and left sums of a node's best cut, or None.

    ``histogram`` maps features to {bin: (g, h)}, sums of first and second derivatives.
    """
    g, h = total
    best, most = None, 1e-6
    for feature, parts in sorted(histogram.items()):
        left_g = left_h = 0.0
        for at in sorted(parts)[:-1]:
            left_g, left_h = left_g + parts[at][0], left_h + parts[at][1]
            if min(left_h, h - left_h) < least:
                continue
            gain = left_g**2 / (left_h + penalty) + (g - left_g) ** 2 / (h - left_h + penalty)
            gain -= g**2 / (h + penalty)
            if gain > most + 1e-9:
                best, most = (feature, at, left_g, left_h), gain
    return best


def _routed(splits, depth):
    """Number of the node a row of ``bins`` falls in; ``splits`` is data, not part of the plan."""
    feature, at, low = [0] * 2 ** (depth + 1), [1 << 30] * 2 ** (depth + 1), list(range(2 ** (depth + 1)))
    for node, (f, b) in splits.items():
        feature[node], at[node], low[node] = f, b, 2 * node
    features, ats, lows = F.lit(feature), F.lit(at), F.lit(low)

    def step(node, _):
        higher = F.get("bins", F.get(features, node)) > F.get(ats, node)
        return F.get(lows, node) + higher.cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(1), step)


def _histograms(data, splits, wanted, depth, width):
    """{node: {feature: {bin: (g, h)}}} of the wanted nodes of a growing tree.

    A row's cells, one a feature, are marked in the vector ``cells``; a node's sum of weighted
    vectors is its whole histogram, so no row is multiplied by the features.
    """
    rows = data.withColumn("node", _routed(splits, depth)).filter(F.col("node").isin(wanted))
    # Summed weights have to be positive, so g is taken as (g + n) - n.
    p = F.col("p")
    weights = {"raised": F.col("positive") + F.col("n") * (1 - p), "n": F.col("n").cast("double"),
               "h": F.col("n") * F.greatest(p * (1 - p), F.lit(1e-12))}
    sums = [
        vector_to_array(Summarizer.sum(F.col("cells"), weight)).alias(name)
        for name, weight in weights.items()
    ]
    nodes = {}
    for row in rows.groupBy("node").agg(*sums).collect():
        parts = nodes.setdefault(row["node"], {})
        for cell, (raised, n, h) in enumerate(zip(row["raised"], row["n"], row["h"])):
            if n > 0:
                parts.setdefault(cell // width, {})[cell % width] = raised - n, h
    return nodes


def _grow(data, depth, width, rate, penalty, least):
    """Splits and leaf values of one tree, or None if no cut helps.

    Sums of children come from the cut above them.
    """
    splits, sums, wanted = {}, {}, [1]
    for _ in range(depth):
        following = []
        for i, histogram in _histograms(data, splits, wanted, depth, width).items():
            if i == 1:
                parts = histogram[0].values()
                sums[1] = sum(g for g, _ in parts), sum(h for _, h in parts)
            best = _best_split(histogram, sums[i], penalty, least)
            if best:
                feature, at, left_g, left_h = best
                splits[i] = feature, at
                sums[2 * i] = left_g, left_h
                sums[2 * i + 1] = sums[i][0] - left_g, sums[i][1] - left_h
                following += [2 * i, 2 * i + 1]
        if not following:
            break
        wanted = following
    if splits:
        return splits, {i: rate * g / (h + penalty) for i, (g, h) in sums.items()}


def fit_trees(rows, features=FEATURES, label="label", rounds=10, depth=3, bins=32, rate=0.3,
              penalty=1.0, least=1.0):
    """Logistic boosting with second-order leaf values.

    Rows with equal bins are counted once, as no tree tells them apart. Every level is one
    aggregation of their weighted cells by node, whose result has at most nodes x features x bins
    numbers; no training row reaches the driver, and none is multiplied.
    """
    edges = [F.percentile_approx(f, [i / bins for i in range(1, bins)], 10_000) for f in features]
    n, positive, *edges = rows.agg(F.count(F.lit(1)), F.sum(label), *edges).first()
    if n == 0:
        return Trees(-1.0)
    model = Trees(math.log((positive + 0.5) / (n - positive + 0.5)))
    cuts = [sorted(set(e)) for e in edges]
    binned = [
        sum(((F.col(f) > F.lit(c)).cast("int") for c in cuts[j]), F.lit(0))
        for j, f in enumerate(features)
    ]
    marks = F.transform(
        F.col("bins"), lambda b: F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.when(i == b, 1.0).otherwise(0.0))
    )
    counted = (
        rows.select(label, F.array(*binned).alias("bins"))
        .groupBy("bins")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("positive"))
    )
    def placed(data, margin):
        probability = (1 / (1 + F.exp(-F.col("m")))).alias("p")
        return settle(data.withColumn("m", margin).select("bins", "n", "positive", "cells", "m", probability))

    data = placed(counted.withColumn("cells", array_to_vector(F.flatten(marks))), F.lit(model.bias))
    for left in range(rounds - 1, -1, -1):
        grown = _grow(data, depth, bins, rate, penalty, least)
        if grown is None:
            break
        splits, values = grown
        model.trees.append(
            _assemble({i: (features[f], float(cuts[f][b])) for i, (f, b) in splits.items()}, values.get)
        )
        if left:
            leaves = F.lit([float(values.get(i, 0.0)) for i in range(2 ** (depth + 1))])
            data = placed(data, F.col("m") + F.get(leaves, _routed(splits, depth)))
    return model


def judge(df, rules, page_id="page_id", url="url", label="label", train_rows=20_000, threshold=0.5):
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` of every URL.

    ``label`` is 1 for an unwanted URL, 0 for a wanted one and null where nothing is known.
    """
    rows = df.select(
        F.col(page_id).alias("page_id"),
        whole(F.col(url)).alias("url"),
        F.col(label).cast("int").alias("label"),
    )
    host, path = host_and_path(F.col("url"))
    placed = apply_rules(rows.withColumns({"host": host, "path": path}), rules)
    placed = settle(lexical(placed).withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(FOLDS))))
    total, labelled, unwanted = placed.agg(
        F.count(F.lit(1)), F.count("label"), F.count_if(F.col("label") == 1)
    ).first()
    prior = (unwanted + 1) / (labelled + 2)
    domains = settle(_suffix_statistics(placed))
    known = _rates(join_unique(placed, domains, "domain", "rows", total), prior)
    share = min(1.0, train_rows / max(1, labelled))
    chosen = F.pmod(F.xxhash64("url", F.lit("train")), F.lit(1_000_000)) < round(share * 1_000_000)
    sample = known.filter(F.col("label").isNotNull() & chosen).select("url", "label", *FEATURES)
    model = fit_trees(sample.dropDuplicates(["url"]))
    score = 1 / (1 + F.exp(-model.margin()))
    judged = F.coalesce("listed", F.when(score >= threshold, "block").otherwise("allow"))
    return known.select(
        "page_id", "host", "path", "rule", judged.alias("verdict"), score.alias("score")
    )
