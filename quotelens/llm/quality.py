"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of a fixed number of words. Each passage is encoded from its
hashed words and from shares of characters and repeats; a gated attention weight says how much it
counts, and the weighted mean of the encodings gives the score. Only documents are labelled, so
the weights are learned from document labels alone.

Training takes a bounded sample of labelled rows, each with every passage of its text: at most
``sample_docs`` of them, and together at most ``sample_passages`` passages (568 bytes each, on the
driver). A text that does not fit into what is left of the passages is passed over as a row, never
cut. Scoring reads every passage of every text.

Edge cases: a null or empty text is one empty passage. Very long texts have many passages and one
score. Repeated labels of a document are averaged, null labels are not used; without labels every
score is 0.5, and with one class only it is near that class. Repeated rows score alike. An empty
table gives an empty result. Other columns of the input are not read.
"""

import operator
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from .text import remainder

HASHED = 128
_CLASSES = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b".,;:?",
    b"!",
    b"#*$%&<>",
    b"|",
    b"\"'()-/=@[\\]^_`{}~+",
    bytes(range(128, 256)),
)
WIDTH = HASHED + len(_CLASSES) + 6


def encode_passages(text, size):
    """One row of inputs for each passage of ``size`` words."""
    words = text.encode().split()
    if not words:
        empty = np.zeros((1, WIDTH), np.float32)
        empty[0, -1] = 1
        return empty
    hashes = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % HASHED
    count = -(-len(words) // size)
    slot = np.arange(len(words)) // size
    bag = np.bincount(slot * HASHED + hashes, minlength=count * HASHED).reshape(count, HASHED)
    bag = np.sqrt(bag)
    bag /= np.sqrt((bag * bag).sum(1, keepdims=True))
    rest = np.empty((count, WIDTH - HASHED))
    for i in range(count):
        own = words[i * size : (i + 1) * size]
        joined = b" ".join(own)
        n, letters = len(own), len(joined)
        shares = [(letters - len(joined.translate(None, c))) / letters for c in _CLASSES]
        rest[i] = *shares, len(set(own)) / n, sum(map(operator.eq, own, own[1:])) / n, min(
            letters / n / 10, 5
        ), min(len(max(own, key=len)) / 30, 5), n / size, 0
    return np.hstack([bag, rest]).astype(np.float32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(model, x, starts):
    """All layers; ``starts`` holds the first passage of each bag."""
    h = np.tanh(x @ model["encode"] + model["encode_bias"])
    a, g = np.tanh(h @ model["tanh"]), _sigmoid(h @ model["gate"])
    s = (a * g) @ model["attend"]
    sizes = np.diff(np.append(starts, len(x)))
    e = np.exp(s - np.repeat(np.maximum.reduceat(s, starts), sizes))
    weight = e / np.repeat(np.add.reduceat(e, starts), sizes)
    z = np.add.reduceat(h * weight[:, None], starts, axis=0)
    return h, a, g, weight, z, _sigmoid(z @ model["score"] + model["bias"]), sizes


def _gradients(model, x, starts, target):
    h, a, g, weight, z, p, sizes = _forward(model, x, starts)
    dy = (p - target) / len(target)
    dz = np.repeat(dy[:, None] * model["score"], sizes, axis=0)
    dweight = (h * dz).sum(1)
    ds = weight * (dweight - np.repeat(np.add.reduceat(weight * dweight, starts), sizes))
    dag = ds[:, None] * model["attend"]
    da, dg = dag * g * (1 - a * a), dag * a * g * (1 - g)
    dh = weight[:, None] * dz + da @ model["tanh"].T + dg @ model["gate"].T
    dpre = dh * (1 - h * h)
    return {
        "encode": x.T @ dpre + 1e-4 * model["encode"],
        "encode_bias": dpre.sum(0),
        "tanh": h.T @ da,
        "gate": h.T @ dg,
        "attend": (a * g).T @ ds,
        "score": z.T @ dy,
        "bias": dy.sum(),
    }


def fit(bags, targets, hidden=24, attention=12, steps=960, batch=128, rate=4e-3, seed=0):
    """Weights learned from bags of passages and their labels, by so many steps of Adam."""
    rng = np.random.default_rng(seed)

    def start(*shape):
        return rng.normal(0, shape[0] ** -0.5, shape)

    model = {
        "encode": start(WIDTH, hidden),
        "encode_bias": np.zeros(hidden),
        "tanh": start(hidden, attention),
        "gate": start(hidden, attention),
        "attend": start(attention),
        "score": np.zeros(hidden),
        "bias": np.float64(0),
    }
    targets = np.asarray(targets, float)
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    batches = -(-len(bags) // batch)
    for step in range(1, 1 + steps if bags else 1):
        if (step - 1) % batches == 0:
            order = rng.permutation(len(bags))
        at = (step - 1) % batches * batch
        chosen = order[at : at + batch]
        x = np.concatenate([bags[i] for i in chosen]).astype(float)
        starts = np.cumsum([0, *(len(bags[i]) for i in chosen[:-1])])
        for k, d in _gradients(model, x, starts, targets[chosen]).items():
            first[k] = 0.9 * first[k] + 0.1 * d
            second[k] = 0.999 * second[k] + 0.001 * d * d
            up = first[k] / (1 - 0.9**step)
            model[k] = model[k] - rate * up / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def train(df, labels, label="quality", doc_id="doc_id", text="text", passage_words=64,
          sample_docs=4_000, sample_passages=100_000, folds=5, held_fold=0):
    """A model from the labelled documents outside the held-out fold.

    The sample is the ``sample_docs`` labelled ids with the smallest hashes, in that order as long
    as their passages fit into ``sample_passages``.
    """
    usable = labels.filter(F.col(label).isNotNull() & (remainder(doc_id, folds) != held_fold))
    sample = (
        usable.groupBy(doc_id)
        .agg(F.avg(label).alias("__target"))
        .orderBy(F.xxhash64(doc_id), doc_id)
        .limit(sample_docs)
    )
    labelled = df.join(F.broadcast(sample), doc_id).select(
        F.col(doc_id).cast("long").alias("id"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.col("__target").alias("target"),
    )
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    sizes = labelled.groupBy("id").agg(
        F.max(F.greatest(F.ceil(words / passage_words), F.lit(1))).alias("n"),
        F.first(F.xxhash64(F.col("id"))).alias("rank"),
    )
    left, chosen = sample_passages, []
    for row in sorted(sizes.collect(), key=lambda r: (r["rank"], r["id"])):
        if row["n"] <= left:
            left -= row["n"]
            chosen.append((row["id"],))

    def encode(batches):
        for batch in batches:
            bags = [encode_passages(t, passage_words).ravel().tobytes() for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "target": batch["target"], "bag": bags})

    taken = df.sparkSession.createDataFrame(chosen, "id bigint")
    rows = (
        labelled.join(F.broadcast(taken), "id")
        .select("id", "text", "target")
        .mapInPandas(encode, "id bigint, target double, bag binary")
        .groupBy("id")  # rows that repeat an id count once, so the sample stays bounded
        .agg(F.max("target").alias("target"), F.max("bag").alias("bag"))
        .collect()
    )
    rows.sort(key=lambda r: r["id"])
    bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, WIDTH) for r in rows]
    return fit(bags, [r["target"] for r in rows])


def score(model, text, passage_words=64):
    """Column expression: probability that the text is good."""

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        scores, bags, waiting = [], [], 0

        def flush():
            starts = np.cumsum([0, *(len(b) for b in bags[:-1])])
            scores.extend(_forward(model, np.concatenate(bags).astype(float), starts)[5])
            bags.clear()

        for t in texts:
            bags.append(encode_passages(t, passage_words))
            waiting += len(bags[-1])
            if waiting > 4_000:
                flush()
                waiting = 0
        if bags:
            flush()
        return pd.Series(np.round(scores, 9))

    return of(F.coalesce(text, F.lit("")))


def score_documents(df, labels, doc_id="doc_id", text="text", name="score", **settings):
    """``df`` with the quality of each document, by a model trained on its labelled rows."""
    model = train(df, labels, "quality", doc_id, text, **settings)
    return df.withColumn(name, score(model, F.col(text)))
