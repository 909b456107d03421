"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position is given a non-zero vector of ``radius + 1`` bits. For each non-zero vector v
there is a table, whose mask keeps the positions with an odd product with v. The positions in
which two fingerprints differ, at most ``radius``, span less than the whole space, so some v is
orthogonal to all of them: in that table the masked fingerprints are equal. With vectors dealt
evenly each mask keeps about half of the bits.

Only different fingerprints enter the tables, so exact copies cost nothing. A bucket links its
members to one of them first (a star, not all pairs). Only buckets whose members are then still
in different components compare them, and only across components, in pieces of bounded size.

Edge cases: a null or empty text has fingerprint zero, linked like any other; fewer words than a
shingle make one shingle. Texts of any length are hashed whole, in blocks. Repeated rows have
one fingerprint. A null id is kept; a component of null ids alone has a null id. An empty table
gives an empty result. Other columns of the input are not read.
"""

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from ..session import settle
from .graph import components, join_unique
from .text import lower_words

BITS = 64
BLOCK = 1 << 16


def fingerprint(text, shingle=4, seed=42):
    """64-bit SimHash of a text as a signed number."""
    words = lower_words(text)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, n, BLOCK):
        here = words[start : start + min(BLOCK, n - start) + shingle - 1]
        runs = zip(*(here[i:] for i in range(shingle))) if len(here) >= shingle else [here]
        hashes = [xxhash.xxh64_intdigest(b" ".join(run), seed) for run in runs]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def simhash(text, shingle=4, seed=42):
    """Column expression: the fingerprint of a text as a bigint."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle, seed) for t in texts], dtype="int64")

    return of(F.coalesce(text, F.lit("")))


def hex16(fingerprint):
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def masks(radius, bits=BITS):
    """The mask of each table, as signed numbers."""
    vectors = [i % (2 ** (radius + 1) - 1) + 1 for i in range(bits)]
    kept = [
        sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2)
        for v in range(1, 2 ** (radius + 1))
    ]
    return [k - (1 << bits) if k >> (bits - 1) else k for k in kept]


def _near(a, b, radius):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= radius


def _buckets(prints, radius):
    """(table, bucket, f) of the fingerprints that share a bucket, with its smallest one."""
    tables = F.array(
        *[
            F.struct(
                F.lit(t).cast("tinyint").alias("t"),
                F.col("f").bitwiseAND(F.lit(mask).cast("long")).alias("k"),
            )
            for t, mask in enumerate(masks(radius))
        ]
    )
    # Spark sizes what it inlines like the fingerprints, without the tables: it would broadcast it.
    rows = prints.select("f", F.inline(tables))
    shared = rows.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n"), F.min("f").alias("pivot"))
    return rows.join(shared.filter("n > 1").drop("n").hint("merge"), ["t", "k"])


def _crossing(members, known, radius, piece):
    """Links between components of ``known`` that meet in a bucket."""
    placed = members.join(known, F.col("f") == F.col("node"), "left").select(
        "t", "k", "f", F.coalesce("root", "f").alias("c")
    )
    open_buckets = (
        placed.groupBy("t", "k")
        .agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count(F.lit(1)).alias("n"))
        .filter("low < high")
        .select("t", "k", "low", F.ceil(F.col("n") / piece).cast("int").alias("pieces"))
    )
    left = placed.join(open_buckets, ["t", "k"])
    right = left.filter("c > low").select(
        "t",
        "k",
        F.col("f").alias("g"),
        F.col("c").alias("d"),
        F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("s"),
    )
    left = left.select("t", "k", "f", "c", F.pmod(F.xxhash64("f"), "pieces").cast("int").alias("s"))
    pairs = left.join(
        right, on=(left.t == right.t) & (left.k == right.k) & (left.s == right.s)
        & (F.col("c") < F.col("d")) & _near("f", "g", radius)
    )
    return pairs.select(F.col("c").alias("a"), F.col("d").alias("b")).distinct()


def linked(prints, radius=4, piece=2_000):
    """(node, root) for the different fingerprints ``f`` that have a link.

    ``root`` is the smallest fingerprint reachable over links of at most ``radius`` bits. A
    bucket is compared in pieces of ``piece`` fingerprints.
    """
    members = settle(_buckets(prints, radius))
    stars = members.filter((F.col("f") != F.col("pivot")) & _near("f", "pivot", radius))
    first = components(stars.select(F.col("f").alias("a"), F.col("pivot").alias("b")))
    second = components(_crossing(members, first, radius, piece))
    upper = second.select(F.col("node").alias("root"), F.col("root").alias("top"))
    under = first.join(upper, "root", "left").select(
        "node", F.coalesce("top", "root").alias("root")
    )
    return settle(under.unionByName(second))


def near_groups(prints, doc_id="doc_id", f="f", radius=4):
    """``prints``, a stored table, with ``component_id``: the smallest id reachable."""
    distinct = settle(
        prints.groupBy(F.col(f).alias("f")).agg(
            F.min(doc_id).alias("first"), F.count(F.lit(1)).alias("n")
        )
    )
    total = distinct.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    roots = linked(distinct.select("f"), radius)
    family = (
        roots.select(F.col("node").alias("f"), "root")
        .unionByName(roots.select(F.col("root").alias("f"), "root").distinct())
        .join(distinct, "f")
    )
    heads = family.groupBy("root").agg(F.min("first").alias("head"))
    moved = family.join(heads, "root").select("f", "head")
    classes = distinct.join(moved, "f", "left").select(
        F.col("f").alias(f), F.coalesce("head", "first").alias("component_id"), "n"
    )
    return join_unique(prints.drop("component_id"), settle(classes), f, "n", total)


def near_duplicates(df, doc_id="doc_id", text="text", shingle=4, radius=4, seed=42):
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of each document."""
    prints = settle(
        df.select(F.col(doc_id).alias("doc_id"), simhash(F.col(text), shingle, seed).alias("f"))
    )
    return near_groups(prints, radius=radius).select(
        "doc_id", hex16(F.col("f")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(df, doc_id="doc_id", text="text", shingle=4, radius=4, seed=42):
    """``df`` with one document of each group: the smallest id, of repeated rows any one."""
    columns = df.columns
    placed = settle(
        df.withColumns(
            {"__row": F.monotonically_increasing_id(), "__f": simhash(F.col(text), shingle, seed)}
        )
    )
    prints = placed.select(F.col(doc_id).alias("__id"), "__row", "__f")
    rank = F.struct(F.col("__id").isNull(), "__id", "__row")
    ranked = prints.withColumn("__rank", rank)
    kept = near_groups(ranked, "__rank", "__f", radius).filter(
        F.col("component_id")["__row"] == F.col("__row")
    )
    return placed.join(kept.select("__row"), "__row", "left_semi").select(*columns)
