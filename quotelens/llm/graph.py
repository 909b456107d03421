"""Connected components of a table of links, and joins that a hot key does not slow."""

from pyspark.sql import functions as F

from ..session import settle

HOT_KEYS = 5_000


def _symmetric(links):
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links):
    """Each node hands its larger neighbours to the smallest node next to it."""
    both = _symmetric(links)
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links):
    """Each node and its smaller neighbours hang on the smallest of them; links point down."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(links):
    """(node, root) of every node of ``links``, columns ``a`` and ``b``.

    ``root`` is the smallest node that can be reached; it gets no row of its own. Large and
    small stars alternate until nothing changes, which takes a number of rounds logarithmic in
    the nodes; each round is written to the shared folder.
    """
    down = links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links, seen = settle(down.distinct()), None
    while True:
        state = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state[0] == 0 or state == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        large = _large_star(links).filter("a <> b").distinct()
        links = settle(_small_star(large).filter("a <> b").distinct())


def join_unique(rows, unique, key, count, total):
    """Left join of ``rows`` with a table that has one row a key.

    ``count`` names the column with the rows of each key, ``total`` is their sum. Keys with more
    than one in ``HOT_KEYS`` of all rows, fewer than ``HOT_KEYS`` by that, are broadcast, so none
    of them meets in a task; the others are shuffled whatever size Spark expects of their files,
    which is several times below what they take in memory. ``rows`` is read twice.
    """
    hot = F.broadcast(unique.filter(F.col(count) * HOT_KEYS > total).drop(count))
    cold = unique.filter(F.col(count) * HOT_KEYS <= total).drop(count).hint("merge")
    rest = rows.join(hot.select(key), key, "left_anti").join(cold, key, "left")
    return rows.join(hot, key).unionByName(rest)
