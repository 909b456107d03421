"""Lines that many documents share, found with levelled sorted runs of line hashes.

A store holds runs: Parquet folders of (line hash, documents) sorted by hash. A batch of
documents is counted, merge-anti-joined with the lines that the runs have already closed (found
in enough documents), and what is left becomes a run of level 0. As soon as a level has
``fanout`` runs they are merged into one run of the next level, so a store of n batches has
about ``fanout`` * log(n) runs. Line hashes have 128 bits.

A line's key is the line without ASCII white space at its ends and with A-Z in lower case;
lines with an empty key are never dropped.

Edge cases: a null or empty text is one empty line, and comes back as an empty text. A line
that a document repeats counts once for it; repeated rows count as a document each. An empty
table gives an empty result. A very common line is counted before it is shuffled: a batch's counts
are written before they meet the runs, so no join is moved below the count. When lines are dropped,
closed lines are broadcast behind a check of their size; beyond it occurrences are shuffled by line,
with lines that many documents share apart. Columns of the input that bear a result's name are replaced.

Runs are sorted by hash in each of their files, which Spark does not know of plain Parquet, so a merge
sorts them again; it exchanges counted lines only, never their occurrences.
"""

import uuid

from pyspark.sql import functions as F

from ..operators.joins import fits
from ..session import settle, shared_folder
from .graph import join_unique
from .text import SPACES, digest, lower_ascii, whole

KEY = ["h1", "h2"]


def lines(text):
    return F.split(whole(text), "\n", -1)


def _key(line):
    return F.btrim(line, F.lit(SPACES))


def line_hashes(text):
    """Distinct hashes of the lines with a key."""
    keys = F.array_distinct(F.transform(F.split(lower_ascii(whole(text)), "\n", -1), _key))
    return F.transform(F.filter(keys, lambda k: k != ""), lambda k: digest(k))


class LineRuns:
    """A new store of runs under ``folder``, by default in the shared folder.

    A batch counts once its runs are in the store's manifest, so a batch that fails half-way can be
    added again. Runs that were merged stay on disk until the folder is removed.
    """

    def __init__(self, spark, folder=None, min_docs=10, fanout=4):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.folder = folder or f"{shared_folder(spark)}/lines-{uuid.uuid4().hex}"
        self.levels, self.batches = [], 0

    @classmethod
    def open(cls, spark, folder):
        """The store as its last batch left it."""
        manifest = spark.read.parquet(f"{folder}/manifest")
        last = manifest.agg(F.max("batch")).first()[0]
        rows = manifest.filter(F.col("batch") == last).collect()
        store = cls(spark, folder, rows[0]["min_docs"], rows[0]["fanout"])
        store.batches = last
        store.levels = [[] for _ in range(1 + max(r["level"] for r in rows))]
        for r in sorted(rows, key=lambda r: r["place"]):
            store.levels[r["level"]].append(r["path"])
        return store

    def _publish(self):
        """One row for each run that counts: their number grows with the log of the batches."""
        self.batches += 1
        runs = [(level, path) for level, paths in enumerate(self.levels) for path in paths]
        rows = F.array(
            *[
                F.struct(F.lit(i).alias("place"), F.lit(level).alias("level"), F.lit(path).alias("path"))
                for i, (level, path) in enumerate(runs)
            ]
        )
        self.spark.range(1).select(
            F.lit(self.batches).alias("batch"),
            F.lit(self.min_docs).alias("min_docs"),
            F.lit(self.fanout).alias("fanout"),
            F.inline(rows),
        ).write.mode("append").parquet(f"{self.folder}/manifest")

    def _merged(self, paths):
        runs = self.spark.read.schema("h1 bigint, h2 bigint, docs bigint").parquet(*paths)
        return runs.groupBy(*KEY).agg(F.sum("docs").alias("docs"))

    def _write(self, counts, level):
        if level == len(self.levels):
            self.levels.append([])
        path = f"{self.folder}/level={level}/{uuid.uuid4().hex}"
        counts.sortWithinPartitions(*KEY).write.parquet(path)
        self.levels[level].append(path)
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(self._merged(full), level + 1)

    def counts(self):
        """Documents of each line in all runs; for a closed line, a number that closes it."""
        return self._merged([path for level in self.levels for path in level])

    def closed(self):
        """Lines found in at least ``min_docs`` documents, with a number of documents (``docs``)."""
        return self.counts().filter(F.col("docs") >= self.min_docs)

    def add(self, texts, column="text"):
        """Count the lines of a batch of documents and keep them as a run."""
        found = texts.select(F.explode(line_hashes(F.col(column))).alias("line"))
        counts = found.groupBy("line.h1", "line.h2").agg(F.count(F.lit(1)).alias("docs"))
        if any(self.levels):
            counts = settle(counts)
            counts = counts.join(self.closed().select(*KEY).hint("merge"), KEY, "left_anti")
        self._write(counts, 0)
        self._publish()


def _held(found, closed):
    """Those of the lines ``found`` that are closed."""
    if fits(closed) is not None:
        return found.join(F.broadcast(closed.select(*KEY)), KEY)
    closed = settle(closed.select(*KEY, "docs", F.lit(True).alias("__is")))
    # Counted documents of a line stop when it is closed, so this is a lower bound of all, as is
    # their sum: lines that stand out in it are those that stand out in the occurrences.
    total = closed.agg(F.sum("docs")).first()[0]
    return join_unique(found, closed, KEY, "docs", total).filter("__is").drop("__is")


def drop_lines(df, closed, doc_id="doc_id", text="text"):
    """``df`` without the closed lines; adds ``n_lines`` (before) and ``n_dropped``."""
    row = digest(F.col(doc_id), F.col(text))
    found = df.select(
        row.alias("__row"), F.explode(line_hashes(F.col(text))).alias("__line")
    ).select(
        F.col("__row.h1").alias("__r1"),
        F.col("__row.h2").alias("__r2"),
        F.col("__line.h1").alias("h1"),
        F.col("__line.h2").alias("h2"),
    )
    held = _held(found, closed)
    per_row = held.groupBy("__r1", "__r2").agg(
        F.collect_set(F.struct(*KEY)).alias("__closed")
    )
    rows = df.withColumns({"__r1": row["h1"], "__r2": row["h2"]})
    marked = rows.join(per_row, ["__r1", "__r2"], "left")
    all_lines = lines(F.col(text))

    def stays(line):
        return ~F.array_contains("__closed", digest(lower_ascii(_key(line))))

    kept = F.when(F.col("__closed").isNull(), all_lines).otherwise(F.filter(all_lines, stays))
    return (
        marked.withColumn("__kept", kept)
        .withColumn("n_lines", F.size(all_lines).cast("long"))
        .withColumn("n_dropped", F.col("n_lines") - F.size("__kept"))
        .withColumn(text, F.array_join("__kept", "\n"))
        .drop("__r1", "__r2", "__closed", "__kept")
    )


def dedup_lines(df, doc_id="doc_id", text="text", min_docs=10, batches=4):
    """Drop all lines found in ``min_docs`` documents or more, in every document.

    The table goes through a store in ``batches`` parts, as new crawls would.
    """
    store = LineRuns(df.sparkSession, min_docs=min_docs)
    part = F.pmod(F.xxhash64(doc_id), F.lit(batches))
    for i in range(batches):
        store.add(df.filter(part == i), text)
    return drop_lines(df, store.closed(), doc_id, text)
