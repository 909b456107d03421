"""A dataset that grows by appends: only new keys are added, and known ones are found cheaply.

Every append is a published version that holds its own rows only, cut into ranges of the keys' hash
(one folder each), with a Bloom filter for each range. An append asks the filters of all versions
first. Only where a filter says that a key may be known is that range of that version opened and
compared exactly; other data files are not touched. A filter that is wrong costs reading a range,
never a row.

The filters take ``BITS`` bits a key and so about 1 % of such reads; a filter is one row of a small
table, and a new key meets one row for each version.

Edge cases: of new rows with one key the smallest stays, columns compared from left to right. Keys
may have null parts, which are values like others. An append without any new key publishes an empty
version. Two appends at a time under different tags may both add a key; ``repeated_keys`` finds
such keys.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..operators.joins import fits, hinted
from ..session import settle
from . import readers, writers

BITS, HASHES = 10, 7
RANGE, KEY_HASH = "key_range", "key_hash"
_FILTERS = f"{RANGE} int, words array<bigint>"


def _digest(ids):
    """128 bits of the key; a null part differs from any value."""
    parts = [F.coalesce(F.to_json(F.struct(F.col(c).alias("k"))), F.lit("")) for c in ids]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts)))


def _range(digest, ranges):
    return F.pmod(F.xxhash64(digest), F.lit(ranges)).cast("int")


def _positions(digest, size):
    """Bits of a key in a filter of ``size`` bits."""
    return F.array(*[F.pmod(F.xxhash64(digest, F.lit(i)), size) for i in range(1, HASHES + 1)])


def bloom_filters(rows):
    """One filter a range from ``key_range`` and ``key_hash``, as 64-bit words.

    Words are combined before and after the shuffle, so no range's keys meet in one task; the words
    of a range are put in an array, ``BITS`` bits a key.
    """
    counts = rows.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.select(RANGE, (F.ceil(F.col("n") * BITS / 64) * 64).cast("long").alias("bits"))
    placed = rows.join(F.broadcast(sizes), RANGE)  # a row a range
    bits = placed.select(RANGE, "bits", F.explode(_positions(F.col(KEY_HASH), F.col("bits"))).alias("at"))
    words = bits.groupBy(RANGE, "bits", F.floor(F.col("at") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS INT))")).alias("set")
    )
    entries = F.map_from_entries(F.collect_list(F.struct("word", "set")))
    numbers = F.sequence(F.lit(0), (F.col("bits") / 64).cast("int") - 1)
    dense = F.transform(numbers, lambda i: F.coalesce(F.element_at("entries", i), F.lit(0).cast("long")))
    filters = words.groupBy(RANGE, "bits").agg(entries.alias("entries"))
    return filters.select(RANGE, dense.alias("words"))


def may_contain(words, digest):
    """False if a key is surely not among those of a filter."""
    at = _positions(digest, F.size(words).cast("long") * 64)

    def is_set(p):
        word = F.get(words, F.floor(p / 64).cast("int"))
        return F.getbit(word, (p % 64).cast("int")) == 1

    return F.forall(at, is_set)


def _versions(spark, root, key):
    """Published versions in the order of publishing."""
    mine = readers.versions(spark, root).filter(F.col("key") == key)
    return mine.orderBy("published", "version").collect()  # a row a version


def read_filters(spark, root, key):
    """Filters of all published versions with the place of their version; None without any."""
    found = None
    for row in _versions(spark, root, key):
        path = f"{root}/{row['path']}"
        here = spark.read.schema(_FILTERS).parquet(f"{path}/filters").withColumn("path", F.lit(path))
        found = here if found is None else found.unionByName(here)
    return found


def candidates(keyed, filters):
    """Keys (``key_range``, ``key_hash``) with the version whose filter may hold them."""
    joined = keyed.join(hinted(filters, fits(filters)), RANGE)
    return joined.filter(may_contain(F.col("words"), F.col(KEY_HASH))).select(RANGE, KEY_HASH, "path")


def known_keys(keyed, filters):
    """Those of the keys that a version holds. Opens the ranges that the filters point to only."""
    spark = keyed.sparkSession
    hits = settle(candidates(keyed, filters))
    places = [  # at most a row for each version and range
        f"{r['path']}/rows/{RANGE}={r[RANGE]}" for r in hits.select("path", RANGE).distinct().collect()
    ]
    schema = f"{KEY_HASH} binary"
    if not places:
        return spark.createDataFrame([], schema), places
    stored = spark.read.schema(schema).parquet(*sorted(places))
    return hits.select(KEY_HASH).distinct().join(stored, KEY_HASH, "left_semi"), places


def append_new(new, root, key, ids, tag, ranges=64):
    """Publish the rows of ``new`` whose key no version holds as version ``tag``.

    ``ranges`` is the number of hash ranges; all versions of a dataset have to use the same. Returns
    the number of ranges of older versions that had to be opened.
    """
    spark = new.sparkSession
    writers.refuse_published(spark, root, key, tag)
    ids = [ids] if isinstance(ids, str) else list(ids)
    rest = [c for c in new.columns if c not in ids]
    digest = _digest(ids)
    one = new.withColumn(KEY_HASH, digest).groupBy(KEY_HASH).agg(F.min(F.struct(*ids, *rest)).alias("_row"))
    keyed = settle(one.withColumn(RANGE, _range(F.col(KEY_HASH), ranges)))
    filters = read_filters(spark, root, key)
    opened, fresh = [], keyed
    if filters is not None:
        known, opened = known_keys(keyed.select(RANGE, KEY_HASH), filters)
        fresh = keyed.join(known, KEY_HASH, "left_anti")
    path, attempt = writers.new_attempt(root, key, tag)
    rows = fresh.select(KEY_HASH, RANGE, "_row.*")
    # Several files a range where there is much to write; AQE sizes them.
    rows.hint("rebalance", RANGE).write.partitionBy(RANGE).parquet(f"{path}/rows")
    written = spark.read.schema(rows.schema).parquet(f"{path}/rows")
    bloom_filters(written.select(RANGE, KEY_HASH)).write.parquet(f"{path}/filters")
    writers.publish(spark, root, key, tag, attempt)
    return len(opened)


def read_appended(spark, root, key, upto=None):
    """All rows of all versions, or of those published no later than version ``upto``, with ``version``."""
    rows = _versions(spark, root, key)
    if upto is not None:
        tags = [row["version"] for row in rows]
        rows = rows[: tags.index(upto) + 1] if upto in tags else []
    result = None
    for row in rows:
        here = _rows(spark, f"{root}/{row['path']}/rows")
        if here is not None:
            here = here.drop(RANGE, KEY_HASH).withColumn("version", F.lit(row["version"]))
            result = here if result is None else result.unionByName(here, allowMissingColumns=True)
    if result is None:
        raise ValueError(f"no such published version of {key}")
    return result


def _rows(spark, path):
    """Rows of a version; None if it is empty, as nothing was written then."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as absent:
        if absent.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


def repeated_keys(spark, root, key):
    """Keys that several versions hold, which only appends at the same time can have added."""
    stored = None
    for row in _versions(spark, root, key):
        here = spark.read.schema(f"{KEY_HASH} binary").parquet(f"{root}/{row['path']}/rows").select(KEY_HASH)
        stored = here if stored is None else stored.unionByName(here)
    return stored.groupBy(KEY_HASH).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
