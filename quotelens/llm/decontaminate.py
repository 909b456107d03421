"""Benchmark passages in training documents, also when edited or paraphrased.

1. Words and word pairs of the items are counted over all documents: in how many does each occur?
2. Each item gets the rarest of them as seeds, as many as make sure that a copy holds one; with one
   more it holds two, which few other texts do. A copy
   whose alignment reaches the threshold has m of the item's L words, and 2 m less its errors is at
   least the score that is needed. If m is large (``MANY`` of L), only L - m words are missing, so one
   of any L - m + 1 words is there. Otherwise few errors are left, they cut the copy into few runs, and
   so many pairs survive that one of the rarest L - 1 - survivors + 1 pairs is there. Seeds that no
   document has are left out afterwards: they cannot be the ones that survive.
3. One pass over the documents joins their words and pairs to the items by seed, and cuts out the
   passages where a copy may lie, as wide as a copy can be, if they have enough of that item's words.
   Each passage is aligned with the whole item by Smith-Waterman over words. The score is the best
   local alignment over that of the item with itself. Nothing that reaches the threshold is lost.

Seeds, their items and the items' words are arrays of 64-bit hashes that are broadcast; items are
taken ``block_chars`` characters at a time, which bounds them (about 20 bytes a word). Documents are
never shuffled, so no frequent seed meets in one task. Behind a check of their size the items' texts are
broadcast too, and passages are aligned where they are cut, by the same Python worker: two in a row would
double the workers of an executor, and they stay. Beyond it passages are stored and meet their item's
text in a join that parts frequent items.
Words are lower-cased, ASCII punctuation is white space. A score is at least that of ``LEAST`` words,
or of the whole item if it is shorter, so that a single shared word is no copy of a short item.

Edge cases: null or empty items match nothing, null or empty texts match nothing. Very long texts are
searched whole, and cut into passages. Repeated rows and repeated items give a row each, but are
aligned once for each document; null ids are kept. Empty tables give an empty result.
"""

import math
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F

from ..operators.joins import fits, join_small
from ..session import settle
from .graph import join_unique

MATCH, MISMATCH, GAP = 2, -1, -1
MANY, LEAST = 0.78, 6
TOGETHER = 500_000  # characters of texts that are hashed and looked up together
SLICE = 256
_PLAIN = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


def plain_words(text):
    """Lower-cased words without ASCII punctuation."""
    return text.lower().encode().translate(_PLAIN).decode().split()


def _hashes(words):
    """Hashes of the words, and of the pairs of neighbours."""
    from pandas.util import hash_array

    one = hash_array(np.array(words, object), categorize=False) if words else np.zeros(0, np.uint64)
    two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)) ^ (one[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    return one.view(np.int64), two.view(np.int64)


def _texts(column):
    """Texts of an Arrow column; only ``SLICE`` of them are Python's at a time."""
    for at in range(0, len(column), SLICE):
        yield from column.slice(at, SLICE).to_pylist()


def _together(texts):
    """Lists of the words of consecutive texts, ``TOGETHER`` characters or one text at a time."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > TOGETHER:
            yield held
            held, size = [], 0
        held.append(plain_words(text))
        size += len(text)
    if held:
        yield held


def _found(lists, known, marks):
    """Known grams of several texts at once: all words' hashes, where each text begins and ends in
    them, and for words and for pairs the places, the grams' numbers and the texts they are in."""
    one, two = _hashes([w for words in lists for w in words])
    sizes = [len(words) for words in lists]
    row = np.repeat(np.arange(len(lists)), sizes)
    hits = []
    for n, grams in enumerate((one, two)):
        places, which = _find(grams, known, marks)
        own = row[places] == row[places + n]  # no pair of the words of two texts
        hits.append((places[own], which[own], row[places[own]]))
    return one, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), hits


def needed(n, threshold):
    """Least score of a copy of an item of ``n`` words."""
    return max(math.ceil(threshold * MATCH * n), MATCH * min(n, LEAST))


def quotas(n, threshold):
    """How many of an item's rarest words, and of its rarest pairs, are seeds."""
    need = needed(n, threshold)
    least = -(-need // MATCH)
    many = min(n, max(least, math.ceil(MANY * n)))
    if many > least:
        # m words with errors e <= 2 m - need stand in at most e + 1 runs: m - e - 1 pairs survive,
        # least where m is largest
        survivors = (many - 1) - (MATCH * (many - 1) - need) - 1
        if survivors > 0:
            return n - many + 1, n - 1 - survivors + 1
    return n - least + 1, 0


def align(item, passage):
    """Best local alignment of two word-number arrays: score and end (exclusive) in the passage."""
    at = np.arange(len(passage) + 1) * -GAP
    above = np.zeros(len(passage) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        here = np.zeros_like(above)
        here[1:] = np.maximum(above[:-1] + np.where(passage == word, MATCH, MISMATCH), 0)
        here = np.maximum(here, above + GAP)
        above = np.maximum.accumulate(here + at) - at  # gaps in the passage
        top = int(above.argmax())
        if above[top] > best:
            best, end = int(above[top]), top
    return best, end


def _numbers(item, words):
    number = {w: i for i, w in enumerate(dict.fromkeys(item))}
    return (
        np.array([number[w] for w in item], np.int64),
        np.array([number.get(w, -1) for w in words], np.int64),
    )


def chosen(n, threshold):
    """Seeds among an item's words and pairs, and how many of each a copy holds at least.

    One more than :func:`quotas` says where there are so many: then a copy holds two.
    """
    words, pairs = quotas(n, threshold)
    many_words, many_pairs = min(words + 1, n), min(pairs + 1, n - 1) if pairs else 0
    return many_words, many_pairs, many_words - words + 1, many_pairs - pairs + 1


def _ranges(starts, length, slack, n):
    """Ranges of words where copies may lie that begin at ``starts``; overlapping ones are joined."""
    ranges = []
    for start in sorted(set(starts)):
        low, high = max(0, start - slack), min(n, start + length + slack)
        if ranges and low <= ranges[-1][1]:
            ranges[-1][1] = max(high, ranges[-1][1])
        else:
            ranges.append([low, high])
    return ranges


def best_copy(item, words):
    """Score, start and end of the best copy of ``item`` in ``words``; of equal ones the first."""
    a, b = _numbers(item, words)
    score, end = align(a, b)
    a, b = _numbers(item, words[:end])
    return score, end - align(a[::-1], b[::-1])[1], end


def _item_grams(batches):
    """Words (n = 1) and pairs (n = 2) of each item with their places."""
    schema = pa.schema([("item", pa.int64()), ("n", pa.int32()), ("gram", pa.int64()), ("at", pa.int32()),
                        ("length", pa.int32())])
    for batch in batches:
        for item, text in zip(*(c.to_pylist() for c in batch.columns)):
            words = plain_words(text)
            for n, grams in enumerate(_hashes(words), 1):
                size = len(grams)
                columns = [np.full(size, item), np.full(size, n), grams, np.arange(size), np.full(size, len(words))]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _bitmap(known):
    """Marks the low bits of the known grams, so that most others need no search."""
    marks = np.zeros(1 << max(10, (16 * len(known)).bit_length()), bool)
    marks[known & (len(marks) - 1)] = True
    return marks


def _find(grams, known, marks):
    """Places of ``grams`` that are in the sorted array ``known``, and where they are in it."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    maybe = np.flatnonzero(marks[grams & (len(marks) - 1)])
    at = np.searchsorted(known, grams[maybe])
    at[at == len(known)] = 0
    right = known[at] == grams[maybe]
    return maybe[right], at[right]


def _document_counts(texts, known):
    """Documents that hold each of the known grams, summed before they leave a task."""

    def run(batches):
        counts, marks = np.zeros(len(known.value), np.int64), _bitmap(known.value)
        for batch in batches:
            for lists in _together(_texts(batch.column(0))):
                for _, which, row in _found(lists, known.value, marks)[2]:
                    gram, docs = np.unique(np.unique(which * len(lists) + row) // len(lists), return_counts=True)
                    counts[gram] += docs
        held = np.flatnonzero(counts)
        yield pa.record_batch([known.value[held], counts[held]], names=["gram", "docs"])

    found = texts.mapInArrow(run, "gram bigint, docs bigint")
    return found.groupBy("gram").agg(F.sum("docs").alias("docs"))


def _seeds(grams, counts, threshold):
    """The rarest grams of each item, with their place; ``docs`` is in how many documents they are.

    An item is one text, so its grams are ranked in one task.
    """
    rank = F.row_number().over(Window.partitionBy("item", "n").orderBy(F.coalesce("docs", F.lit(0)), "at"))
    lengths = [r["length"] for r in grams.select("length").distinct().collect()]  # small: different lengths
    allowed = F.create_map(*[
        F.lit(x) for n in lengths for x in (n, list(chosen(n, threshold)))
    ]) if lengths else F.create_map().cast("map<int,array<int>>")
    mine = F.element_at(allowed, F.col("length"))
    ranked = grams.join(counts, "gram", "left").withColumn("rank", rank)
    return ranked.filter(F.col("docs").isNotNull() & (F.col("rank") <= F.element_at(mine, F.col("n"))))


def _index(seeds, grams, threshold):
    """Arrays that find the items of a seed, and the words of an item; bounded by the block."""
    held = seeds.select("gram", "n", "item", "at").orderBy("gram", "item", "at").toArrow()
    words = grams.filter("n = 1").groupBy("item", "gram").agg(F.count(F.lit(1)).alias("times"))
    words = words.orderBy("item", "gram").toArrow()
    items, first, sizes = np.unique(words.column("item").to_numpy(), return_index=True, return_counts=True)
    known, begin = np.unique(held.column("gram").to_numpy(), return_index=True)
    times = words.column("times").to_numpy()
    lengths = np.add.reduceat(times, first)
    least = [(needed(int(n), threshold), *chosen(int(n), threshold)[2:]) for n in lengths]
    return {
        "known": known,
        "marks": _bitmap(known),
        "begin": np.append(begin, held.num_rows),
        "holder": np.searchsorted(items, held.column("item").to_numpy()).astype(np.int32),
        "at": held.column("at").to_numpy().astype(np.int32),
        "pair": held.column("n").to_numpy() == 2,
        "items": items,
        "lengths": lengths,
        "least": np.array(least, np.int64).reshape(-1, 3),  # score, word seeds, pair seeds
        "first": np.append(first, words.num_rows),
        "words": words.column("gram").to_numpy(),  # different and sorted within an item
        "times": times,
    }


def _shared(different, times, window):
    """Words that an item (sorted, with repeats) and a window have in common, matched one to one."""
    at = np.searchsorted(different, window)
    at[at == len(different)] = 0
    held = np.bincount(at[different[at] == window], minlength=len(different))
    return int(np.minimum(held, times).sum())


def _candidates(one, places, which, index):
    """(item, low, high): ranges of a document's words that may hold a copy of an item.

    ``one`` has the hashes of its words; at ``places`` begin the seeds numbered ``which``.
    """
    begin, n = index["begin"][which], index["begin"][which + 1] - index["begin"][which]
    of = np.repeat(np.arange(len(places)), n)
    at = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + begin[of]
    holder, start, pair = index["holder"][at], places[of] - index["at"][at], index["pair"][at]
    order = np.argsort(holder, kind="stable")
    holder, start, pair = holder[order], start[order], pair[order]
    groups = np.flatnonzero(np.append(True, holder[1:] != holder[:-1]))
    pairs = np.add.reduceat(pair.astype(np.int64), groups)
    hits = np.diff(np.append(groups, len(holder)))
    _, least_words, least_pairs = index["least"][holder[groups]].T
    enough = (hits - pairs >= least_words) | ((pairs >= least_pairs) & (pairs > 0))
    ends = np.append(groups, len(holder))
    for g in np.flatnonzero(enough):
        i = int(holder[ends[g]])
        n, need = int(index["lengths"][i]), int(index["least"][i, 0])
        mine = slice(index["first"][i], index["first"][i + 1])
        for low, high in _ranges(start[ends[g] : ends[g + 1]].tolist(), n, MATCH * n - need, len(one)):
            # a score is MATCH a shared word at most
            if MATCH * _shared(index["words"][mine], index["times"][mine], one[low:high]) >= need:
                yield int(index["items"][i]), low, high


def _cut(index):
    """Passages of documents that may hold a copy of an item, one row each."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("item", pa.int64()), ("first", pa.int64()),
                        ("words", pa.string())])

    def run(batches):
        from pyspark import TaskContext

        row, known = TaskContext.get().partitionId() << 33, index.value
        for batch in batches:
            docs = iter(batch.column(0).to_pylist())
            for lists in _together(_texts(batch.column(1))):
                one, ends, hits = _found(lists, known["known"], known["marks"])
                places, which, text = (np.concatenate(x) for x in zip(*hits))
                order = np.argsort(text, kind="stable")
                places, which = places[order], which[order]
                cuts = np.searchsorted(text[order], np.arange(len(lists) + 1))
                out = []
                for k, (words, doc) in enumerate(zip(lists, docs)):
                    row += 1
                    mine, begin = slice(cuts[k], cuts[k + 1]), ends[k]
                    if cuts[k] == cuts[k + 1]:
                        continue
                    ranges = _candidates(one[begin : ends[k + 1]], places[mine] - begin, which[mine], known)
                    out += [(row, doc, i, low, " ".join(words[low:high])) for i, low, high in ranges]
                if out:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def _aligned(threshold):
    """The best copy of an item in a passage, where it reaches the threshold."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("item", pa.int64()), ("score", pa.float64()),
                        ("start_word", pa.int64()), ("end_word", pa.int64())])

    def run(batches):
        for batch in batches:
            out = []
            for row, doc, item, first, words, text in zip(*(c.to_pylist() for c in batch.columns)):
                target = plain_words(text)
                score, low, high = best_copy(target, words.split(" "))
                if score >= needed(len(target), threshold):
                    out.append((row, doc, item, score / (MATCH * len(target)), first + low, first + high))
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def _cut_aligned(index, texts, threshold):
    """:func:`_aligned` after :func:`_cut`; ``texts`` has the items' numbers, sorted, and their texts."""
    cut, aligned = _cut(index), _aligned(threshold)

    def run(batches):
        numbers, words = texts.value
        passages = cut(batches)
        yield from aligned(
            pa.record_batch([*p.columns, words.take(pa.array(np.searchsorted(numbers, p.column("item").to_numpy())))],
                            names=[*p.schema.names, "text"])
            for p in passages
        )

    return run


def _item_blocks(items, block_chars):
    """Different item texts with their number, block by block; blocks follow their total length."""
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = 1 + total // block_chars
    for i in range(blocks):
        yield items.filter(F.pmod(F.col("item"), F.lit(blocks)) == i)


def _copies(rows, items, threshold, block_chars):
    """Copies of different items in ``rows`` (doc_id, text): row, doc_id, item, score and words."""
    context = rows.sparkSession.sparkContext
    result = None
    for block in _item_blocks(items, block_chars):
        grams = settle(
            block.mapInArrow(_item_grams, "item bigint, n int, gram bigint, at int, length int")
        )
        if grams.isEmpty():
            continue
        distinct = grams.select("gram").distinct().toArrow().column(0).to_numpy()  # bounded by the block
        counts = settle(_document_counts(rows.select("text"), context.broadcast(np.sort(distinct))))
        seeds = settle(_seeds(grams, counts, threshold))
        index = context.broadcast(_index(seeds, grams, threshold))
        found = "row bigint, doc_id bigint, item bigint, score double, start_word bigint, end_word bigint"
        if fits(block) is not None:
            texts = block.select("item", "text").orderBy("item").toArrow().combine_chunks()  # bounded by the block
            texts = texts.column("item").to_numpy(), texts.column("text").combine_chunks()
            here = rows.mapInArrow(_cut_aligned(index, context.broadcast(texts), threshold), found)
        else:
            passages = "row bigint, doc_id bigint, item bigint, first bigint, words string"
            passages = settle(rows.mapInArrow(_cut(index), passages))
            held = passages.groupBy("item").agg(F.count(F.lit(1)).alias("held"))
            counted = block.select("item", "text").join(held, "item")
            total = passages.count()
            joined = join_unique(passages, counted, "item", "held", total)
            here = joined.select("row", "doc_id", "item", "first", "words", "text").mapInArrow(
                _aligned(threshold), found
            )
        result = here if result is None else result.unionByName(here)
    return result


def _different(benchmark, item_id, text):
    """Items as (number of the text, text, ids); the number is a hash of the text."""
    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    counted = rows.filter("text IS NOT NULL").groupBy("text", "item_id").agg(F.count(F.lit(1)).alias("times"))
    return settle(counted.withColumn("item", F.xxhash64("text")))


def contaminated(df, benchmark, doc_id="doc_id", text="text", item_id="item_id", item_text="text",
                 threshold=0.5, block_chars=8_000_000):
    """One row for each document and item found in it: score (0 to 1) and the words it covers.

    Of several copies the best is given, of equal ones the first.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    named = _different(benchmark, item_id, item_text)
    items = settle(named.select("item", "text").distinct())
    copies = _copies(rows, items, threshold, block_chars)
    schema = "doc_id bigint, item_id bigint, score double, start_word bigint, end_word bigint"
    if copies is None:
        return df.sparkSession.createDataFrame([], schema)
    best = F.max_by(F.struct("start_word", "end_word"), F.struct("score", -F.col("start_word"))).alias("place")
    found = copies.groupBy("row", "doc_id", "item").agg(F.max("score").alias("score"), best)
    ids = named.select("item", "item_id", "times")
    repeated = join_small(found, ids, "item").select("*", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return repeated.select("doc_id", "item_id", "score", "place.start_word", "place.end_word")


def drop_contaminated(df, benchmark, text="text", item_id="item_id", item_text="text",
                      threshold=0.5, block_chars=8_000_000):
    """``df`` without the rows in which an item is found; all columns stay.

    Rows are matched by a hash of their text, so equal texts go together.
    """
    items = settle(_different(benchmark, item_id, item_text).select("item", "text").distinct())
    value = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.xxhash64(value).alias("doc_id"), value.alias("text"))
    copies = _copies(rows, items, threshold, block_chars)
    if copies is None:
        return df
    found = settle(copies.select(F.col("doc_id").alias("__hash")).distinct())
    return join_small(df.withColumn("__hash", F.xxhash64(value)), found, "__hash", "left_anti").drop("__hash")

