"""Hierarchical packing of tokenised documents into windows of several lengths.

Every task packs the documents it read, in four steps:

1. a document is tokenised and routed: whole windows of the longest size are cut off, and the
   rest goes to the shortest tier (a power of two) that holds it;
2. each tier opens a window of its size around its longest piece;
3. the gap is filled with the longest pieces that fit, which come from shorter tiers; only if
   none fits, the shortest longer piece is cut;
4. full windows of one size are dealt into step groups with the same number of tokens and
   nearly the same attention cost (the sum of squared piece lengths).

What is left at the end of a task is cut into powers of two, so no window needs padding. There
is no shuffle: neither the size of a source nor copies of a document matter, and memory is
bounded by ``pool_tokens``.

Edge cases: a null text is an empty one, which is the end id alone; null document ids are kept.
Repeated rows are packed each. Very long texts are cut into many windows. An empty table gives
an empty result. Other columns of the input are not read.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, window int, step_group bigint"
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("window", pa.int32()),
        ("step_group", pa.int64()),
    ]
)


def load_encoder(path, ranks_path=None, pattern=None):
    """A function from a text to its ids as an unsigned 32-bit array.

    ``path`` is a tokenizer file. ``ranks_path`` may name the same vocabulary as ranks, with
    the ``pattern`` that cuts words: texts of Latin-1 characters without a special token then
    take that three times faster way, which gives the same ids.
    """
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    special = [t.content for t in whole.get_added_tokens_decoder().values()]

    def slow(text):
        return np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)

    if ranks_path is None:
        return slow

    import base64

    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    quick = tiktoken.Encoding(
        "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )

    def encode(text):
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return slow(text)
        if any(token in text for token in special):
            return slow(text)
        return quick.encode_to_numpy(text).astype(np.uint32, copy=False)

    return encode


class _Pool:
    """Pieces by length; the lengths present are the bits of one number."""

    def __init__(self):
        self.by_length, self.present, self.tokens = {}, 0, 0

    def add(self, piece):
        n = len(piece[2])
        self.by_length.setdefault(n, []).append(piece)
        self.present |= 1 << n
        self.tokens += n

    def take(self, n):
        pieces = self.by_length[n]
        piece = pieces.pop()
        if not pieces:
            del self.by_length[n]
            self.present ^= 1 << n
        self.tokens -= n
        return piece

    def longest(self, most):
        """Longest length of at most ``most``, or 0."""
        return max(0, (self.present & ((1 << (most + 1)) - 1)).bit_length() - 1)

    def shortest_above(self, least):
        above = self.present >> (least + 1)
        return (above & -above).bit_length() + least


def _cut(piece, at):
    doc, start, ids, total = piece
    return (doc, start, ids[:at], total), (doc, start + at, ids[at:], total)


def _window(pool, first, size):
    """Pieces that fill a window from its first piece on; short only if the pool is empty."""
    pieces, gap = [pool.take(first)], size - first
    while gap and pool.tokens:
        fits = pool.longest(gap)
        if fits:
            pieces.append(pool.take(fits))
            gap -= fits
        else:
            head, rest = _cut(pool.take(pool.shortest_above(gap)), gap)
            pieces.append(head)
            pool.add(rest)
            gap = 0
    return pieces, gap


def _pack(pool, tiers, keep):
    """Full windows, long tiers first, until at most ``keep`` tokens are left in the pool."""
    for size in sorted(tiers, reverse=True):
        while pool.tokens > keep:
            first = pool.longest(size)
            if first == 0:
                break
            if first <= size // 2 and size != min(tiers):
                break  # no piece of this tier is left
            pieces, gap = _window(pool, first, size)
            if gap == 0:
                yield size, pieces
            else:
                yield from _powers(pieces, size - gap)


def _powers(pieces, tokens):
    """The pieces as windows that are powers of two, longest first."""
    left = pieces[::-1]
    while tokens:
        size = 1 << (tokens.bit_length() - 1)
        tokens -= size
        window, gap = [], size
        while gap:
            piece = left.pop()
            if len(piece[2]) > gap:
                piece, rest = _cut(piece, gap)
                left.append(rest)
            window.append(piece)
            gap -= len(piece[2])
        yield size, window


def _deal(windows, groups):
    """Group number of each window: costliest first, back and forth over the groups."""
    order = sorted(range(len(windows)), key=lambda i: -sum(len(p[2]) ** 2 for p in windows[i]))
    number = [0] * len(windows)
    for rank, i in enumerate(order):
        turn, place = divmod(rank, groups)
        number[i] = place if turn % 2 == 0 else groups - 1 - place
    return number


def _pieces(batches, encode, end_id, window):
    """Whole windows and rests of each document."""
    for batch in batches:
        docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for doc, text in zip(docs, texts):
            ids = np.append(encode(text), np.uint32(end_id))
            for start in range(0, len(ids), window):
                yield doc, start, ids[start : start + window], len(ids)


def pack(
    df,
    tokenizer,
    ranks=None,
    pattern=None,
    doc_id="doc_id",
    text="text",
    tiers=(128, 256, 512, 1024),
    end_id=0,
    step_tokens=32 * 1024,
    pool_tokens=2_000_000,
):
    """One row for each piece of a document, with its ids and its place in a sequence.

    ``ids`` holds little-endian unsigned 32-bit numbers. ``window`` is the length of the
    sequence, a tier or (at the end of a task) another power of two. A ``step_group`` holds
    sequences of one window length and ``step_tokens`` tokens, the last ones of a task fewer.
    """
    if any(t & (t - 1) for t in tiers) or max(tiers) > step_tokens:
        raise ValueError("tiers are powers of two of at most step_tokens")
    longest, rounds = max(tiers), 16

    def run(batches):
        base = TaskContext.get().partitionId() << 33
        encode = load_encoder(tokenizer, ranks, pattern)
        pool, waiting = _Pool(), {}
        counters = {"sequence": base, "group": base}
        rows = []

        def dealt(size):
            windows = waiting.pop(size, [])
            groups = -(-len(windows) * size // step_tokens)
            for pieces, group in zip(windows, _deal(windows, groups)):
                offset = 0
                for doc, start, ids, total in pieces:
                    rows.append(
                        (doc, start, len(ids), ids.astype("<u4").tobytes(), total,
                         counters["sequence"], offset, size, counters["group"] + group)
                    )
                    offset += len(ids)
                counters["sequence"] += 1
            counters["group"] += groups

        def add(size, pieces):
            waiting.setdefault(size, []).append(pieces)
            if len(waiting[size]) * size >= rounds * step_tokens:
                dealt(size)

        def batch():
            columns = list(zip(*rows))
            rows.clear()
            return pa.record_batch(
                [pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW
            )

        for piece in _pieces(batches, encode, end_id, longest):
            if len(piece[2]) == longest:
                add(longest, [piece])
            else:
                pool.add(piece)
            if pool.tokens > pool_tokens:
                for size, pieces in _pack(pool, tiers, pool_tokens // 2):
                    add(size, pieces)
            if len(rows) > 2000:
                yield batch()
        for size, pieces in _pack(pool, tiers, 0):
            add(size, pieces)
        for size in list(waiting):
            dealt(size)
        if rows:
            yield batch()

    source = df.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text")
    )
    return source.mapInArrow(run, SCHEMA)
