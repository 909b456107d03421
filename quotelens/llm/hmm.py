"""A hidden Markov language model: Baum-Welch on Spark, scores by the forward recursion.

A text is its words, lower-cased in A-Z, and one end. The chain emits word classes: the end, the
commonest training words each by itself, and classes of the other words by their last three bytes.
There are ``spread`` times the square root of the vocabulary of either kind, so what the states
learn grows with the corpus, slowly enough for one table (100 million different words: 320,000 classes,
20 MB with 8 states). Within a class a word has its add-one smoothed share of the training
tokens, one share being left for unknown words, so probabilities of texts sum to one. What the
states learn is which classes go together, such as the words of a language.

- Word counts cover every training text. The commonest words (at most ``held``) are broadcast;
  rarer ones are joined by hash, which is done at every size.
- Baum-Welch reads the classes of every training text whole; each task sums expected counts, which
  Spark adds up to one table of states by classes.
- A score is the scaled forward recursion over the whole text.
- A text of more than ``SEGMENT`` tokens is worked on in pieces at the same time, without a cut: the
  matrix that takes state probabilities over a piece gives what enters each piece from the left and
  from the right, and with these the recursions inside the pieces are those of the whole text.

Edge cases: a null or empty text is the end alone. Texts of any length are scored whole. Repeated
rows count and score each. Null ids are kept. Without training texts every class is as likely as
any other. An empty table gives an empty result. Other columns of the input are not read.
"""

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import functions as F

from ..session import settle

FLUSH, BLOCK, COUNTED = 400_000, 2 << 20, 32 << 20  # words remembered; bytes of texts, of words counted at once
SEGMENT, TOKENS = 1_024, 800_000  # of a piece, and of the pieces held at once


def _words(texts):
    """Words of an array of texts, A-Z in lower case, one after the other, and how many each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, full = split.flatten(), pc.greater(pc.binary_length(split.flatten()), 0)
    rows = pc.list_parent_indices(split).filter(full).to_numpy()
    return words.filter(full), np.bincount(rows, minlength=len(texts))


def _parts(batch, column, most=BLOCK):
    """Slices of a batch with about ``most`` bytes in a text column each."""
    sizes = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    at = np.flatnonzero(np.diff(sizes // most, prepend=-1))
    for a, b in zip(at.tolist(), [*at[1:].tolist(), len(sizes)]):
        yield batch.slice(a, b - a)


def count_words(texts):
    """(word, c) over all rows of ``texts``, column ``text``."""

    def run(batches):
        waiting, held = [], 0

        def out():
            found = pa.chunked_array(waiting, pa.string()).value_counts()
            waiting.clear()
            return pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "c"])

        for batch in batches:
            for part in _parts(batch, 0):
                words, _ = _words(part.column(0))
                waiting.append(words)
                held += words.nbytes
                if held > COUNTED:
                    yield out()
                    held = 0
        yield out()

    found = texts.mapInArrow(run, "word string, c bigint")
    return found.groupBy("word").agg(F.sum("c").alias("c"))


def _group(word, own, groups):
    return 1 + own + zlib.crc32(word[-3:]) % groups


def _common_cut(counts, most):
    """The smallest count, on a scale of four steps a doubling, that at most ``most`` words have."""
    step = F.floor(4 * F.log2("c")).cast("int")
    sizes = sorted(counts.groupBy(step.alias("step")).agg(F.count(F.lit(1))).collect(), reverse=True)
    held, cut = 0, None
    for at, n in sizes:
        held += n
        if held > most:
            break
        cut = at
    return math.inf if cut is None else math.ceil(2 ** (cut / 4) - 1e-9)


class Vocabulary:
    """Training counts, and what tasks need of them: all parts have a bounded size."""

    def __init__(self, texts, own=None, groups=None, held=500_000, spread=16):
        self.counts = settle(count_words(texts).withColumn("h", F.xxhash64("word")))
        self.texts = texts.count()
        words, known = self.counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
        self.tokens = words + self.texts
        self.types = known + (self.texts > 0)
        self.cut = _common_cut(self.counts, held)
        size = math.ceil(spread * math.sqrt(known)) + 1
        own, groups = size if own is None else own, size if groups is None else groups
        common = self.counts.filter(F.col("c") >= self.cut)
        self.code = "<u2" if 1 + own + groups <= 1 << 16 else "<u4"
        top = common.orderBy(F.desc("c"), "word").limit(own).select("word", "c").collect()
        self.own, self.groups = own, groups
        self.own_class = {r["word"].encode(): i + 1 for i, r in enumerate(top)}
        tail = F.substring(F.col("word").cast("binary"), -3, 3)
        sums = (
            self.counts.groupBy((F.crc32(tail) % groups).alias("g"))
            .agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n"))
            .collect()
        )
        self.class_tokens, class_types = np.zeros(1 + own + groups), np.zeros(1 + own + groups)
        for r in sums:
            self.class_tokens[1 + own + r["g"]], class_types[1 + own + r["g"]] = r["c"], r["n"]
        for r in top:
            group = _group(r["word"].encode(), own, groups)
            self.class_tokens[group] -= r["c"]
            class_types[group] -= 1
            self.class_tokens[self.own_class[r["word"].encode()]] = r["c"]
        self.class_tokens[0] = self.texts
        self.share = np.log10(self.class_tokens + class_types + 1)
        common = common.select("h", "c").orderBy("h").toArrow()
        self.hashes = common["h"].to_numpy().astype(np.int64)
        self.common = common["c"].to_numpy().astype(np.int64)

    def encoded(self, texts):
        """Stored rows: the classes of each text, and sums over words in and out of memory.

        ``base`` and ``inside`` are log10 probabilities of the words alone and within their
        classes. ``rare`` lists the words that are not in memory, to whose share log10(c + 1) is
        still to be added in both.
        """
        held = texts.sparkSession.sparkContext.broadcast((self.hashes, self.common))
        own_class, own, groups, share = self.own_class, self.own, self.groups, self.share
        code_type = np.dtype(self.code)
        total = math.log10(self.tokens + self.types + 1)
        ends = self.texts
        schema = pa.schema(
            [("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
             ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()),
             ("inside", pa.float64()), ("classes", pa.binary()),
             ("rare", pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())])))]
        )

        def run(batches):
            hashes, common = held.value
            row = TaskContext.get().partitionId() << 33
            seen, size = {}, 1 << 16
            code, count, key, told, inner = (
                np.zeros(size, t) for t in (code_type, np.int64, np.int64, np.float64, np.float64)
            )

            def learn(words):
                """Class, count (-1: not in memory) and hash of words not met yet."""
                nonlocal size, code, count, key, told, inner
                new = slice(len(seen), len(seen) + len(words))
                while new.stop > size:
                    size *= 2
                    code, count, key, told, inner = (np.resize(x, size) for x in (code, count, key, told, inner))
                h = np.array([xxhash.xxh64_intdigest(w, 42) for w in words], np.uint64).view(np.int64)
                at = np.minimum(np.searchsorted(hashes, h), max(0, len(hashes) - 1))
                found = hashes[at] == h if len(hashes) else np.zeros(len(h), bool)
                key[new], count[new] = h, -1
                count[new][found] = common[at[found]]
                code[new] = [own_class.get(w) or _group(w, own, groups) for w in words]
                told[new] = np.log10(np.maximum(count[new], 0) + 1)
                # Within a class of its own a word is certain: its share cancels out.
                inner[new] = np.where(code[new] > own, told[new] - share[code[new]], 0)
                seen.update(zip(words, range(new.start, new.stop)))

            def out(part):
                nonlocal row
                words, lengths = _words(part.column(1))
                coded = words.dictionary_encode()
                different = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
                if len(seen) > FLUSH:
                    seen.clear()
                learn([w for w in different if w not in seen])
                at = np.fromiter(map(seen.__getitem__, different), np.int64, len(different))
                at = at[coded.indices.to_numpy()]
                n, c, classes = part.num_rows, count[at], code[at]
                doc = np.repeat(np.arange(n), lengths)

                def total_of(values):
                    return np.bincount(doc, values, n)

                stops = np.cumsum(lengths + 1)
                filled = np.zeros(stops[-1], code_type)
                filled[np.arange(len(at)) + doc] = classes
                rare = np.flatnonzero(c < 0)
                rare = rare[np.lexsort((key[at[rare]], doc[rare]))]
                h, d = key[at[rare]], doc[rare]
                first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1]))[: len(h)])
                pairs = pa.StructArray.from_arrays(
                    [pa.array(h[first]), pa.array(np.diff(np.append(first, len(h))))], ["h", "n"]
                )
                columns = [
                    np.arange(row, row + n),
                    part.column(0),
                    part.column(2),
                    lengths + 1,
                    total_of(c > 0).astype(np.int64) + (ends > 0),
                    total_of(told[at]) - total * lengths + math.log10(ends + 1) - total,
                    total_of(inner[at]),
                    pa.Array.from_buffers(
                        pa.binary(), n,
                        [None, pa.py_buffer(np.append(0, code_type.itemsize * stops).astype(np.int32)), pa.py_buffer(filled)],
                    ),
                    pa.ListArray.from_arrays(
                        np.searchsorted(d[first], np.arange(n + 1)).astype(np.int32), pairs
                    ),
                ]
                row += n
                return pa.record_batch(
                    [pa.array(x).cast(f.type) for x, f in zip(columns, schema)], schema=schema
                )

            for batch in batches:
                for part in _parts(batch, 1):
                    yield out(part)

        return settle(
            texts.select("doc_id", "text", "held_out").mapInArrow(
                run,
                "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
                "base double, inside double, classes binary, rare array<struct<h:bigint,n:bigint>>",
            )
        )

    def rare_sums(self, rows):
        """Per row with rare known words: the sum of log10(c + 1), and their number."""
        words = rows.select("row", F.inline("rare"))
        rare = self.counts.filter(F.col("c") < self.cut).select("h", "c")
        return words.join(rare, "h").groupBy("row").agg(
            F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more"),
            F.sum("n").alias("more_known"),
        )


class Chain:
    """Start, transition and emission probabilities."""

    def __init__(self, start, move, emit):
        self.start, self.move, self.emit = start, move, emit
        self.by_state = np.ascontiguousarray(emit.T)

    def emitted(self, classes):
        """Emission probabilities, a row for each state."""
        return self.by_state.take(classes, axis=1)

    def tables(self):
        return self.start, self.move, self.emit

    @classmethod
    def initial(cls, class_tokens, states, seed):
        """Sticky states whose emissions differ by chance from the common one."""
        rng = np.random.default_rng(seed)
        common = (class_tokens + 1) / (class_tokens + 1).sum()
        emit = common[:, None] * np.exp(rng.normal(0, 0.5, (len(common), states)))
        return cls(np.full(states, 1 / states), 0.95 * np.eye(states) + 0.05 / states, emit / emit.sum(0))

    @classmethod
    def from_counts(cls, counts, class_tokens):
        """Maximisation, with a little of the common emission in every state.

        ``counts`` has a row for the start, one for each state left, and one for each class.
        """
        states = counts.shape[1]
        common = (class_tokens + 1) / (class_tokens + 1).sum()
        start, move = counts[0] + 0.1, counts[1 : 1 + states] + 0.1
        emit = counts[1 + states :] + 5 * common[:, None]
        return cls(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


class _Steps:
    """Pieces from long to short, their classes step by step: step t has the first ``active[t]``."""

    def __init__(self, pieces):
        lengths = np.array([len(p) for p in pieces])
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        self.active = np.searchsorted(-self.lengths, -np.arange(self.lengths[0]), side="left")
        self.first = np.cumsum(self.active) - self.active
        rank = np.repeat(np.arange(len(pieces)), self.lengths)
        step = np.arange(len(rank)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        self.classes = np.empty(len(rank), np.int64)
        self.classes[self.first[step] + rank] = np.concatenate([pieces[i] for i in self.order])

    def __iter__(self):
        return zip(self.active.tolist(), (slice(a, a + n) for a, n in zip(self.first.tolist(), self.active.tolist())))

    def ends(self):
        """Where the last token of each piece is."""
        return self.first[self.lengths - 1] + np.arange(len(self.lengths))


def _blocks(sequences, tokens):
    """Ranges of neighbouring sequences with about ``tokens`` tokens each."""
    held = (np.cumsum([len(s) for s in sequences]) - 1) // tokens
    at = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
    return zip(at.tolist(), np.append(at[1:], len(sequences)).tolist())


def _across(chain, pieces):
    """For each piece the matrix from the state before its first word to its last state, and its log10 scale."""
    steps, states, forth = _Steps(pieces), len(chain.start), chain.move.T.copy()
    across = np.repeat(np.eye(states)[:, :, None], len(pieces), axis=2)  # last state, state before, piece
    logs = np.zeros(len(pieces))
    for t, (n, at) in enumerate(steps):
        before = across[:, :, :n]
        if t:
            before = (forth @ before.reshape(states, -1)).reshape(states, states, n)
        np.multiply(before, chain.emitted(steps.classes[at])[:, None, :], out=across[:, :, :n])
        if t % 8 == 7 or t + 1 == len(steps.active):
            scale = across.sum((0, 1))
            across /= scale
            logs += np.log10(scale)
    back = np.argsort(steps.order)
    return across.transpose(2, 1, 0)[back], logs[back]


def _sweep(chain, pieces, first, matrix):
    """Of each piece the scaled vector after its last word, and its log10 scale.

    ``first`` goes into the first word, ``matrix`` takes a vector from a word to the next.
    """
    steps = _Steps(pieces)
    reached = np.repeat(first[:, None], len(pieces), axis=1)
    last, scales = np.empty_like(reached), np.empty(len(steps.classes))
    going_on = [*steps.active[1:].tolist(), 0]
    for (n, at), more in zip(steps, going_on):
        state = reached[:, :n] * chain.emitted(steps.classes[at])
        scale = state.sum(0, out=scales[at])
        state /= scale
        if more < n:
            last[:, more:n] = state[:, more:]
        reached = matrix @ state
    place = np.arange(len(scales)) - np.repeat(steps.first, steps.active)
    total = np.bincount(place, np.log10(scales), len(pieces))
    back = np.argsort(steps.order)
    return last.T[back], total[back]


def _forward(chain, pieces):
    """For pieces that begin a text the state at the last word."""
    return _sweep(chain, pieces, chain.start, chain.move.T.copy())


def _backward(chain, pieces):
    """For pieces that end a text its likelihood by the state at the first word."""
    return _sweep(chain, [p[::-1] for p in pieces], np.ones_like(chain.start), chain.move)


def _in_blocks(work, chain, pieces):
    blocks = [work(chain, pieces[a:b]) for a, b in _blocks(pieces, TOKENS)] if pieces else []
    return [np.concatenate(x) for x in zip(*blocks)] if blocks else [np.empty(0)] * 2


def _cut(sequence, segment):
    return [sequence[i : i + segment] for i in range(0, len(sequence), segment)]


def _borders(chain, sequences, segment):
    """Of each sequence of several pieces: these, what enters each from the left and the right, and its log10 likelihood.

    From the left comes the state at the last token before the piece, from the right the likelihood of
    all behind it by the state at its last token, to scale. Only pieces with others on both sides need
    a matrix; through the first and the last goes one vector.
    """
    pieces = [_cut(s, segment) for s in sequences]
    heads, head_logs = _in_blocks(_forward, chain, [mine[0] for mine in pieces])
    tails, tail_logs = _in_blocks(_backward, chain, [mine[-1] for mine in pieces])
    across, logs = _in_blocks(_across, chain, [p for mine in pieces for p in mine[1:-1]])
    at = 0
    for mine, state, total, tail, tail_log in zip(pieces, heads, head_logs, tails, tail_logs):
        inside = len(mine) - 2
        matrices = across[at : at + inside]
        total = total + tail_log + logs[at : at + inside].sum()
        at += inside
        left, right = np.zeros((2, len(mine), len(chain.start)))
        for i, matrix in enumerate(matrices, 1):
            left[i] = state
            state = state @ chain.move @ matrix
            total += math.log10(state.sum())
            state = state / state.sum()
        left[-1], right[-1] = state, 1
        total += math.log10(state @ chain.move @ tail)
        behind = chain.move @ tail
        for i in range(inside, -1, -1):
            behind = behind / behind.sum()
            right[i] = behind
            if i:
                behind = chain.move @ (matrices[i - 1] @ behind)
        yield mine, left, right, total


def log10_likelihood(chain, sequences, segment=SEGMENT):
    """Exact log10 probability of each class sequence."""
    lengths = np.array([len(s) for s in sequences])
    result = np.zeros(len(sequences))
    long = np.flatnonzero(lengths > segment)
    if len(long):
        result[long] = [total for *_, total in _borders(chain, [sequences[i] for i in long], segment)]
    short = np.flatnonzero(lengths <= segment)
    if len(short):
        result[short] = _forward(chain, [sequences[i] for i in short])[1]
    return result


def _piece_counts(chain, pieces, opening, left, right):
    """Expected counts of pieces, given what enters them; ``opening`` marks those that start a text.

    Arrays hold a row for each state, so that every operation runs along the tokens of a step.
    """
    steps, forth = _Steps(pieces), chain.move.T.copy()
    opening, left, beta = opening[steps.order], left[steps.order].T.copy(), right[steps.order].T.copy()
    emitted = chain.emitted(steps.classes)
    alpha, inverse = np.empty_like(emitted), np.empty(len(steps.classes))
    before = np.where(opening, chain.start[:, None], forth @ left)
    for n, at in steps:
        here, scale = alpha[:, at], inverse[at]
        np.multiply(before[:, :n], emitted[:, at], out=here)
        np.divide(1, here.sum(0), out=scale)
        here *= scale
        before = forth @ here
    beta /= (alpha[:, steps.ends()] * beta).sum(0)
    move = np.zeros_like(chain.move)
    for t in range(len(steps.active) - 1, -1, -1):
        n = steps.active[t]
        at = slice(steps.first[t], steps.first[t] + n)
        ahead = emitted[:, at] * beta[:, :n]
        ahead *= inverse[at]
        if t:
            move += alpha[:, steps.first[t - 1] : steps.first[t - 1] + n] @ ahead.T
        else:
            move += left[:, ~opening] @ ahead[:, ~opening].T
        alpha[:, at] *= beta[:, :n]  # from here on the probability of each state
        beta[:, :n] = chain.move @ ahead
    start = alpha[:, : len(pieces)][:, opening].sum(1)
    emit = np.stack([np.bincount(steps.classes, row, len(chain.emit)) for row in alpha], axis=1)
    return np.concatenate([start[None], move * chain.move, emit])


def expected_counts(chain, sequences, segment=SEGMENT):
    """Forward and backward over whole sequences: rows for the start, the states left and the classes."""
    states = len(chain.start)
    none, even = np.zeros((1, states)), np.ones((1, states))
    parts = [([s], none, even) for s in sequences if len(s) <= segment]
    long = [s for s in sequences if len(s) > segment]
    if long:
        parts += [x[:3] for x in _borders(chain, long, segment)]
    pieces = [p for mine, _, _ in parts for p in mine]
    opening = np.concatenate([np.arange(len(mine)) == 0 for mine, _, _ in parts])
    left, right = (np.concatenate([x[i] for x in parts]) for i in (1, 2))
    total = np.zeros((1 + states + len(chain.emit), states))
    for a, b in _blocks(pieces, TOKENS):
        total += _piece_counts(chain, pieces[a:b], opening[a:b], left[a:b], right[a:b])
    return total


def train(rows, vocabulary, states=8, rounds=6, segment=SEGMENT, seed=0):
    """Baum-Welch over the classes of all training rows."""
    classes = rows.filter("NOT held_out").select("classes")
    chain = Chain.initial(vocabulary.class_tokens, states, seed)
    context, code = rows.sparkSession.sparkContext, vocabulary.code
    names = [f"n{k}" for k in range(states)]
    for _ in range(rounds):
        shared = context.broadcast(chain.tables())

        def expect(batches, shared=shared):
            chain = Chain(*shared.value)
            total = np.zeros((1 + states + len(chain.emit), states))
            waiting, tokens = [], 0
            for batch in batches:
                for value in batch.column(0).to_pylist():
                    waiting.append(np.frombuffer(value, code))
                    tokens += len(waiting[-1])
                    if tokens > TOKENS:
                        total += expected_counts(chain, waiting, segment)
                        waiting, tokens = [], 0
            if waiting:
                total += expected_counts(chain, waiting, segment)
            at = np.flatnonzero(total.any(1))
            columns = [pa.array(at, pa.int32()), *(pa.array(total[at, k]) for k in range(states))]
            yield pa.record_batch(columns, ["at", *names])

        found = classes.mapInArrow(expect, ", ".join(["at int", *(f"{n} double" for n in names)]))
        sums = found.groupBy("at").agg(*(F.sum(n).alias(n) for n in names)).toArrow()
        counts = np.zeros((1 + states + len(chain.emit), states))
        counts[sums["at"].to_numpy()] = np.stack([sums[n].to_numpy() for n in names], axis=1)
        chain = Chain.from_counts(counts, vocabulary.class_tokens)
        shared.unpersist()
    return chain


def likelihoods(rows, chain, code, block=2_000_000):
    """(row, chain_score): the forward recursion over the classes of each row."""
    shared = rows.sparkSession.sparkContext.broadcast(chain.tables())

    def run(batches):
        chain, ids, sequences, tokens = Chain(*shared.value), [], [], 0

        def out():
            found = log10_likelihood(chain, sequences)
            made = pa.record_batch([pa.array(ids, pa.int64()), pa.array(found)], ["row", "chain_score"])
            ids.clear()
            sequences.clear()
            return made

        for batch in batches:
            for row, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(row)
                sequences.append(np.frombuffer(value, code))
                tokens += len(sequences[-1])
                if tokens > block:
                    yield out()
                    tokens = 0
        if ids:
            yield out()

    return rows.select("row", "classes").mapInArrow(run, "row bigint, chain_score double")


def score_texts(df, held_out, doc_id="doc_id", text="text", vocabulary=None, **training):
    """``doc_id``, ``held_out``, token numbers, and log10 probabilities of every text.

    ``held_out`` is a boolean column; the model learns from the rows where it is false.
    ``base_score`` is the add-one smoothed unigram probability, ``score`` the model's.
    """
    texts = df.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(text, F.lit("")).alias("text"),
        held_out.alias("held_out"),
    )
    words = Vocabulary(texts.filter("NOT held_out").select("text"), **(vocabulary or {}))
    rows = words.encoded(texts)
    chain = train(rows, words, **training)
    scored = likelihoods(rows, chain, words.code)
    parts = rows.drop("classes", "rare").join(scored, "row").join(words.rare_sums(rows), "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return parts.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("chain_score") + F.col("inside") + more).alias("score"),
    )
