"""Tokens, n-grams and ROUGE-N as column expressions.

The score of two texts is computed inside the row that holds both. Multiset
intersection is reduced to set intersection by naming repeated n-grams apart (second
occurrence ``gram#2``, third ``gram#3``, ...), because ``array_intersect`` hashes its
input while counting occurrences array by array would be quadratic.
"""

from pyspark.sql import functions as F

# A ROUGE token is a run of these characters in the lowercased text.
TOKEN_PATTERN = "[a-z0-9]+"
_SPACES = r" \t\n\x0B\f\r"
PIECE_PATTERN = rf"<\|im_(?:start|end)\|>|[{_SPACES}]+|[\p{{L}}\p{{N}}_]+|[^{_SPACES}\p{{L}}\p{{N}}_]"


def bind(value, body):
    """Evaluate ``value`` once per row and hand it to ``body`` as a variable.

    A plain column used inside a lambda is evaluated again for every element.
    """
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def no_strings():
    return F.array().cast("array<string>")


def _lowered(text):
    return F.lower(F.coalesce(text, F.lit("")))


def rouge_tokens(text):
    """Lowercased runs of letters a-z and digits; null text has no tokens."""
    return F.regexp_extract_all(_lowered(text), F.lit(TOKEN_PATTERN), F.lit(0))


def chat_pieces(text):
    """The text cut into chat markers, white space, words and single other characters.

    Put together again the pieces are the text, in any script; null text has none.
    """
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECE_PATTERN), F.lit(0))


def ngrams(tokens, n=3):
    """Array of the n-grams of a token array, space separated; empty when too short."""

    def grams(t):
        starts = F.slice(t, F.lit(1), F.size(t) - F.lit(n - 1))
        return F.when(
            F.size(t) >= n,
            F.transform(
                starts,
                lambda head, i: F.concat_ws(" ", head, *[F.get(t, i + k) for k in range(1, n)]),
            ),
        ).otherwise(no_strings())

    return bind(tokens, grams)


def distinct_occurrences(grams):
    """The same multiset as a set: the k-th occurrence (k > 1) of ``g`` becomes ``g#k``."""

    def number_runs(repeats):
        run_starts = F.filter(
            F.sequence(F.lit(0), F.size(repeats) - 1),
            lambda i: (i == 0) | (F.get(repeats, i) != F.get(repeats, i - 1)),
        )

        def number_run(starts):
            return F.flatten(
                F.transform(
                    starts,
                    lambda start, j: F.transform(
                        F.slice(
                            repeats,
                            start + 1,
                            F.coalesce(F.get(starts, j + 1), F.size(repeats)) - start,
                        ),
                        lambda gram, k: F.concat_ws("#", gram, (k + 2).cast("string")),
                    ),
                )
            )

        return F.when(F.size(repeats) == 0, no_strings()).otherwise(bind(run_starts, number_run))

    def repeats_of(ordered):
        repeats = F.filter(ordered, lambda gram, i: (i > 0) & (gram == F.get(ordered, i - 1)))
        return bind(repeats, number_runs)

    def add_repeats(whole):
        def extend(once):
            more = F.concat(once, bind(F.sort_array(whole), repeats_of))
            return F.when(F.size(once) == F.size(whole), once).otherwise(more)

        return bind(F.array_distinct(whole), extend)

    return bind(grams, add_repeats)


def gram_set(text, n=3):
    """Set of occurrence-numbered n-grams of a text; its size is the n-gram count."""
    return distinct_occurrences(ngrams(rouge_tokens(text), n))


def shared_grams(left_set, right_set):
    """Clipped overlap of two texts given their gram sets."""
    return F.size(F.array_intersect(left_set, right_set))


def overlap_score(overlap, target_size, prediction_size):
    """Precision, recall and F from n-gram counts; an empty side counts as one gram."""
    precision = overlap / F.greatest(prediction_size, F.lit(1))
    recall = overlap / F.greatest(target_size, F.lit(1))
    fmeasure = F.when(
        overlap > 0, 2 * precision * recall / (precision + recall)
    ).otherwise(F.lit(0.0))
    return F.struct(
        precision.alias("precision"), recall.alias("recall"), fmeasure.alias("fmeasure")
    )


def rouge_n(target, prediction, n=3):
    """ROUGE-N of two text columns of one row: struct of precision, recall, fmeasure."""
    pair = F.struct(gram_set(target, n).alias("t"), gram_set(prediction, n).alias("p"))
    return bind(
        pair,
        lambda g: overlap_score(shared_grams(g["p"], g["t"]), F.size(g["t"]), F.size(g["p"])),
    )


def _wanted_occurrences(grams, wanted):
    """The members of ``wanted``, a set of numbered occurrences, that the grams of a text have.

    Only grams that ``wanted`` has more than once have to be numbered, so the text's own grams are
    neither sorted nor counted.
    """
    again = F.transform(F.filter(wanted, lambda g: g.contains("#")), lambda g: F.substring_index(g, "#", 1))

    def matched(all_grams):
        once = F.array_intersect(all_grams, wanted)
        more = bind(
            F.array_distinct(again),
            lambda names: F.array_intersect(
                distinct_occurrences(F.filter(all_grams, lambda g: F.array_contains(names, g))), wanted
            ),
        )
        # The first occurrences are in both.
        return F.when(F.exists(wanted, lambda g: g.contains("#")), F.array_union(once, more)).otherwise(once)

    return bind(grams, matched)


def _quoted_grams(contract, quotes, n):
    """The n-grams of the contract that a quote has too, in order and with all repeats.

    Most grams of a contract are in no quote. Arrow hands over the texts, so those grams are never
    made into strings.
    """
    import pyarrow as pa

    pattern = TOKEN_PATTERN

    def run(texts, others):
        import re

        import pyarrow as pa

        words = re.compile(pattern).findall

        def grams(text):
            tokens = words(text)
            return zip(*(tokens[i:] for i in range(n)))

        def quoted(text, rest):
            wanted = {g for q in rest or () for g in grams(q)}
            return [" ".join(g) for g in grams(text) if g in wanted] if wanted else []

        found = []
        for at in range(0, len(texts), 256):
            found += map(quoted, texts.slice(at, 256).to_pylist(), others.slice(at, 256).to_pylist())
        return pa.array(found, pa.list_(pa.string()))

    run.__annotations__ = {"texts": pa.Array, "others": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<string>")(_lowered(contract), F.transform(quotes, _lowered))


def quote_precisions(contract, quotes, n=3):
    """Precision of every quote of an array against one contract text.

    The contract is reduced once to the grams that occur in any quote, so its cost does
    not grow with the number of quotes.
    """

    def against(row):
        return bind(
            bind(F.flatten(row["sets"]), lambda wanted: _wanted_occurrences(row["grams"], wanted)),
            lambda found: F.transform(
                row["sets"],
                lambda s: F.size(F.array_intersect(s, found)) / F.greatest(F.size(s), F.lit(1)),
            ),
        )

    sets = F.transform(quotes, lambda q: gram_set(q, n))
    return bind(F.struct(sets.alias("sets"), _quoted_grams(contract, quotes, n).alias("grams")), against)
