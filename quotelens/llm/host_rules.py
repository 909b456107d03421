"""Quality rules judged for whole hosts.

Each document is measured and checked against a few rules. Failures are counted by host, and the
failure rate of each rule is shrunk towards the rate of all hosts: a beta prior is fitted to the
hosts' rates by their mean and variance, so a host with few documents is judged mostly by what is
usual. A host whose shrunk rate of any rule passes ``limit`` is blocked, and its documents with
it; documents that fail the base rules themselves are dropped on any host.

Only built-in functions run: a text is measured inside its row and never shuffled.

Edge cases: a null or empty text has no words and fails the base rules. A null host is a host of
its own. Repeated rows count as documents each. Very long texts are measured whole. An empty table
gives an empty result. Columns of the input that bear a measure's name are replaced.
"""

from pyspark.sql import functions as F

from ..session import settle
from .graph import join_unique
from .text import SPACES, whole

SYMBOLS = "#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def _bind(value, use):
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def words(text):
    """Words between ASCII white space."""
    return F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), "")


def _covered(hashes):
    """Positions in windows of three whose hash occurs twice or more."""

    def positions(ordered):
        def other(i):
            return F.coalesce(F.get(ordered, i)["h"], F.lit(0))

        def repeated(x, i):
            before = (i > 0) & (other(i - 1) == x["h"])
            return before | ((i + 1 < F.size(ordered)) & (other(i + 1) == x["h"]))

        starts = F.transform(F.filter(ordered, repeated), lambda x: x["i"])
        three = F.transform(starts, lambda i: F.array(i, i + 1, i + 2))
        return F.size(F.array_distinct(F.flatten(three)))

    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return _bind(F.array_sort(placed), positions)


def repeat_words(w):
    """Words in windows of three that the text has twice or more, the first included."""

    def count(hashes):
        same = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(same, 0).otherwise(_covered(hashes))

    starts = F.sequence(F.lit(0), F.size(w) - 3)
    windows = F.transform(
        starts, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    )
    return F.when(F.size(w) < 3, 0).otherwise(_bind(windows, count))


def _measured(text):
    def of_words(w):
        return F.struct(F.size(w).alias("n_words"), repeat_words(w).alias("n_repeat_words"))

    def of_lines(rows):
        return F.struct(
            F.size(rows).alias("n_lines"),
            (F.size(rows) - F.size(F.array_distinct(rows))).alias("n_dup_lines"),
        )

    filled = F.filter(F.split(text, "\n", -1), lambda r: F.btrim(r, F.lit(SPACES)) != "")
    return _bind(words(text), of_words), _bind(filled, of_lines)


def measure(df, text="text"):
    """``df`` with word, character, symbol and repeat counts of each text."""
    t = whole(F.col(text))
    by_words, by_lines = _measured(t)
    seen = df.withColumns({"__w": by_words, "__l": by_lines})
    return seen.withColumns(
        {
            "n_words": F.col("__w.n_words").cast("long"),
            "word_chars": F.length(F.translate(t, SPACES, "")).cast("long"),
            "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": F.col("__l.n_dup_lines").cast("long"),
            "n_repeat_words": F.col("__w.n_repeat_words").cast("long"),
            "n_lines": F.col("__l.n_lines").cast("long"),
        }
    ).drop("__w", "__l")


def rules():
    """Conditions under which a document fails, by name; the first two are the base rules."""
    n = F.col("n_words")
    return {
        "short": n < 50,
        "repetitive": 100 * F.col("n_repeat_words") > 50 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "dup_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 12 * n),
    }


def shrunk_rates(hosts, names):
    """``hosts`` (columns ``n`` and a failure count per rule) with a rate per rule.

    The prior has mean m, the rate of all documents, and the weight of k documents, from the
    variance between hosts beyond what chance explains; at most a million, at least one.
    """
    found = hosts.agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("hosts"),
        *[F.sum(r).alias(f"{r}_f") for r in names],
        *[F.sum(F.col(r) * F.col(r) / F.col("n")).alias(f"{r}_q") for r in names],
    ).first()
    if not found["n"]:
        return hosts.withColumns({f"{r}_rate": F.lit(0.0) for r in names})
    rates = {}
    for r in names:
        m = found[f"{r}_f"] / found["n"]
        chance = m * (1 - m)
        between = found[f"{r}_q"] / found["n"] - m * m - chance * found["hosts"] / found["n"]
        k = min(max(chance / max(between, 1e-12) - 1, 1.0), 1e6)
        rates[f"{r}_rate"] = (F.col(r) + F.lit(m * k)) / (F.col("n") + F.lit(k))
    return hosts.withColumns(rates)


def host_verdicts(measured, host="source", limit=0.5):
    """One row per host: documents, failures and shrunk rate per rule, and ``blocked``."""
    checks = rules()
    hosts = settle(
        measured.groupBy(host).agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(failed).alias(r) for r, failed in checks.items()],
        )
    )
    worst = F.greatest(*[F.col(f"{r}_rate") for r in checks])
    return shrunk_rates(hosts, list(checks)).withColumn("blocked", worst > limit)


def judge(df, doc_id="doc_id", host="source", text="text", limit=0.5):
    """``doc_id``, measures, ``base_failed`` and ``kept`` of every document."""
    needed = df.select(
        F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text")
    )
    known = F.when(F.col("host").isNull(), "0").otherwise(F.concat(F.lit("1"), "host"))
    measured = settle(measure(needed, "text").drop("text").withColumn("host", known))
    hosts = host_verdicts(measured, "host", limit)
    total = measured.count()
    judged = join_unique(measured, hosts.select("host", "blocked", "n"), "host", "n", total)
    checks = rules()
    base = checks["short"] | checks["repetitive"]
    return judged.select(
        "doc_id", *MEASURES, base.alias("base_failed"), (~base & ~F.col("blocked")).alias("kept")
    )
