"""Documents rearranged for fill-in-the-middle training, by one counted pattern a row.

A text is cut into units: a word with the white space before it, or white space at the end. The
number of units n comes from ``regexp_count``; hashes of the document choose two cuts. The row's
own pattern ``((?:unit){a}+)((?:unit){b-a}+)(.*)`` captures prefix, middle and suffix in one match,
and the replacement puts them in order behind their marks. All quantifiers are possessive, so the
match is one loop over the text without backtracking or recursion.

Only built-in functions run; nothing is shuffled.

Edge cases: a null or empty text is plain and empty. A text that holds one of the marks is plain,
so marks are never ambiguous. A null id is hashed as an empty one. Very long texts take one pass
for the count and one for the cut, in time linear in their length. Repeated rows give equal rows.
An empty table gives an empty result. Columns of the input that bear a result's name are replaced.
"""

from pyspark.sql import functions as F

from .text import whole

#: Prefix, suffix and middle mark; each starts with the only ``<`` it has.
MARKS = ("<P>", "<S>", "<M>")
UNIT = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++"


def draws(doc_id, seed):
    """Four unsigned 32-bit draws from the hash of a document's id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), whole(F.col(doc_id).cast("string"))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def _between(text, first, last=None):
    """The part of ``text`` from position ``first`` (from 1) up to before ``last``."""
    if last is None:
        return F.substr(text, first)
    return F.substr(text, first, last - first)


def parts(output, form):
    """Prefix, middle and suffix of a transformed text; null for plain ones."""
    p, s, m = (F.instr(output, mark) for mark in MARKS)
    wide = F.lit(len(MARKS[0]))
    psm = F.struct(
        _between(output, p + wide, s).alias("prefix"),
        _between(output, m + wide).alias("middle"),
        _between(output, s + wide, m).alias("suffix"),
    )
    spm = F.struct(
        _between(output, p + wide, m).alias("prefix"),
        _between(output, m + wide).alias("middle"),
        _between(output, s + wide, p).alias("suffix"),
    )
    return F.when(form == "psm", psm).when(form == "spm", spm)


def restore(output, form):
    """The text before the transformation."""
    found = parts(output, form)
    joined = F.concat(found["prefix"], found["middle"], found["suffix"])
    return F.when(form == "plain", output).otherwise(joined)


def transform(df, doc_id="doc_id", text="text", rate=50, spm=80, seed=42):
    """``df`` with ``output``, ``form`` (plain, psm or spm) and ``n_units``.

    ``rate`` is the share of texts to rearrange in percent, ``spm`` the share of those with the
    suffix first.
    """
    h1, h2, h3, h4 = draws(doc_id, seed)
    value, n = whole(F.col(text)), F.col("n_units")
    marked = F.lit(False)
    for mark in MARKS:
        marked = marked | F.contains(value, F.lit(mark))
    form = (
        F.when((value == "") | marked | (h3 % 100 >= rate), "plain")
        .when(h4 % 100 < spm, "spm")
        .otherwise("psm")
    )
    one, two = h1 % (n + 1), h2 % (n + 1)
    first, second = F.least(one, two), F.greatest(one, two)
    pattern = F.concat(
        F.lit(rf"(?s)\A((?:{UNIT}){{"), first, F.lit(rf"}}+)((?:{UNIT}){{"), second - first,
        F.lit("}+)(.*+)"),
    )
    p, s, m = MARKS
    order = F.when(F.col("form") == "spm", f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    counted = df.withColumns(
        {"n_units": F.regexp_count(value, F.lit(UNIT)).cast("long"), "form": form}
    )
    moved = F.regexp_replace(value, pattern, order)
    return counted.withColumn("output", F.when(F.col("form") == "plain", value).otherwise(moved))
