import hashlib
import random
import re

from quotelens.llm import infilling

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def slow(doc_id, text):
    """Number of units, form and output, by hand."""
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 80:
        return n, "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, form string, output string")
    moved = infilling.transform(df)
    back = infilling.restore(moved["output"], moved["form"]).alias("back")
    found = moved.select("doc_id", "text", "n_units", "form", "output", back).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r["n_units"], r["form"], r["output"]) == slow(r["doc_id"], r["text"]), r["text"]
        assert r["back"] == (r["text"] or "")
    return {r["form"] for r in found}


def test_same_as_brute_force(spark):
    rng = random.Random(5)
    pieces = ["a", "Word", "ö", "😀", " ", "  ", "\n", "\t", "\x0b", "\x0c", "\r\n", " ", "$1", "\\", "<", "<S", "P>", "{2}"]
    rows = [(i, "".join(rng.choices(pieces, k=rng.randrange(30))), "x", "y") for i in range(600)]
    assert check(spark, rows) == {"plain", "psm", "spm"}


def test_edge_cases(spark):
    texts = [None, "", " ", "\n\n", "one", " one ", "has <M> inside", "<P>", "tail   ", "<P<S>"]
    rows = [(i, t, None, None) for t in texts for i in (None, -7, *range(20))]
    check(spark, rows * 2)
    assert infilling.transform(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_very_long_texts(spark):
    words = " ".join(f"w{i}" for i in range(300_000))
    spaces = " \n" * 300_000 + "end"
    rows = [(i, t, "", "") for t in (words, spaces, "x" * 1_000_000) for i in range(6)]
    check(spark, rows)
