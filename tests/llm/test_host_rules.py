import re
from collections import Counter

import pytest

from quotelens.llm import host_rules

SPACE = "[\x20\x09-\x0d]+"


def brute(text):
    text = text or ""
    words = [w for w in re.split(SPACE, text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.sub(SPACE, "", x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
    }


TEXTS = [
    None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "x x x x x x", "a b c d\na b c d\n\nend",
    "Été#1 | <b> été\n Été#1 | <b> été", "ab c\x0babc\x0cab\rc", "\u00a0 nbsp\u00a0word", "𝒳𝒴 𝒵 " * 4,
    "one two three four five " * 40 + "six", " ".join(f"w{i % 97}" for i in range(5_000)), "\n\na\n\na\n",
]


def test_measures_equal_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    df = df.selectExpr("*", "5 AS n_words", "'x' AS h", "6 AS i")
    for r in host_rules.measure(df).collect():
        want = brute(TEXTS[r["doc_id"]])
        assert {k: r[k] for k in want} == want
        assert r["h"] == "x"


GOOD = " ".join(f"word{i}" for i in range(60))
JUNK = " ".join(f"w{i}*** $$$" for i in range(60))


def rows():
    good = [(i, f"good{i % 3}", GOOD) for i in range(60)]
    junk = [(100 + i, "junk", JUNK) for i in range(30)] + [(140, "junk", GOOD)]
    small = [(150, "small", JUNK), (151, None, GOOD), (152, None, None), (153, "", "short")]
    return [*good, *junk, *small, (100, "junk", JUNK)]


def test_hosts_are_judged_by_shrunk_rates(spark):
    df = spark.createDataFrame(rows(), "doc_id bigint, source string, text string").repartition(3)
    out = host_rules.judge(df.selectExpr("*", "1 AS blocked", "2 AS n", "3 AS host")).collect()
    kept = {r["doc_id"]: r["kept"] for r in out}
    assert len(out) == len(rows())
    assert all(kept[i] for i in range(60)) and kept[151]
    assert not any(kept[100 + i] for i in range(30)) and not kept[140]  # a good page of a bad host
    assert not kept[152] and not kept[153]
    assert {r["base_failed"] for r in out if r["doc_id"] in (152, 153)} == {True}


def test_the_prior_has_the_moments_of_the_hosts(spark):
    hosts = [("a", 100, 90), ("b", 100, 10), ("c", 1, 1), ("d", 400, 40)]
    df = spark.createDataFrame(hosts, "host string, n bigint, bad bigint")
    found = {r["host"]: r["bad_rate"] for r in host_rules.shrunk_rates(df, ["bad"]).collect()}
    n, f = sum(h[1] for h in hosts), sum(h[2] for h in hosts)
    m = f / n
    between = sum(h[2] ** 2 / h[1] for h in hosts) / n - m * m - m * (1 - m) * 4 / n
    k = min(max(m * (1 - m) / between - 1, 1), 1e6)
    for host, n, f in hosts:
        assert found[host] == pytest.approx((f + m * k) / (n + k))
    assert found["c"] < 0.8 < found["a"]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, source string, text string")
    assert host_rules.judge(df).collect() == []
