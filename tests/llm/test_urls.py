import math
import random
import re

import pytest

from quotelens.llm import urls
from quotelens.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "http://A.Com", "https://www.Example.com/en/x", "x://example.com/en/",
    "http://sub.example.com/en/1?a=1&b=2#t", "http://example.com/EN/", "http://notexample.com/en/", "ftp://net/es/",
    "http://a.net/es/?q", "http://a.net/es", "http://a.net/fr/#x", "http://com?x", "http://com#/", "http://com/",
    "a://b://c.net/es/", "http://B\u00c4R.net/fr/", "http://a.net:80/es/", "http://u@a.com/x/y/z.html",
    "http://line\nbreak.com/a\nb?c\nd", "http://" + "x" * 5_000 + ".com/" + "y/" * 5_000,
]


def split(url):
    scheme, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def rule_of(host, path):
    best = (None, None)
    for verdict, text in URL_RULES:
        name, _, start = text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            best = max(best, (text, verdict), key=lambda b: len(b[0] or ""))
    return best


def test_hosts_paths_and_rules_equal_brute_force(spark):
    rows = [(i, u, i % 2) for i, u in enumerate(URLS)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, label int")
    df = df.selectExpr("*", "'h' AS host", "1 AS domain", "2 AS fold")
    out = {r["page_id"]: r for r in urls.judge(df, URL_RULES).collect()}
    assert len(out) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = split(url)
        rule, verdict = rule_of(host, path)
        assert (out[i]["host"], out[i]["path"], out[i]["rule"]) == (host, path, rule)
        assert out[i]["verdict"] == verdict or rule is None


def test_features(spark):
    df = spark.createDataFrame([("http://a-b.c.org/x/y1?p=1&&q#f",), ("",)], "url string")
    host, path = urls.host_and_path(df["url"])
    full, empty = urls.lexical(df.withColumns({"host": host, "path": path})).collect()
    url = full["url"]
    shares = [url.count(c) / len(url) for c in set(url)]
    assert full["entropy"] == pytest.approx(-sum(p * math.log2(p) for p in shares))
    assert full["digit_ratio"] == pytest.approx(2 / len(url))
    named = ["url_length", "path_depth", "hyphens", "parameters", "query_length", "host_labels"]
    assert [full[k] for k in named] == [len(url), 2, 1, 2, 6, 3]
    assert (full["domain"], full["tld"]) == ("c.org", "org")
    assert [empty[k] for k in named] == [0, 0, 0, 0, 0, 1] and empty["entropy"] == 0


def slow_trees(rows, cuts, rounds, depth, rate, penalty, least):
    """Margins of boosting by exhaustive search over the same cuts."""
    y = [r[-1] for r in rows]
    margin = [math.log((sum(y) + 0.5) / (len(y) - sum(y) + 0.5))] * len(rows)

    def grow(members, level, g, h):
        total = sum(g[i] for i in members), sum(h[i] for i in members)
        best, chosen = 1e-6, None
        for f in range(len(cuts)) if level < depth else ():
            for cut in cuts[f]:
                low = [i for i in members if rows[i][f] <= cut]
                a, b = sum(g[i] for i in low), sum(h[i] for i in low)
                if not low or len(low) == len(members) or min(b, total[1] - b) < least:
                    continue
                gain = a * a / (b + penalty) + (total[0] - a) ** 2 / (total[1] - b + penalty)
                gain -= total[0] ** 2 / (total[1] + penalty)
                if gain > best + 1e-9:
                    best, chosen = gain, (low, [i for i in members if rows[i][f] > cut])
        if chosen is None:
            return {i: rate * total[0] / (total[1] + penalty) for i in members}
        return grow(chosen[0], level + 1, g, h) | grow(chosen[1], level + 1, g, h)

    for _ in range(rounds):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        steps = grow(range(len(rows)), 0, [a - b for a, b in zip(y, p)], [b * (1 - b) for b in p])
        margin = [m + steps[i] for i, m in enumerate(margin)]
    return margin


def test_trees_equal_exhaustive_boosting(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(250):
        a, b, c = rng.randrange(9), rng.random(), rng.randrange(3)
        rows.append((float(a), b, float(c), int(rng.random() < (0.9 if (a > 4) == (b > 0.5) else 0.1))))
    df = spark.createDataFrame(rows, "a double, b double, c double, label int").repartition(2)
    model = urls.fit_trees(df, ["a", "b", "c"], rounds=4, bins=16)
    edges = df.selectExpr(*[
        f"percentile_approx({f}, array({', '.join(str(i / 16) for i in range(1, 16))}), 10000)" for f in "abc"
    ]).first()
    want = slow_trees(rows, [sorted(set(e)) for e in edges], 4, 3, 0.3, 1.0, 1.0)
    out = df.select("a", "b", "c", "label", model.margin().alias("m")).collect()
    assert sorted(round(r["m"], 6) for r in out) == sorted(round(m, 6) for m in want)
    assert sum((r["m"] > 0) == bool(r["label"]) for r in out) > 0.8 * len(rows)


def test_trees_learn_a_bad_suffix(spark):
    rng = random.Random(6)
    rows = []
    for i in range(600):
        bad = rng.random() < 0.5
        host = f"site{rng.randrange(30)}.{'badhost' if bad else 'finehost'}.org"
        rows.append((i, f"http://{host}/p{rng.randrange(99)}", int(bad) if i < 400 else None))
    rows += rows[:5]
    df = spark.createDataFrame(rows, "page_id bigint, url string, label int").repartition(3)
    out = urls.judge(df, []).collect()
    assert len(out) == len(rows)
    assert all((r["verdict"] == "block") == ("badhost" in r["host"]) for r in out)


def test_no_labels_and_no_rows(spark):
    df = spark.createDataFrame([(1, "http://a.org/x", None)], "page_id bigint, url string, label int")
    assert [r["verdict"] for r in urls.judge(df, URL_RULES).collect()] == ["allow"]
    assert urls.judge(df.limit(0), URL_RULES).collect() == []
    with pytest.raises(ValueError):
        urls.apply_rules(df, [("allow", f"{i}.com/") for i in range(1_001)])
