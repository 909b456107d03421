import threading
import time

import pytest
from hypothesis import given, settings, strategies as st

from quotelens.operators import calls


def sent(spark, rows, service, **settings):
    df = spark.createDataFrame(rows, "i int, text string").coalesce(1)
    return calls.call_rows(df, service, "n bigint", **settings).collect()


def test_slow_and_failing_calls_are_marked_in_order(spark):
    def service():
        tries = {}

        def call(row):
            i = row["i"]
            tries[i] = tries.get(i, 0) + 1
            if i == 2 or (i == 3 and tries[i] < 3):
                raise ConnectionError(f"busy {i}")
            if i == 4:
                raise KeyError("not tried again")
            if i == 5 or (i == 6 and tries[i] == 1):
                time.sleep(120)
            return {} if i == 7 else {"n": "text" if i == 8 else i * 10}

        return call

    rows = [(i, None if i % 2 else "t") for i in range(12)] + [(1, None)]
    got = sent(spark, rows, service, at_once=4, time_limit=4, backoff=0.01, retry_on=(ConnectionError,))
    assert [(r.i, r.text) for r in got] == rows
    marks = {r.i: (r.n, r.status, r.attempts, (r.error or "").split(":")[0]) for r in got}
    assert marks == {
        **{i: (i * 10, "ok", 1, "") for i in (0, 1, 9, 10, 11)},
        2: (None, "failed", 3, "ConnectionError"),
        3: (30, "ok", 3, ""),
        4: (None, "failed", 1, "KeyError"),
        5: (None, "timed_out", 3, "TimeoutError"),
        6: (60, "ok", 2, ""),
        7: (None, "failed", 1, "KeyError"),
        8: (None, "failed", 1, marks[8][3]),
    }


def test_time_follows_the_number_at_once(spark):
    def service():
        return lambda row: time.sleep(0.2) or {"n": 1}

    took = {}
    for at_once in (1, 16):
        start = time.monotonic()
        assert len(sent(spark, [(i, "") for i in range(64)], service, at_once=at_once)) == 64
        took[at_once] = time.monotonic() - start
    assert took[1] > 64 * 0.2 and took[16] < took[1] / 3


def test_rate_bounds_the_calls_started(spark):
    def service():
        return lambda row: {"n": time.monotonic_ns()}

    got = sent(spark, [(i, "") for i in range(21)], service, at_once=8, rate=20, time_limit=None)
    times = sorted(r.n for r in got)
    assert times[-1] - times[0] >= 0.9e9


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 40), st.integers(1, 5), st.integers(1, 9))
def test_no_more_than_asked_run_or_wait(n, at_once, ahead):
    lock, now, most, drawn = threading.Lock(), [0], [0], [0]

    def rows():
        for i in range(n):
            drawn[0] = i + 1
            yield i

    def work(i):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.0005 * (i % 3))
        with lock:
            now[0] -= 1
        return i

    for at, i in enumerate(calls.in_order(work, rows(), at_once, ahead)):
        assert at == i and drawn[0] <= i + ahead + 1
    assert most[0] <= at_once


def test_edges(spark):
    def service():
        return lambda row: {"n": len(row["text"])}

    assert sent(spark, [], service) == []
    long = sent(spark, [(1, "x" * 3_000_000), (1, None)], service, retries=0)
    assert [(r.n, r.status) for r in long] == [(3_000_000, "ok"), (None, "failed")]
    df = spark.createDataFrame([(1, "a")], "i int, status string")
    with pytest.raises(ValueError, match="status"):
        calls.call_rows(df, service, "n bigint")
    with pytest.raises(ValueError):
        calls.call_rows(df, service, "n bigint", at_once=0)
