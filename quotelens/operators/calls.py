"""Rows sent to a slow service: several calls at once in a task, with time limit, retries and rate."""

import threading
import time
from collections import deque
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import types as T

from .answers import typed_batches

_ROWS = 256


class Pace:
    """Lets at most ``rate`` calls a second start, evenly spaced; None sets no limit."""

    def __init__(self, rate):
        self.gap, self.next, self.lock = 1 / rate if rate else 0, 0.0, threading.Lock()

    def wait(self):
        if not self.gap:
            return
        with self.lock:
            start = max(time.monotonic(), self.next)
            self.next = start + self.gap
        time.sleep(max(0, start - time.monotonic()))


def within(fn, row, limit):
    """The result of one call, or ``TimeoutError`` after ``limit`` seconds.

    Python cannot stop a thread: a call past its limit is left behind and its result ignored.
    """
    if limit is None:
        return fn(row)
    done, box = threading.Event(), {}

    def run():
        try:
            box["result"] = fn(row)
        except BaseException as problem:
            box["problem"] = problem
        done.set()

    threading.Thread(target=run, daemon=True).start()
    if not done.wait(limit):
        raise TimeoutError(f"no answer in {limit} s")
    if "problem" in box:
        raise box["problem"]
    return box["result"]


def in_order(fn, rows, at_once, ahead):
    """Results in the order of ``rows``, ``at_once`` at work and ``ahead`` held at most."""
    pool, waiting = ThreadPoolExecutor(at_once), deque()
    try:
        for row in rows:
            if len(waiting) == ahead:
                yield waiting.popleft().result()
            waiting.append(pool.submit(fn, row))
        while waiting:
            yield waiting.popleft().result()
    finally:
        pool.shutdown(wait=False, cancel_futures=True)


def call_rows(df, service, schema, at_once=8, time_limit=60.0, retries=2, backoff=0.5, rate=None,
              retry_on=(Exception,)):
    """Each row sent to a service, with up to ``at_once`` calls open in a task.

    ``service()`` runs once in a task and returns the function that calls; open a client there. That
    function maps a dict to a dict with the fields of ``schema`` and is called from several threads.
    An error in ``retry_on`` or a call past ``time_limit`` seconds (None: no limit) is tried again up to
    ``retries`` times, after ``backoff`` seconds, doubled each time. ``rate`` bounds the calls a second
    that a task starts, so divide what the service allows by the number of tasks at once.

    Result: the input columns, those fields, ``status`` (ok, failed or timed_out, as the last attempt
    ended), ``attempts`` and ``error``; rows keep their order within a partition. A result without a
    field or of the wrong type is a failure and not tried again.

    A task holds its input batch and 4 x ``at_once`` results. Calls are at least once: a task that runs
    again, or twice by speculation, calls again. Null columns reach the function as None; repeated
    rows are called each; an empty table makes no call. Input columns must not have the names added.
    """
    if at_once < 1 or retries < 0:
        raise ValueError("at_once must be at least 1 and retries at least 0")
    added = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    names = [f.name for f in added.fields]
    marks = T._parse_datatype_string("status string, attempts int, error string")
    clash = set(df.columns) & {*names, *marks.names}
    if clash:
        raise ValueError(f"columns of the input have the names of results: {sorted(clash)}")
    out = T.StructType([*df.schema.fields, *added.fields, *marks.fields])

    def batches(record_batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow_schema, pace, fn = to_arrow_schema(out), Pace(rate), None

        def attempt(row):
            for attempts in range(1, retries + 2):
                pace.wait()
                try:
                    result = within(fn, dict(row), time_limit)
                except Exception as problem:
                    status = "timed_out" if isinstance(problem, TimeoutError) else "failed"
                    error = f"{type(problem).__name__}: {problem}"
                    if attempts > retries or not isinstance(problem, (TimeoutError, *retry_on)):
                        break
                    time.sleep(backoff * 2 ** (attempts - 1))
                    continue
                try:
                    values = {n: result[n] for n in names}
                except Exception as problem:
                    status, error = "failed", f"{type(problem).__name__}: {problem}"
                    break
                return {**row, **values, "status": "ok", "attempts": attempts, "error": None}
            empty = dict.fromkeys(names)
            return {**row, **empty, "status": status, "attempts": attempts, "error": error}

        def rows():
            nonlocal fn
            for batch in record_batches:
                fn = fn or service()
                yield from batch.to_pylist()

        held = []
        for row in in_order(attempt, rows(), at_once, 4 * at_once):
            held.append(row)
            if len(held) == _ROWS:
                yield from typed_batches(held, arrow_schema, names)
                held = []
        if held:
            yield from typed_batches(held, arrow_schema, names)

    return df.mapInArrow(batches, out)
