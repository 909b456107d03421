"""Live alarms whose keys may fall silent: periods without data are closed by event-time timers.

:func:`quotelens.streaming.live.alarm_stream` fills a gap when the next data come. Here a key has a
timer for the end of its next period, so once the watermark has passed it the period is closed,
with data or without, and an endpoint that stops answering goes on having states.
"""

import numpy as np
from pyspark.sql.streaming import StatefulProcessor

from .live import STATE_STORE

POLICIES = ("notBreaching", "missing", "ignore", "breaching")
FRAME = 100_000  # periods made at once
STATES = np.array(["OK", "ALARM"], object)


def watched_alarm(means, seconds=300, n=1, m=1, missing="notBreaching", key="metric", most=None, retire=None):
    """Alarm states per key from closed periods (key, period, mean, breach), silent ones included.

    ``missing`` says what a period without data does: nothing (``notBreaching``), keep the state
    (``missing``, ``ignore``) or count as a breach (``breaching``). One call emits all closed periods
    of a key, in frames of a bounded size. With ``most`` it emits at most that many; what is left
    waits in the state for the next call, and at the end of a query that runs over what is available
    for its next run. After ``retire`` periods in a row without data a key is forgotten, so that
    the state does not grow with every endpoint there ever was; by default none is.

    ``means`` has a watermark; rows that are not after the last closed period are late and skipped.
    Periods begin at multiples of ``seconds``. The session needs the RocksDB state store.
    """
    if missing not in POLICIES:
        raise ValueError(f"unknown policy for missing data: {missing}")
    if means.sparkSession.conf.get(STATE_STORE[0], "") != STATE_STORE[1]:
        raise ValueError(f"set {STATE_STORE[0]} to {STATE_STORE[1]}")
    return (
        means.select(key, "period", "mean", "breach")
        .groupBy(key)
        .transformWithStateInPandas(
            WatchedAlarm(key, seconds, n, m, missing, most, retire),
            f"{key} string, period timestamp, mean double, state string",
            "Append",
            "EventTime",
        )
    )


class WatchedAlarm(StatefulProcessor):
    """Advances one key's alarm period by period, as data and the watermark allow."""

    def __init__(self, key, seconds, n, m, missing, most, retire):
        self.key, self.seconds, self.n, self.m = key, seconds, n, m
        self.missing, self.most, self.retire, self.frame = missing, most, retire, FRAME

    def init(self, handle):
        self.handle = handle
        self.memory = handle.getValueState(
            "alarm", "flags array<boolean>, state string, last bigint, silent int, timer bigint"
        )
        self.waiting = handle.getMapState("waiting", "period bigint", "mean double, breach boolean")

    def handleInputRows(self, key, rows, timerValues):
        parts = [
            (
                frame["period"].to_numpy().astype("datetime64[s]").astype(np.int64),
                frame["mean"].to_numpy(np.float64),
                frame["breach"].eq(True).to_numpy(bool),
            )
            for frame in rows
        ]
        yield from self._advance(key, timerValues, parts)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._advance(key, timerValues, [])

    def _waiting(self, parts, last):
        """Times, means and breaches in order of time; of a time that comes twice the later row."""
        kept = [(k[0], *v) for k, v in self.waiting.iterator()]
        times, means, breaches = (np.array(x, t) for x, t in zip(zip(*kept) if kept else ((),) * 3, (np.int64, float, bool)))
        if parts:
            new = [np.concatenate(x) for x in zip(*parts)]
            if last is not None:
                new = [x[new[0] > last] for x in new]
            times, means, breaches = (np.concatenate(x) for x in zip((times, means, breaches), new))
        times, at = np.unique(times[::-1], return_index=True)
        return {k[0] for k in kept}, times, means[::-1][at], breaches[::-1][at]

    def _advance(self, key, timer_values, parts):
        """Periods that are closed by now, and a timer for the one after them."""
        import pandas as pd

        s = self.seconds
        flags, state, last, silent, timer = self.memory.get() or ([], "OK", None, 0, None)
        flags, alarm = np.array(flags[-self.n :], bool), state == "ALARM"
        kept, times, means, breaches = self._waiting(parts, last)
        left = np.ones(len(times), bool)
        watermark = timer_values.getCurrentWatermarkInMs() or 0
        closed = max([watermark // 1000 // s * s - s, *times[-1:].tolist()])
        at = last + s if last is not None else int(times[0]) if len(times) else closed + s
        open_to, gone = self.most, False
        while at <= closed and open_to != 0 and not gone:
            size = min((closed - at) // s + 1, self.frame, self.frame if open_to is None else open_to)
            place, off = np.divmod(times - at, s)
            mine = np.flatnonzero((off == 0) & (place >= 0) & (place < size))
            place = place[mine]
            left[mine] = False
            mean, breach, told = np.full(size, np.nan), np.full(size, self.missing == "breaching"), np.zeros(size, bool)
            mean[place], breach[place], told[place] = means[mine], breaches[mine], True
            number = np.arange(size)
            heard = np.maximum.accumulate(np.where(told, number, -1))
            quiet = np.where(heard < 0, silent + 1 + number, number - heard)
            if self.retire is not None and not left.any():
                ends = np.flatnonzero((quiet >= self.retire) & (number >= place.max(initial=0)))
                if len(ends):
                    size, gone = int(ends[0]) + 1, True
            flags = np.concatenate([np.zeros(self.n - len(flags), bool), flags, breach[:size]])
            total = np.cumsum(flags)
            alarms = total[self.n :] - total[:size] >= self.m
            if self.missing in ("missing", "ignore"):  # a silent period keeps the state before it
                before = heard[:size]
                alarms = np.where(before < 0, alarm, alarms[before])
            yield pd.DataFrame(
                {
                    self.key: key[0],
                    "period": (at + s * number[:size]).astype("datetime64[s]").astype("datetime64[ns]"),
                    "mean": mean[:size],
                    "state": STATES[alarms.astype(int)],
                }
            )
            flags, alarm, silent = flags[-self.n :], bool(alarms[-1]), int(quiet[size - 1])
            last = at + s * (size - 1)
            at = last + s
            open_to = None if open_to is None else open_to - size
        waits = set(times[left].tolist())
        for done in kept - waits:
            self.waiting.removeKey((done,))
        for i in np.flatnonzero(left).tolist():
            if int(times[i]) not in kept:
                self.waiting.updateValue((int(times[i]),), (float(means[i]), bool(breaches[i])))
        if timer is not None:
            self.handle.deleteTimer(timer)
        if gone:
            self.memory.clear()
        elif last is not None:
            # The next period ends at last + 2 s; what is left over goes on at once.
            timer = (last + 2 * s) * 1000 - 1
            self.handle.registerTimer(timer)
            self.memory.update((flags.tolist(), str(STATES[int(alarm)]), last, silent, timer))

    def close(self):
        pass
