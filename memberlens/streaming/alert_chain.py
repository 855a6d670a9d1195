"""L16 -> L17 -> L19 in one streaming query: two chained stateful operators.

* ``lifecycle`` is keyed by (alertname, labels).  It holds evaluations back until
  the watermark has passed them, takes them in event-time order and gives the
  hold state of each (L16) and the firing / resolved changes (L17).  A series that
  vanishes while it fires is resolved by an event-time timer.
* ``notifications`` is keyed by (alertname, severity) and reads the first one's
  firing rows: a notification at the first alert of a repeat interval, and the
  interval's totals when it is over (L19).

Both are ``transformWithStateInPandas`` in append mode.  Rows leave the first
operator only when the watermark W has passed their evaluation, so they carry W
as their event time (``emitted``) and the second operator, which runs under the
same watermark, has every alert before W when its timer for W expires.  Held rows
lie in list state: a batch appends to it and does not rewrite it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.scalar import epoch_us, from_epoch_us
from .streams import run_append

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

LIFECYCLE_OUT = ("alertname string, severity string, labels string, at_us bigint, since_us bigint, "
                 "state string, status string, emitted timestamp")
NOTIFY_OUT = ("alertname string, severity string, receiver string, kind string, notify_us bigint, "
              "n_alerts bigint, labels array<string>, emitted timestamp")


@contextmanager
def rocksdb_state(spark: SparkSession):
    """State store of the queries started inside: the stateful processors need RocksDB."""
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(key, old)


def _timer_ms(us: int) -> int:
    """First whole millisecond after ``us``: a watermark there has passed it."""
    return us // 1000 + 1


class Lifecycle(StatefulProcessor):
    """Hold and transitions of one (alertname, labels); ``step_s`` as in
    ``operators.monitoring.hold``.  A series is forgotten one step after its last
    evaluation, as a later one starts anew anyway."""

    def __init__(self, step_s: float):
        self.step = int(step_s * 1e6)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "at_us bigint, condition boolean, hold_s double, severity string")
        # since_us: first true evaluation of the running island, null outside one
        self.series = handle.getValueState("series", "last_us bigint, since_us bigint, firing boolean, severity string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for p in rows:
            p = p[p["at_us"].notna()]
            if key[0] is None or p.empty:
                continue
            self.held.appendList(list(zip(p["at_us"].astype("int64").tolist(), p["condition"].astype(bool).tolist(),
                                          p["hold_s"].astype(float).tolist(), p["severity"].tolist())))
            self.handle.registerTimer(_timer_ms(int(p["at_us"].min())))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        w_ms = timerValues.getCurrentWatermarkInMs()
        held = sorted(self.held.get() if self.held.exists() else (), key=lambda r: r[0])
        ready = [r for r in held if r[0] < w_ms * 1000]
        rest = held[len(ready):]
        last, since, firing, severity = self.series.get() if self.series.exists() else (None, None, False, None)
        out = []
        if ready:
            out, last, since, firing, severity = self._walk(ready, last, since, firing, severity)
            if rest:
                self.held.put(rest)
                self.handle.registerTimer(_timer_ms(rest[0][0]))
            else:
                self.held.clear()
        if last is not None and last + self.step < w_ms * 1000:          # the next evaluation did not come
            if firing:
                out.append((severity, last + self.step, None, None, "resolved"))
            self.series.clear()
        elif ready:
            self.series.update((last, since, firing, severity))
            self.handle.registerTimer(_timer_ms(last + self.step))
        if out:
            p = pd.DataFrame(out, columns=["severity", "at_us", "since_us", "state", "status"])
            p.insert(0, "alertname", key[0])
            p.insert(2, "labels", key[1])
            p["since_us"] = p["since_us"].astype("Int64")
            yield p.assign(emitted=pd.Timestamp(w_ms, unit="ms"))

    def _walk(self, ready, last, since, firing, severity):
        """Rows (severity, at, since, state, status) of evaluations in order."""
        out = []
        for at, on, hold_s, sev in ready:
            if last is not None and at - last > self.step:               # evaluations are missing
                if firing:
                    out.append((severity, last + self.step, None, None, "resolved"))
                since, firing = None, False
            since = (at if since is None else since) if on else None
            fires = on and (at - since) / 1e6 >= hold_s
            status = "firing" if fires and not firing else "resolved" if firing and not fires else None
            if on or status:
                out.append((sev, at, since, "firing" if fires else "pending" if on else "inactive", status))
            last, firing, severity = at, fires, sev
        return out, last, since, firing, severity

    def close(self) -> None:
        pass


class Notifications(StatefulProcessor):
    """Notifications of one (alertname, severity): the rule of
    ``operators.monitoring.route_alerts``.  An alert at least the repeat interval
    after a notification starts the next one, so an interval's alerts all lie
    within it and its totals are known when the watermark has passed its end."""

    def __init__(self, receivers: dict[str, tuple[str, int]], default: tuple[str, int]):
        self.receivers, self.default = receivers, default

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "at_us bigint, labels string")
        self.open = handle.getValueState("open", "notify_us bigint, n_alerts bigint, labels array<string>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for p in rows:
            if len(p):
                self.held.appendList(list(zip(p["at_us"].astype("int64").tolist(), p["labels"].tolist())))
        self.handle.registerTimer(max(timerValues.getCurrentWatermarkInMs() - 1, 0))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        w_ms = timerValues.getCurrentWatermarkInMs()
        receiver, repeat_s = self.receivers.get(key[1], self.default)
        repeat = repeat_s * 1_000_000
        alerts = sorted(self.held.get() if self.held.exists() else (), key=lambda r: r[0])
        self.held.clear()
        began, n, labels = self.open.get() if self.open.exists() else (None, 0, [])
        labels, out, t, i = set(labels), [], np.array([a[0] for a in alerts], dtype="int64"), 0
        while i < len(t) or (began is not None and began + repeat <= w_ms * 1000):
            if began is None:
                began, n, labels = int(t[i]), 0, set()
                same = int(t.searchsorted(began, side="right"))
                out.append(("notify", began, same - i, sorted({a[1] for a in alerts[i:same] if a[1] is not None})))
            end = int(t.searchsorted(began + repeat))
            n, labels = n + end - i, labels | {a[1] for a in alerts[i:end] if a[1] is not None}
            i = end
            if i < len(t) or began + repeat <= w_ms * 1000:
                out.append(("closed", began, n, sorted(labels)))
                began = None
            else:
                break
        if began is None:
            self.open.clear()
        else:
            self.open.update((began, n, sorted(labels)))
            self.handle.registerTimer((began + repeat + 999) // 1000)
        if out:
            p = pd.DataFrame(out, columns=["kind", "notify_us", "n_alerts", "labels"])
            p.insert(0, "alertname", key[0])
            p.insert(1, "severity", key[1])
            p.insert(2, "receiver", receiver)
            yield p.assign(emitted=pd.Timestamp(w_ms, unit="ms"))

    def close(self) -> None:
        pass


def lifecycle(evals: DataFrame, step_s: float, t: str = "eval_time") -> DataFrame:
    """L16 + L17 (stream): ``evals`` (alertname, labels, severity, ``t``, condition,
    hold_s; watermarked on ``t``) to one row per pending or firing evaluation and per
    change.  ``state`` is the hold state, null for a resolution by timer; ``status``
    is null unless the alert starts to fire or resolves there."""
    e = evals.select("alertname", "labels", "severity", t, epoch_us(t).alias("at_us"),
                     F.coalesce("condition", F.lit(False)).alias("condition"), F.col("hold_s").cast("double").alias("hold_s"))
    return e.groupBy("alertname", "labels").transformWithStateInPandas(
        statefulProcessor=Lifecycle(step_s), outputStructType=LIFECYCLE_OUT, outputMode="Append",
        timeMode="EventTime", eventTimeColumnName="emitted")


def notifications(states: DataFrame, receivers: dict[str, tuple[str, int]], default: tuple[str, int]) -> DataFrame:
    """L19 (stream) on the firing rows of ``lifecycle``: a row ``notify`` at once, with the
    alerts of that evaluation, and a row ``closed`` with all alerts of the interval."""
    firing = states.where("state = 'firing'").select("alertname", "severity", "labels", "at_us", "emitted")
    return firing.groupBy("alertname", "severity").transformWithStateInPandas(
        statefulProcessor=Notifications(receivers, default), outputStructType=NOTIFY_OUT, outputMode="Append",
        timeMode="EventTime", eventTimeColumnName="emitted")


def run_chain(df: DataFrame, tag: str, base: str | None = None) -> DataFrame:
    """Run a chain to completion in append mode and read its rows back, times as timestamps."""
    with rocksdb_state(df.sparkSession):
        out = run_append(df, tag, base)
    for c in [c for c in out.columns if c.endswith("_us")]:
        out = out.withColumn(c, from_epoch_us(c)).withColumnRenamed(c, {"at_us": "eval_time", "since_us": "active_since"}.get(c, c[:-3] + "_time"))
    return out
