"""One run of a topic at a time, as keyed state: changes that come during a run mark the topic, and one more run follows it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STARTS = "schema string, topic string, run int, at timestamp, why string"
COLUMNS = [c.split()[0] for c in STARTS.split(", ")]
#: Events of a topic that are followed at a time.
EVENTS = 65_536
#: Keyed state needs this state store.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class OneRun(StatefulProcessor):
    """A topic is idle, running, or running and marked; a run that isn't reported done within the limit is taken as lost and started anew."""

    def __init__(self, limit_seconds: int):
        self.limit_ms = 1000 * limit_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("run", "number int, running boolean, marked boolean")

    def _time(self, started_ms: int | None) -> None:
        """The one timer of a topic: of its run's start, or none."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if started_ms is not None:
            self.handle.registerTimer(started_ms + self.limit_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = [(p["at"].to_numpy("datetime64[us]").astype(np.int64), (p["kind"] != "done").to_numpy()) for p in rows]
        at, change = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((change, at))
        number, running, marked = self.state.get() if self.state.exists() else (0, False, False)
        started, was_running = None, running
        for low in range(0, len(order), EVENTS):
            some, out = order[low : low + EVENTS], []
            for at_ms, changed in zip((at[some] // 1000).tolist(), change[some].tolist()):
                if changed and running:
                    marked = True
                elif changed or (running and marked):
                    why = "changed" if changed else "changed meanwhile"
                    number, running, marked, started = number + 1, True, False, at_ms
                    out.append((*key, number, pd.Timestamp(at_ms, unit="ms"), why))
                else:
                    running = False
            yield pd.DataFrame(out, columns=COLUMNS)
        # State and timer are told once what the rows came to, as each call goes to the state store and back.
        self.state.update((number, running, marked))
        if started is not None or (was_running and not running):
            self._time(started if running else None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        number, running, _ = self.state.get()
        out = []
        if running:
            at_ms = expiredTimerInfo.getExpiryTimeInMs()
            self.state.update((number + 1, True, False))
            self._time(at_ms)
            out.append((*key, number + 1, pd.Timestamp(at_ms, unit="ms"), "lost"))
        yield pd.DataFrame(out, columns=COLUMNS)

    def close(self) -> None:
        pass


def runs_to_start(events: DataFrame, late: str = "1 hour", limit_seconds: int = 6 * 3600) -> DataFrame:
    """(schema, topic, run, at, why): the runs to start, from a stream of (schema, topic, kind, at) with kind `change` or `done`.

    At equal times a run's end counts before a change. Events later than `late` behind the newest are dropped by the watermark.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    keyed = events.select("schema", "topic", "kind", "at").withWatermark("at", late).groupBy("schema", "topic")
    return keyed.transformWithStateInPandas(OneRun(limit_seconds), STARTS, "Append", "EventTime")


def write_starts(starts: DataFrame, path: str, checkpoint: str) -> None:
    """Append the runs to start to a table, once each, until what is there now is done."""
    starts.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
