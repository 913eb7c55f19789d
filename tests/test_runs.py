"""One run a topic at a time over several batches and restarts, and ranges by bytes."""

import datetime
import random

from pyspark.sql import functions as F

from stratalake.sources import readers
from stratalake.streaming import runs

T0 = datetime.datetime(2024, 1, 1)
EVENT = "schema string, topic string, kind string, at timestamp"


def starts_brute(events):
    """(topic, run, minute, why) of events (topic, kind, minute)."""
    state, out = {}, []
    for topic, kind, minute in sorted(events, key=lambda e: (e[2], e[1] != "done")):
        n, running, marked = state.get(topic, (0, False, False))
        if kind == "change":
            if running:
                marked = True
            else:
                n, running = n + 1, True
                out.append((topic, n, minute, "changed"))
        elif running:
            if marked:
                n, marked = n + 1, False
                out.append((topic, n, minute, "changed meanwhile"))
            else:
                running = False
        state[topic] = (n, running, marked)
    return sorted(out)


def test_one_run_at_a_time_over_batches_and_restarts(spark, tmp_path):
    rng = random.Random(6)
    events = [(f"t{rng.randrange(3)}", rng.choice(["change", "change", "done"]), m) for m in range(120)]
    source, out, state = (f"file://{tmp_path}/{n}" for n in ("in", "out", "state"))
    for part in (events[:50], events[50:51], events[51:]):
        rows = [("s", t, k, T0 + datetime.timedelta(minutes=m)) for t, k, m in part]
        spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(source)
        # Every part is a new query that goes on from the checkpoint.
        runs.write_starts(runs.runs_to_start(spark.readStream.schema(EVENT).parquet(source), "1 hour", 10**6), out, state)
    got = spark.read.schema(runs.STARTS).parquet(out).collect()
    assert sorted((r["topic"], r["run"], int((r["at"] - T0).total_seconds() // 60), r["why"]) for r in got) == starts_brute(events)


def test_a_lost_run_is_started_again(spark, tmp_path):
    source, out, state = (f"file://{tmp_path}/{n}" for n in ("in", "out", "state"))
    for minutes, topic, kind in ((0, "a", "change"), (300, "b", "change"), (301, "b", "done")):
        spark.createDataFrame([("s", topic, kind, T0 + datetime.timedelta(minutes=minutes))], EVENT).coalesce(1).write.mode("append").parquet(source)
        runs.write_starts(runs.runs_to_start(spark.readStream.schema(EVENT).parquet(source), "1 minute", 3600), out, state)
    got = {(r["topic"], r["run"]): r["why"] for r in spark.read.schema(runs.STARTS).parquet(out).collect()}
    assert got[("a", 1)] == "changed" and got[("a", 2)] == "lost" and got[("b", 1)] == "changed" and ("b", 2) not in got


def test_ranges_have_equal_bytes(spark):
    """A tenth of the keys has nearly all bytes, at one end, and null keys and later ones are not lost."""
    df = spark.range(20000).select(F.col("id").alias("k"), F.repeat(F.lit("x"), F.when(F.col("id") < 2000, 400 + F.col("id") % 7).otherwise(3).cast("int")).alias("body"))
    parts = readers.byte_ranges(df, "k", 8, 1)
    sizes = [df.filter(p).agg(F.sum(readers.row_bytes(df))).first()[0] for p in parts]
    assert len(parts) == 8 and max(sizes) <= 1.5 * sum(sizes) / 8
    assert sum(df.filter(p).count() for p in parts) == 20000
    more = df.union(spark.createDataFrame([(None, "x"), (10**9, "y"), (-5, "z")], "k long, body string"))
    assert sum(more.filter(p).count() for p in parts) == 20003
    assert readers.byte_ranges(df, "k", 8) == readers.byte_ranges(df, "body", 8, 1) == readers.byte_ranges(df.limit(0), "k", 8, 0) == ["1 = 1"]


def test_state_is_told_once_a_batch():
    """A topic's events come to the same runs in few calls of the state store, whatever their number."""
    import pandas as pd

    calls = []

    class Store:
        value, timers = None, []

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            calls.append("update")
            self.value = value

        def listTimers(self):
            calls.append("list")
            return iter(self.timers)

        def deleteTimer(self, timer):
            calls.append("delete")
            self.timers = [t for t in self.timers if t != timer]

        def registerTimer(self, at):
            calls.append("register")
            self.timers = [*self.timers, at]

    rng = random.Random(8)
    events = [("t", rng.choice(["change", "change", "done"]), m) for m in range(3000)]
    frame = pd.DataFrame([(T0 + datetime.timedelta(minutes=m), k) for _, k, m in events], columns=["at", "kind"])
    run = runs.OneRun(3600)
    run.handle = run.state = Store()
    parts = [run.handleInputRows(("s", "t"), iter([frame[a:b]]), None) for a, b in ((0, 1700), (1700, 3000))]
    got = [r for part in parts for f in part for r in f.itertuples(index=False)]
    assert [(r.topic, r.run, int((r.at - T0).total_seconds() // 60), r.why) for r in got] == starts_brute(events)
    assert len(calls) <= 10 and run.handle.timers == ([got[-1].at.value // 10**6 + 3600_000] if run.state.value[1] else [])
