"""The frame aligner on keyed state: a source's open buckets in maps, closed by its own clock, late rows kept.

State of a source: the latest time seen, and for each open bucket the last message of each feature, its number of messages
and whether its frame has left. A source's open buckets are read once a batch, and only those that changed and stay open are
written, each once: traffic with the store grows with open buckets, not with messages or cells. At the end of a batch

* a frame leaves when all required features are there (with none required, at its first message): complete;
* a bucket is closed when the source's latest time has passed its window: its frame leaves if it hasn't yet.

A row is late if its bucket's frame had left, or its bucket had been closed, before its batch began. Late rows aren't
dropped: they come out as rows of their own kind, so that frames and late rows together hold every message. What is late
depends on how messages fall into batches, not on their order inside one.

A message without a feature ends its source: what is open leaves. A source that has been silent for `idle_ms` is ended
likewise by a timer; with `ttl_ms`, Spark forgets buckets that haven't been written for that long.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from framelake.functions.clock import interval_ns
from framelake.operators.align import bucketed
from framelake.shipping import ship

FRAME, LATE = "frame", "late"
OUT = "source long, kind string, bucket_ns long, features array<string>, data array<array<float>>, n_messages long, complete boolean, seq long, log_time_ns long"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Aligner(StatefulProcessor):
    def __init__(self, required: list[str], window_ns: int, idle_ms: int | None, ttl_ms: int | None):
        self.required, self.window, self.idle, self.ttl = frozenset(required), window_ns, idle_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.clock = handle.getValueState("clock", "latest long")
        self.buckets = handle.getMapState("buckets", "bucket long", "n long, gone boolean, features array<string>, seqs array<long>, data array<array<float>>", self.ttl)

    def _latest(self) -> int | None:
        found = self.clock.get()
        return found[0] if found else None

    def _open(self) -> dict[int, list]:
        """Bucket -> [number of messages, whether its frame has left, {feature: (seq, data)}], in one exchange with the store."""
        return {b: [n, gone, dict(zip(features, zip(seqs, data, strict=True), strict=True))] for (b,), (n, gone, features, seqs, data) in self.buckets.iterator()}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        source, before, held, ended = int(key[0]), self._latest(), self._open(), False
        out, latest, known, changed = [], before, set(held), set()
        closed = {b for b, own in held.items() if own[1]}
        for batch in rows:
            columns = [batch[c].tolist() for c in ("bucket_ns", "feature", "seq", "log_time_ns", "data")]
            for b, feature, seq, ns, data in zip(*columns, strict=True):
                if feature is None or feature != feature:
                    ended = True
                    continue
                latest = ns if latest is None else max(latest, ns)
                data = [float(x) for x in data]
                if b in closed or (before is not None and b + self.window <= before):
                    out.append((source, LATE, b, [feature], [data], 1, False, seq, ns))
                    continue
                own = held.setdefault(b, [0, False, {}])
                own[0] += 1
                changed.add(b)
                if feature not in own[2] or own[2][feature][0] <= seq:
                    own[2][feature] = (seq, data)
        if latest is not None and latest != before:
            self.clock.update((latest,))
        yield from self._due(source, latest, ended, out, held, known, changed)
        if self.idle is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if not ended:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle)

    def _due(self, source: int, latest: int | None, ended: bool, out: list[tuple], held: dict[int, list], known: set[int], changed: set[int]) -> Iterator[pd.DataFrame]:
        """Frames that are complete or closed, oldest first, with the rows in out; then what has changed of open buckets is kept."""
        for bucket, own in sorted(held.items()):
            n, gone, cells = own
            complete = self.required <= set(cells)
            closed = ended or (latest is not None and bucket + self.window <= latest)
            if not gone and (complete or closed):
                names = sorted(cells)
                out.append((source, FRAME, bucket, names, [list(cells[f][1]) for f in names], n, complete, None, None))
                own[1] = True
                changed.add(bucket)
            if closed:
                if bucket in known:
                    self.buckets.removeKey((bucket,))
            elif bucket in changed:
                self.buckets.updateValue((bucket,), (n, own[1], list(cells), [q for q, _ in cells.values()], [d for _, d in cells.values()]))
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")]).astype({"seq": "Int64", "log_time_ns": "Int64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._open()
        yield from self._due(int(key[0]), self._latest(), True, [], held, set(held), set())

    def close(self) -> None:
        pass


def aligned(
    messages: DataFrame, fps: int, required: list[str], window_frames: int = 3, mode: str = "floor", interval: int | None = None, idle_ms: int | None = None, ttl_ms: int | None = None
) -> DataFrame:
    """Stream of messages(source, feature, seq, log_time_ns, data) -> stream of OUT: frames, and late rows with their seq and time.

    Per-feature data is in feature order; of a feature's messages the one with the highest seq counts. State needs the
    session's store to be RocksDB (`with_state`). With idle_ms or ttl_ms Spark keeps running batches for what time alone may
    change, so that a query of an availableNow trigger doesn't end.
    """
    ship(messages.sparkSession)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the driver's own worker may not find the package
    step = interval or interval_ns(fps)
    cut = bucketed(messages, interval=step, mode=mode).select("source", "bucket_ns", "feature", "seq", "log_time_ns", "data")
    processor = Aligner(required, window_frames * step, idle_ms, ttl_ms)
    timed = idle_ms is not None or ttl_ms is not None
    return cut.groupBy("source").transformWithStateInPandas(processor, OUT, "append", "ProcessingTime" if timed else "None")


def with_state(writer):
    """A stream writer's query, started with state in RocksDB; the session's own setting stays as it was."""
    conf, name = writer._spark.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, STORE)
    try:
        return writer.start()
    finally:
        conf.set(name, before) if before else conf.unset(name)


def ends(messages: DataFrame) -> DataFrame:
    """For each source, the message that ends it."""
    empty = {c: F.lit(None).cast(messages.schema[c].dataType).alias(c) for c in messages.columns if c != "source"}
    empty["seq"], empty["log_time_ns"] = F.lit(-1).cast("long").alias("seq"), F.lit(0).cast("long").alias("log_time_ns")
    return messages.select("source").distinct().select(*[F.col("source") if c == "source" else empty[c] for c in messages.columns])
