"""Progress of streaming queries as events and rows."""

from __future__ import annotations

from pyspark.sql.streaming import StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    """Keeps the last `most` events: (kind, query, batch, rows in, rows dropped as late, rows of state)."""

    def __init__(self, most: int = 1000):
        self.most, self.events = most, []

    def _add(self, *event) -> None:
        self.events = [*self.events[-self.most + 1 :], event]

    def onQueryStarted(self, event) -> None:
        self._add("started", str(event.id), -1, 0, 0, 0)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        self._add("progress", str(p.id), p.batchId, p.numInputRows, late, sum(s.numRowsTotal for s in p.stateOperators))

    def onQueryIdle(self, event) -> None:
        self._add("idle", str(event.id), -1, 0, 0, 0)

    def onQueryTerminated(self, event) -> None:
        self._add("error" if event.exception else "completed", str(event.id), -1, 0, 0, 0)

    def peak_state(self) -> int:
        """The most rows of state that any batch left behind."""
        return max((e[5] for e in self.events), default=0)

    def late(self) -> int:
        """Rows that were dropped behind the watermark."""
        return sum(e[4] for e in self.events)
