"""Metrics of running streams as rows of a table, one per micro-batch and query."""

from __future__ import annotations

import json
import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from crmflow.sources.staged import Files


class StreamMetrics(StreamingQueryListener):
    """Writes what every progress report says to ``path``, a JSON table; queries of one session stay apart by id.

    A row has query, run and batch id, the query's name, its rows and rates, the time each step took, the watermark,
    rows that state operators dropped as too late, and what the query observes under its names. A batch that is
    reported again replaces its row. Ends of queries are rows too, with the error if there was one.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._files = Files(spark, path)

    def _store(self, row: dict) -> None:
        self._files.write(json.dumps(row, default=str) + "\n", f"{row['query_id']}-{row['batch_id']}.json")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._store({
            "query_id": str(p.id), "run_id": str(p.runId), "name": p.name, "batch_id": p.batchId, "at": p.timestamp,
            "rows": p.numInputRows, "rows_per_second": p.processedRowsPerSecond, "milliseconds": dict(p.durationMs),
            "watermark": dict(p.eventTime).get("watermark"),
            "dropped_late": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
            "observed": {name: row.asDict() for name, row in p.observedMetrics.items()},
        })

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._store({"query_id": str(event.id), "run_id": str(event.runId), "batch_id": "end", "rows": 0, "error": event.exception})

    def rows(self) -> list[dict]:
        """All stored rows; a helper for a few queries, the table itself is read by Spark."""
        return [json.loads(self._files.read(name)) for name in self._files.names() if name.endswith(".json")]

    def wait(self, ended: int, seconds: float = 30) -> list[dict]:
        """Rows once so many queries have ended: reports come a little after the work."""
        until = time.monotonic() + seconds
        while time.monotonic() < until and sum(r["batch_id"] == "end" for r in self.rows()) < ended:
            time.sleep(0.2)
        return self.rows()
