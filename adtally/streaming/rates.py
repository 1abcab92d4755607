"""Rows per batch of running streams."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql.streaming.listener import StreamingQueryListener


class BatchRows(StreamingQueryListener):
    """How many rows each batch of each query read, to see whether limits hold: ``rows[query id][batch id]``.

    Register it with ``spark.streams.addListener``. It keeps the ``most`` newest batches of a query.
    """

    def __init__(self, most: int = 1000):
        self.rows: dict[str, dict[int, int]] = defaultdict(dict)
        self.most = most

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        batches = self.rows[str(event.progress.id)]
        batches[event.progress.batchId] = max(event.progress.numInputRows, batches.get(event.progress.batchId, 0))
        while len(batches) > self.most:
            del batches[min(batches)]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
