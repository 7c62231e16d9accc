"""What a stream says of its own messages while it runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

#: Name under which the numbers of a batch are reported.
READ = "messages_read"


def observed(articles: DataFrame) -> DataFrame:
    """The stream as it is, with the numbers of each batch reported on the side: messages, those
    whose value could not be read, and the span of their times. Nothing is counted twice."""
    unreadable = F.col("source").isNull() & F.col("content").isNull()
    return articles.observe(
        READ,
        F.count(F.lit(1)).alias("messages"),
        F.count_if(unreadable).alias("unreadable"),
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
    )


class Account(StreamingQueryListener):
    """Keeps the reported numbers of all batches, one entry a batch, the last report counting.

    Add it with ``spark.streams.addListener``. It holds as many small rows as there were
    batches since the start, of which ``keep`` stay.
    """

    def __init__(self, keep: int = 10_000) -> None:
        self.keep = keep
        self.batches: dict[tuple[str, int], dict] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get(READ)
        if row is not None:
            self.batches[str(progress.id), progress.batchId] = row.asDict()
            while len(self.batches) > self.keep:
                self.batches.pop(next(iter(self.batches)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def total(self, name: str) -> int:
        return sum(b[name] for b in self.batches.values())
