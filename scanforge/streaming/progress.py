"""Progress of a packet stream: one line per micro-batch."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

METRICS = "packets"


def observe_packets(packets: DataFrame, name: str = METRICS) -> DataFrame:
    """Count packets and payload bytes while they pass; costs no extra job."""
    return packets.observe(
        name,
        F.count(F.lit(1)).alias("n_packets"),
        F.coalesce(F.sum(F.octet_length("data").cast("bigint")), F.lit(0)).alias("n_bytes"),
    )


class ProgressLines(StreamingQueryListener):
    """Passes a line per micro-batch with data to ``emit``.

    ``attach`` binds it to one query, which must observe its packets under the name ``metrics``; it leaves the session when that
    query ends. Without it, the listener hears every query that observes under the plain name.
    """

    def __init__(self, emit: Callable[[str], None] = print):
        self.emit = emit
        self.total = 0
        self.metrics = METRICS
        self.spark: SparkSession | None = None
        self.query_id = None

    def attach(self, spark: SparkSession) -> ProgressLines:
        self.spark, self.metrics = spark, f"{METRICS}_{uuid.uuid4().hex}"
        spark.streams.addListener(self)
        return self

    def detach(self) -> None:
        if self.spark is not None:
            spark, self.spark = self.spark, None
            spark.streams.removeListener(self)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        row = event.progress.observedMetrics.get(self.metrics)
        if row is not None:
            self.query_id = event.progress.id
            if row["n_packets"]:
                self.total += row["n_packets"]
                self.emit(
                    f"batch {event.progress.batchId}: {row['n_packets']} packets, {row['n_bytes']} bytes, "
                    f"{self.total} packets so far"
                )

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if self.query_id == event.id:
            self.detach()
