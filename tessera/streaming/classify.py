"""Additions beyond the inventory: a stateless stream classifier and windowed counts of run events."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import knn


def classify_stream(asks: DataFrame, refs: DataFrame, path: str, checkpoint: str, **vote):
    """Classifies each micro-batch against fixed references, packed once, and appends it to ``path``; the batch id makes a retry overwrite its own output."""
    settings, index = knn.resolve_vote(**vote), knn.packed(refs)

    def each(batch: DataFrame, batch_id: int) -> None:
        near = knn.neighbours(batch, index, settings["adaptive_k"] or settings["k"])
        knn.classify(near, **settings).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return asks.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_events(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events by window and type; works on streams (with a watermark) and on tables."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    return e.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value")).select(F.col("w.start").alias("start"), "event_type", "n", "value")
