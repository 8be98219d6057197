"""The map-only steps on streaming frames, and the row analysis per micro-batch.

Detection and masking keep no state and need no watermark: a row is complete
when it arrives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from veilspark import constants as K
from veilspark.operators.detect import detect, entity_rows
from veilspark.operators.mask import mask
from veilspark.operators.risk import row_risk


def _start(frame: DataFrame, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    return (
        frame.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def detect_stream(
    stream: DataFrame, key: str, path: str, checkpoint: str, trigger: dict | None = None, **options
) -> StreamingQuery:
    """Append the detections of every arriving row to a Parquet table."""
    found = detect(stream, key, **options)
    return _start(found, path, checkpoint, trigger or {"availableNow": True})


def mask_stream(
    stream: DataFrame, key: str, path: str, checkpoint: str, trigger: dict | None = None, **options
) -> StreamingQuery:
    """Append the masked rows to a Parquet table."""
    masked = mask(stream, key, **options)
    return _start(masked, path, checkpoint, trigger or {"availableNow": True})


def risk_stream(
    stream: DataFrame, key: str, path: str, checkpoint: str, window: int = K.WINDOW,
    trigger: dict | None = None, **options,
) -> StreamingQuery:
    """Append the row risks; one directory per batch, so a replayed batch overwrites itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        risks = row_risk(entity_rows(batch, key, **options), window)
        risks.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
