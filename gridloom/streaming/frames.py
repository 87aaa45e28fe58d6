"""Frames that keep arriving: slots in event time, and ingest of what a store lacks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.align import snapped_frames


def slot_stream(frames: DataFrame, late: str = "10 minutes", tolerance: int = 120) -> DataFrame:
    """(slot, cell_id, value) of a stream of frames (ts, cell_id, value): the nearest frame of each 5-minute slot.

    Shifted by half a slot, tumbling windows begin at the slots. Of equally near frames the later one counts, so batch
    and stream agree. A slot is given out when the watermark has passed it.
    """
    return slot_updates(frames, late, tolerance).drop("frame_time")


def slot_updates(frames: DataFrame, forget: str = "1 day", tolerance: int = 120) -> DataFrame:
    """(slot, cell_id, value, frame_time): slot_stream with the frame's own time, to be written in update mode.

    In update mode a slot is given out with the first batch that has a frame of it, and again with each later batch that has
    one, then with the nearest so far; so late frames correct what was given out before. Slots are remembered for forget
    behind the latest frame; what comes later still is dropped (ingest, which asks the store instead, drops nothing).
    """
    x = frames.withColumn("sts", F.col("ts") + F.expr("interval 150 seconds")).withWatermark("sts", forget)
    slot = F.timestamp_seconds((F.floor((F.unix_micros("ts") + 150_000_000) / 300_000_000) * 300).cast("long"))
    gap = F.abs(F.unix_micros("ts") - F.unix_micros(slot))
    x = x.withColumn("gap", gap).where(F.col("gap") <= tolerance * 1_000_000)
    best = F.min_by(F.struct("value", F.col("ts").alias("frame_time")), F.struct("gap", -F.unix_micros("ts"), "value"))
    out = x.groupBy(F.window("sts", "5 minutes").alias("w"), "cell_id").agg(best.alias("best"))
    return out.select(F.col("w.start").alias("slot"), "cell_id", "best.value", "best.frame_time")


def ingest(frames: DataFrame, write: Callable[[DataFrame], None], checkpoint: str, clean: Callable[[DataFrame], DataFrame] | None = None):
    """Run all that has arrived through slots and an upsert, once a batch; started again, it takes only what is new.

    What is written has the frames' own times as frame_time, so that an upsert by the nearest (Store.upsert) keeps a nearer
    frame of an earlier batch. Upserts are keyed, so that a batch that is repeated after a failure changes nothing.
    """

    def batch(df: DataFrame, _: int) -> None:
        write(snapped_frames((clean(df) if clean else df).withColumn("frame_time", F.col("ts"))))

    return frames.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def follow(frames: DataFrame, write: Callable[[DataFrame], None], checkpoint: str, forget: str = "1 day", every: str | None = None):
    """Give slots and their corrections (slot_updates) to a keyed write, batch by batch.

    The slots' states hold the nearest frame so far, so the write may put a slot's row in place of the former one; a batch
    that is repeated after a failure changes nothing. every: how often ("1 minute"); without it, until all that has arrived is taken.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    out = slot_updates(frames, forget).writeStream.outputMode("update").foreachBatch(lambda df, _: write(df))
    return out.option("checkpointLocation", checkpoint).trigger(**trigger).start()
