"""Incremental runs with Structured Streaming.

Each micro-batch runs the batch job and replaces its own ``batch_id`` directory, so
a batch that is replayed after a failure leaves the tables as if it ran once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from folioflow.plans.ingest import ingest_items
from folioflow.plans.transform import processed_objects, processed_records, transform_job
from folioflow.scale import materialise, row_hash
from folioflow.sources.store import exists

#: What later batches look at of the records that earlier ones stored.
_STORED = T.StructType(
    [T.StructField("identifier", T.StringType()), T.StructField("status", T.StringType()), T.StructField("batch_id", T.LongType())]
)


def _replace_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def _earlier_batches(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """(identifier, status, batch_id) stored by earlier batches; a replay does not see its own first attempt."""
    if not exists(spark, path):
        return None  # nothing has been written yet
    return spark.read.schema(_STORED).parquet(path).where(F.col("batch_id") < batch_id)


def _start(stream: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_ingest(
    items: DataFrame,
    store: DataFrame,
    responses: DataFrame,
    records_path: str,
    objects_path: str,
    checkpoint: str,
    as_of,
    order_cols: list[str],
) -> StreamingQuery:
    """Ingest arriving items once.

    ``items`` is a streaming frame, ``store`` holds the records present before the
    stream began. Items of an identifier stored there or by an earlier batch are
    skipped; within a batch the first by ``order_cols`` wins.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = store.select("identifier", "status")
        earlier = _earlier_batches(spark, records_path, batch_id)
        if earlier is not None:
            known = known.unionByName(earlier.select("identifier", "status"))
        # The batch is read several times: hold it in a table.
        batch = materialise(batch, "batch")
        result = ingest_items(batch, known, responses, as_of, order_cols=order_cols)
        _replace_batch(result.objects, objects_path, batch_id)
        _replace_batch(result.records, records_path, batch_id)

    return _start(items, run, checkpoint)


def stream_dedup(
    stream: DataFrame, key: str = "identifier", watermark: tuple[str, str] | None = None, unbounded: bool = False
) -> DataFrame:
    """The row of each key that arrives first.

    A ``(time column, delay)`` watermark limits how far apart duplicates may arrive, and with it the state; only
    with ``unbounded`` all keys are remembered for ever. Use ``stream_first_wins`` where the first is to be the earliest.
    """
    if watermark is not None:
        return stream.withWatermark(*watermark).dropDuplicatesWithinWatermark([key])
    if not unbounded:
        raise ValueError("give a watermark, or ask for unbounded state")
    return stream.dropDuplicates([key])


#: Times in rows that wait in the state, to the microsecond.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def stream_first_wins(
    stream: DataFrame, time: str, delay: str, keep_ms: int, key: str = "identifier", buckets: int = 4096
) -> DataFrame:
    """The earliest row of each key by event time, whatever order rows arrive in.

    A row waits until the watermark, ``delay`` behind the latest time, has passed it: an earlier one that arrives meanwhile
    takes its place, one that arrives later still is too late for the stream. Then the winner is put out once, its row leaves the state,
    and the key is remembered for ``keep_ms`` of event time to swallow duplicates; after that it is forgotten. So the state holds the
    keys of a span of time, not of all time. Rows of equal time stand by the hash of the row. Rows without a time are left out.

    Calling Python costs milliseconds, so keys are kept together in ``buckets`` by their hash and one call serves all of a bucket. A bucket is
    written anew when one of its keys changes: take more of them where batches are small beside the keys that are held.
    """
    rows = stream.where(F.col(time).isNotNull()).withWatermark(time, delay)
    waiting = rows.select(
        F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).alias("bucket"), F.to_json(F.struct(F.col(key).alias("key")), _JSON).alias("key"),
        time, F.unix_micros(F.col(time)).alias("at"), row_hash(rows).alias("tie"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in stream.columns]), _JSON).alias("row"),
    )

    def earliest(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # Per key: time and tie of the best row, the row until it is told, whether it is, and what the watermark has to pass next.
        held = json.loads(state.get[0]) if state.exists else {}
        now, met = state.getCurrentWatermarkMs(), set()

        def wake(at: int, told: bool) -> int:
            return max(at // 1000 + (keep_ms if told else 0), now + 1)

        for frame in () if state.hasTimedOut else frames:
            first = frame.sort_values(["at", "tie"]).drop_duplicates("key")
            for name, at, tie, row in zip(*[first[c].tolist() for c in ("key", "at", "tie", "row")], strict=True):
                best = held.get(name)
                if best is None or (not best[3] and [at, tie] < best[:2]):
                    best = [at, tie, row, False]
                held[name] = [*best[:4], wake(best[0], best[3])]
                met.add(name)
        won = []
        for name in [n for n, best in held.items() if best[4] < now and n not in met]:
            at, tie, row, told, _ = held.pop(name)
            if not told:
                won.append(row)
                held[name] = [at, tie, None, True, wake(at, True)]
        if held:
            state.update((json.dumps(held),))
            state.setTimeoutTimestamp(max(min(best[4] for best in held.values()), now + 1))
        elif state.exists:
            state.remove()
        if won:
            yield pd.DataFrame({"row": won})

    won = waiting.groupBy("bucket").applyInPandasWithState(
        earliest, "row string", "held string", "append", GroupStateTimeout.EventTimeTimeout
    )
    return won.select(F.from_json("row", stream.schema, _JSON).alias("row")).select("row.*")


def stream_transform(
    records: DataFrame,
    objects: DataFrame,
    start: str,
    end: str,
    records_path: str,
    objects_path: str,
    checkpoint: str,
    as_of,
) -> StreamingQuery:
    """Transform newly landed records, a streaming frame, against the landing objects."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = materialise(batch, "batch")
        outcomes = materialise(transform_job(batch, objects, start, end, as_of), "outcomes")
        _replace_batch(processed_objects(outcomes), objects_path, batch_id)
        _replace_batch(processed_records(outcomes), records_path, batch_id)

    return _start(records, run, checkpoint)
