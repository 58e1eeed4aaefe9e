"""Resumable ingest and block-wise screening as streams over landed files; both stop when all that is there has been read."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType


def ingest(spark: SparkSession, folder: str, schema: StructType | str, out: str, checkpoint: str, form: str = "csv", gate: Callable[[DataFrame], None] | None = None) -> int:
    """Appends files of folder that no earlier run has read to the Parquet table out; the rows added.

    Exactly once: each batch overwrites a partition of its own, so a batch that is run again replaces itself. gate: raises on a batch that must not land.
    """
    added = [0]

    def land(batch: DataFrame, number: int) -> None:
        if gate:
            gate(batch)
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
        added[0] += spark.read.parquet(f"{out}/batch={number}").count()

    reader = spark.readStream.schema(schema).format(form)
    stream = (reader.option("header", True) if form == "csv" else reader).load(folder)
    stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return added[0]


class _FirstOfKey(StatefulProcessor):
    """Lets a key's first row through, once in the life of the stream: the smallest by `order` of the block that the key first comes in."""

    def __init__(self, order: str):
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:  # noqa: N802, N803
        if self.seen.exists():
            return
        self.seen.update((True,))
        yield min(rows, key=lambda r: (r[self.order] is None, r[self.order]))


def first_of_keys(stream: DataFrame, key: str, order: str) -> DataFrame:
    """Of a stream's rows with a key that is not null the first (smallest `order`, nulls last) of the first block that holds the key, by keyed state: a block reads and writes the state of its own
    keys only, however many came before it. Batches of rows keep one row a key before they are shuffled, so a key that most rows have is no large group."""

    def thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.take(pc.sort_indices(b, [(key, "ascending"), (order, "ascending")]))
            keys = b.column(key).to_pylist()
            yield b.take(pa.array([i for i, k in enumerate(keys) if not i or k != keys[i - 1]], pa.int64()))

    rows = stream.where(F.col(key).isNotNull())
    return rows.mapInArrow(thinned, rows.schema).groupBy(key).transformWithState(statefulProcessor=_FirstOfKey(order), outputStructType=rows.schema, outputMode="append", timeMode="none")


#: Where the keys' state lives: a local store per partition whose changes go to the checkpoint with each block.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _with_state(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def screen_blocks(spark: SparkSession, folder: str, schema: StructType | str, screen: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, key: str = "key", order: str = "pos", files_at_once: int = 1) -> list[dict]:
    """Screens a library folder block by block: what came since the last call, in blocks of so many files by age. Of the rows with a key the first of its first block stays (smallest `order`); blocks
    in order give the batch job's rows. Per block that was screened: rows read, keys that were new, keys so far.

    Which keys came before is state in the checkpoint, so a block's work grows with its own rows. A block that is run again after a failure sees the state before it and replaces its own output."""

    def land(batch: DataFrame, n: int) -> None:
        screen(batch).write.mode("overwrite").parquet(f"{out}/block={n}")

    with _with_state(spark):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder)
        firsts = first_of_keys(stream, key, order)
        query = firsts.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    done = []
    for p in query.recentProgress:
        state = p["stateOperators"][0] if p["stateOperators"] else {}
        done.append({"block": p["batchId"], "rows": p["numInputRows"], "new_keys": state.get("numRowsUpdated", 0), "keys": state.get("numRowsTotal", 0)})
    return done
