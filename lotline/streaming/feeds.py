"""The same operators on streams: messages once across batches, late events into trailing totals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from lotline.functions.keys import is_sequence_key
from lotline.operators.once import BLOCK_BITS, RANGES, accept_new
from lotline.operators.trailing import correct_nodes, tree_nodes
from lotline.sources.readers import _fs, finished_folders


def once_within(df: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """Stream of messages without those seen before within the watermark."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def counts_by_window(df: DataFrame, event_time: str, entity: str, width: str = "1 day", delay: str = "3 days") -> DataFrame:
    """Events per entity and tumbling window of event time; later ones than ``delay`` are left out."""
    return df.withWatermark(event_time, delay).groupBy(F.window(event_time, width).alias("w"), entity).agg(F.count(F.lit(1)).alias("n")).select(entity, F.col("w.start").alias("window_start"), "n")


#: A store writes all blocks again after so many batches, and then forgets older ones.
COMPACT_EVERY = 32


class SeenStore:
    """Seen ranges and odd keys in a folder. Each batch writes only the blocks it touched, newer versions of a block count.

    Now and then all blocks are written together and folders before that are deleted. A batch that comes again replaces
    its own folder.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def _finished(self, kind: str, before: int) -> list[int]:
        numbers = [int(f.rsplit("=", 1)[1]) for f in finished_folders(self.spark, f"{self.root}/{kind}/batch=*")]
        return sorted(n for n in numbers if n < before)

    def ranges(self, before: int) -> DataFrame:
        """The disjoint ranges of all batches before one: of each block those of its newest version."""
        done = self._finished("ranges", before)
        if not done:
            return self.spark.createDataFrame([], RANGES)
        every = self.spark.read.option("basePath", f"{self.root}/ranges").schema(f"{RANGES}, batch bigint").parquet(*[f"{self.root}/ranges/batch={n}" for n in done])
        newest = every.groupBy("producer", "block").agg(F.max("batch").alias("batch"))
        return every.join(newest, ["producer", "block", "batch"]).drop("batch")

    def odd(self, before: int) -> DataFrame:
        done = self._finished("odd", before)
        schema = "producer string, key string"
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/odd/batch={n}" for n in done]) if done else self.spark.createDataFrame([], schema)

    def save(self, df: DataFrame, kind: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{kind}/batch={batch}")

    def forget(self, kind: str, before: int) -> None:
        """Delete the folders of batches before one."""
        fs, _ = _fs(self.spark, self.root)
        for n in self._finished(kind, before):
            fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}/batch={n}"), True)


def accept_batch(spark: SparkSession, batch: DataFrame, number: int, state: str, newest: list[Column], out: str) -> None:
    """Append to ``out`` the messages (producer, key, ...) of a batch that no batch before had; idempotent for a batch."""
    store = SeenStore(spark, state)
    seen, odd = store.ranges(number), store.odd(number)
    keyed = batch.where("producer is not null and key is not null")
    fresh, ranges = accept_new(keyed, seen, odd, newest)
    fresh.write.mode("overwrite").parquet(f"{out}/batch={number}")
    whole = number > 0 and number % COMPACT_EVERY == 0
    touched = keyed.where(is_sequence_key(F.col("key"))).select("producer", F.shiftright(F.col("key").cast("bigint"), BLOCK_BITS).alias("block")).distinct()
    store.save(ranges if whole else ranges.join(touched, ["producer", "block"], "left_semi").select(*ranges.columns), "ranges", number)
    odd_new = keyed.where(~is_sequence_key(F.col("key"))).select("producer", "key")
    store.save(odd.unionByName(odd_new).distinct() if whole else odd_new.distinct(), "odd", number)
    if whole:  # the batch before stays, should this one come again
        for kind in ("ranges", "odd"):
            store.forget(kind, number - COMPACT_EVERY)


def run_once_stream(stream: DataFrame, state: str, out: str, checkpoint: str, newest: list[Column]) -> StreamingQuery:
    """Deliver each message once, whatever batch it comes in; what is there is processed, then the query ends."""

    def each(batch: DataFrame, number: int) -> None:
        accept_batch(batch.sparkSession, batch, number, state, newest, out)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_totals(nodes: DataFrame, events: DataFrame, entity: str, when: str, fold: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Stored tree nodes after more events, late ones included: only ancestors of their days change."""
    late = events.where(F.col(entity).isNotNull() & F.col(when).isNotNull()).groupBy(F.col(entity).alias("entity"), F.unix_date(F.to_date(when)).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return correct_nodes(nodes, fold(late) if fold else late)


__all__ = ["accept_batch", "counts_by_window", "late_totals", "once_within", "run_once_stream", "tree_nodes"]
