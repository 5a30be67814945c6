"""Exact deduplication with a disk-backed keyed state that never expires.

Rows are landed once, with a digest of their normalised text and a locator. A stream reads the landed digests; its state, in RocksDB under
the checkpoint folder, holds for each digest the row that stays (length, id, locator) and the number of rows. More rows may be landed later and the same
stream run again; the state then decides over all of them. Digests seen more than once are checked on the full bytes; if different texts share a
digest, their group is decided again by the whole normalised texts.

Texts are equal if they are the same after deleting blanks and the characters 9 to 13. Of equal texts the longest original (code
points) stays, then the smallest id, then the first landed row; a null id comes after any other. Null counts as an empty text, and all empty texts are equal. Repeated rows are
rows like others, of which one stays. Copies of a digest combine in the tasks before the stream shuffles them; the join of rows with their decisions is left to adaptive
execution, which splits a hot digest. The number of state partitions is fixed by the shuffle setting of the first run. Columns of any name are kept in ``row``. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aqspark.llm.common import new_path, small_side, stage

BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
#: State on the executors' disks, without space reserved ahead in each of many small stores.
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
_LANDED = "digest binary, points long, id long, at string"


def normalised(text: Column) -> Column:
    return reduce(lambda c, blank: F.replace(c, F.lit(blank), F.lit("")), BLANKS, F.coalesce(text.cast("string"), F.lit("")))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


class Deduplicator:
    """Landed rows, the stream's state and the decisions, under one folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str | None = None, key=digest, doc_id: str = "doc_id", text: str = "text") -> None:
        self.spark, self.path, self.key, self.doc_id, self.text = spark, path or new_path(spark, "exact"), key, doc_id, text
        self.schema = None

    def land(self, docs: DataFrame) -> None:
        """Write ``docs`` beside the rows landed before; the locator is the folder, the task and the row in it."""
        batch = new_path(self.spark, "b").rsplit("/", 1)[-1]
        text = F.col(f"row.`{self.text}`").cast("string")
        rows = docs.select(F.struct("*").alias("row")).select(
            "row", self.key(normalised(text)).alias("digest"), F.coalesce(F.char_length(text), F.lit(0)).cast("long").alias("points"),
            F.col(f"row.`{self.doc_id}`").cast("long").alias("id"), F.concat(F.lit(f"{batch}-"), F.monotonically_increasing_id()).alias("at"),
        )
        rows.write.mode("append").option("compression", "zstd").parquet(f"{self.path}/landed")
        self.schema = rows.schema

    def landed(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/landed")

    def advance(self) -> DataFrame:
        """Take the rows landed since the last call into the state, as a stream that stops when it has read them; returns the state.

        Columns: ``digest``, ``keep_id``, ``keep_at`` and ``n``. It is read from the state store once and written as a table.
        """
        conf = self.spark.conf
        before = {k: conf.get(k, None) for k in STORE}
        for k, v in STORE.items():
            conf.set(k, v)
        try:
            arrived = self.spark.readStream.schema(_LANDED).parquet(f"{self.path}/landed")
            first = F.max(F.struct("points", F.col("id").isNotNull().alias("known"), F.bitwise_not("id").alias("low"), "at"))
            state = arrived.groupBy("digest").agg(first.alias("first"), F.count("*").alias("n"))
            state.writeStream.format("noop").outputMode("update").option("checkpointLocation", f"{self.path}/state").trigger(availableNow=True).start().awaitTermination()
            return stage(self._state(), "state")
        finally:
            for k, v in before.items():
                conf.set(k, v) if v is not None else conf.unset(k)

    def _state(self) -> DataFrame:
        kept = self.spark.read.format("statestore").load(f"{self.path}/state")
        first, n = (F.col("value").getField(x) for x in kept.schema["value"].dataType.names)
        return kept.select(F.col("key.digest").alias("digest"), F.bitwise_not(first["low"]).alias("keep_id"), first["at"].alias("keep_at"), n.alias("n"))

    def decisions(self, state: DataFrame) -> DataFrame:
        """By the state of ``advance``, every landed row: ``row``, ``id``, ``at``, ``digest``, ``keep_id``, ``keep_at``, ``group_size``."""
        landed = self.landed()
        text = normalised(F.col(f"row.`{self.text}`"))
        # hits: equal digests must have equal bytes. The smallest and largest text of a digest are found map-side, so large groups don't meet in one task
        hits = landed.join(small_side(state.where("n > 1").select("digest")), "digest", "left_semi")
        mixed = hits.select("digest", text.alias("text")).groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high")).where("low != high")
        decided = landed.join(state, "digest").select("row", "id", "at", "digest", "keep_id", "keep_at", F.col("n").alias("group_size"))
        different = mixed.select("digest")
        if different.isEmpty():
            return decided
        again = landed.join(different, "digest", "left_semi").withColumn("whole", text)
        first = F.max(F.struct("points", F.col("id").isNotNull().alias("known"), F.bitwise_not("id").alias("low"), "at")).alias("first")
        by_text = again.groupBy("digest", "whole").agg(first, F.count("*").alias("n"))
        own = again.join(by_text, ["digest", "whole"]).select("row", "id", "at", "digest", F.bitwise_not("first.low").alias("keep_id"), F.col("first.at").alias("keep_at"), F.col("n").alias("group_size"))
        return decided.join(different, "digest", "left_anti").unionByName(own)


def decide(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", key=digest) -> DataFrame:
    """One run over a table: the decisions for every row, and ``kept``."""
    runs = Deduplicator(docs.sparkSession, None, key, doc_id, text)
    runs.land(docs)
    return runs.decisions(runs.advance()).withColumn("kept", F.col("at") == F.col("keep_at"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return decide(docs, doc_id, text).where("kept").select("row.*")
