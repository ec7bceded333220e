"""Scripts as they arrive: a file stream into an item table and a snapshot, each batch applied once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.shared import settings
from driftline.sinks import buckets, files
from driftline.sources import scripts
from driftline.sources.splits import OPEN_COST

_ITEMS = "uid string, file string, line int, command string, field string, jp string, seq int"


class Arrivals:
    """Items of all scripts that have arrived in a folder, and their sources in a snapshot.

    Each start reads the files that are new since the last one and ends. A batch's items go to a folder named by the batch, which
    is written anew if the batch is made again, and its sources replace those of their uids in the snapshot, which made twice
    is the same. So a start that ends between its writes and its commit leaves nothing double. A file is read once, by its name.
    """

    def __init__(self, spark: SparkSession, source: str, target: str, pattern: str = "adv_*.txt", files_at_a_time: int | None = None):
        self.spark, self.source, self.target, self.pattern, self.most = spark, source, target, pattern, files_at_a_time

    def apply(self, found: DataFrame, batch: int) -> None:
        """One batch of (file, value)."""
        made = scripts.with_uids(scripts.items(scripts.numbered(found))).select("uid", "file", "line", "command", "field", "jp", "seq")
        place = f"{self.target}/items/batch={batch}"
        made.write.mode("overwrite").parquet(place)
        held = self.spark.read.schema(_ITEMS).parquet(place)
        buckets.update_snapshot(self.spark, f"{self.target}/snapshot", held.select("uid", "jp"))

    def run(self) -> None:
        stream = self.spark.readStream.format("text").schema("value string").option("wholetext", "true").option("pathGlobFilter", self.pattern)
        if self.most:
            stream = stream.option("maxFilesPerTrigger", self.most)
        named = stream.load(self.source).select(F.col("_metadata.file_name").alias("file"), "value")
        with settings(self.spark, OPEN_COST):  # a query keeps the settings that it starts with
            started = named.writeStream.foreachBatch(self.apply).option("checkpointLocation", f"{self.target}/checkpoint").trigger(availableNow=True).start()
        started.awaitTermination()

    def items(self) -> DataFrame:
        """uid, file, line, command, field, jp, seq of all batches."""
        if not files.exists(f"{self.target}/items"):
            return self.spark.createDataFrame([], _ITEMS)
        return self.spark.read.schema(f"{_ITEMS}, batch int").parquet(f"{self.target}/items").drop("batch")

    def snapshot(self) -> DataFrame:
        return buckets.snapshot(self.spark, f"{self.target}/snapshot")
