"""A keyed table in hash buckets with delta files: a small update writes and reads in proportion to itself."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.shared import discard, written
from driftline.sinks import files

#: Buckets of a new table, and files that a bucket has before it is put together.
BUCKETS, MOST = 64, 8


class BucketTable:
    """(key, value) rows in a folder. ``_state.json`` lists each bucket's files, oldest first; a key's last file counts.

    An update writes one file a touched bucket and then replaces the list in one step, so readers see the table before it or
    after it, and an update that breaks off leaves nothing but files that no list names. Buckets with more than MOST files are
    put together by the update that made them so; other buckets are neither read nor written. Files that the list before last named are
    deleted, those of the last one stay for its readers. One writer at a time: a list that another writer replaced meanwhile is an error.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str = "uid", value: str = "jp", buckets: int = BUCKETS, most: int = MOST):
        self.spark, self.folder, self.key, self.value, self.most = spark, folder, key, value, most
        self.schema = f"{key} string, {value} string"
        self.buckets = self.state().get("buckets", buckets)

    def state(self) -> dict:
        """version, buckets, files by bucket as (version, place), and places that only the list before named."""
        path = f"{self.folder}/_state.json"
        return json.loads(files.get(path)) if files.exists(path) else {"version": 0, "files": {}, "past": []}

    def _rows(self, listed: dict[str, list]) -> DataFrame:
        """(key, value, at) of the listed files; at: the version that wrote them."""
        versions = sorted({(v, place.split("/")[0]) for own in listed.values() for v, place in own})
        parts = []
        for version, top in versions:
            places = [f"{self.folder}/{place}" for own in listed.values() for v, place in own if place.split("/")[0] == top]
            parts.append(self.spark.read.schema(self.schema).parquet(*places).withColumn("at", F.lit(version)))
        out = parts[0] if parts else self.spark.createDataFrame([], f"{self.schema}, at int")
        for part in parts[1:]:
            out = out.unionAll(part)
        return out

    def read(self) -> DataFrame:
        """Each key's last value."""
        return self._last(self._rows(self.state()["files"]))

    def _last(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(self.key).agg(F.max_by(self.value, "at").alias(self.value))

    def _write(self, rows: DataFrame, name: str) -> list[str]:
        """Writes rows by bucket; the buckets that have any."""
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        rows.select(self.key, self.value, bucket.alias("bucket")).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.folder}/{name}")
        return sorted(d.removeprefix("bucket=") for d in files.tree(f"{self.folder}/{name}")[0])

    def upsert(self, rows: DataFrame) -> dict[str, int]:
        """Rows replace those of their keys; of a key that comes twice the greater value counts. What was done: rows and buckets written, buckets put together."""
        before = self.state()
        version = before["version"] + 1
        new = written(rows.select(self.key, self.value).groupBy(self.key).agg(F.max(self.value).alias(self.value)), "upsert")
        name = f"v{version}-{uuid.uuid4().hex}"
        touched = self._write(new, name) if (n := new.count()) else []
        discard(new)
        listed = {b: [tuple(x) for x in own] for b, own in before["files"].items()}
        for b in touched:
            listed.setdefault(b, []).append((version, f"{name}/bucket={b}"))
        full = [b for b in touched if len(listed[b]) > self.most]
        if full:
            whole = f"c{version}-{uuid.uuid4().hex}"
            self._write(self._last(self._rows({b: listed[b] for b in full})), whole)
            for b in full:
                listed[b] = [(version, f"{whole}/bucket={b}")]
        kept = {place for own in listed.values() for _, place in own}
        past = sorted({place for own in before["files"].values() for _, place in own} - kept | {f"{name}/bucket={b}" for b in full})
        if self.state()["version"] != before["version"]:
            raise RuntimeError(f"{self.folder} was changed by another writer")
        files.put(f"{self.folder}/_state.json", json.dumps({"version": version, "buckets": self.buckets, "files": listed, "past": past}).encode())
        for place in before["past"]:
            files.remove(f"{self.folder}/{place}")
        return {"version": version, "rows": n, "buckets": len(touched), "together": len(full)}


def snapshot(spark: SparkSession, path: str) -> DataFrame:
    """(uid, jp) of a snapshot: a bucket table, an older Parquet folder or JSON file; no rows where it is missing."""
    from driftline.sinks.tables import read_pairs

    return BucketTable(spark, path).read() if files.exists(f"{path}/_state.json") else read_pairs(spark, path, "uid", "jp")


def update_snapshot(spark: SparkSession, path: str, rows: DataFrame) -> dict[str, int]:
    """Rows (uid, jp) into a snapshot; one in an older form is taken over first."""
    if not files.exists(f"{path}/_state.json") and files.exists(path):
        old = written(snapshot(spark, path), "snapshot")
        files.remove(f"{path}.new")
        BucketTable(spark, f"{path}.new").upsert(old)
        files.swap(f"{path}.new", path)
    return BucketTable(spark, path).upsert(rows)
