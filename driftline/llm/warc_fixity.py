"""WARC files and their fixity audit by Merkle trees.

``write_warc`` stores records as gzip members one after another and returns a manifest: each record's file, place in the file
and byte range. A leaf of a file's tree is the SHA-256 of the stored bytes of one range; a node above hashes the ranges and
hashes of up to ``FANOUT`` neighbouring nodes in order of offset, up to one root a file. ``audit`` compares the roots of two
replicas and descends only below nodes that differ, down to the records. ``leaves`` also holds each range against the hash noted at writing, which tells which replica is bad and
finds damage alike in both; ``longer_or_shorter`` holds the files' lengths against the manifest's.

Records of a file are in rising offsets; files are cut by size, so no host, however common, makes one large. Every group that
is hashed has at most ``FANOUT`` rows. Files live in a folder that all executors reach.

Nulls: a null url has no Target-URI value, a null html is an empty payload; line breaks in urls are escaped. Repeated rows are
records of their own. Empty table: no files, no rows. Records of any length are stored whole. Other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm.base import filesystem, load, materialise, maybe_broadcast, scratch

FANOUT = 64
FILE_BYTES = 256_000_000
#: Records read by one task at a time.
RUN = 2048
#: The date in every record, so that equal input gives equal bytes.
DATE = "2000-01-01T00:00:00Z"
#: The drill of the query: every record whose page_id is a multiple of this is damaged in the second replica.
DRILL = 97


def record(page_id: int | None, url: str | None, html: str | None) -> bytes:
    """One WARC resource record."""
    payload = (html or "").encode()
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: {target}\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload + b"\r\n\r\n"


def write_warc(pages: DataFrame, root: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write page_id, url, html as WARC files; returns the manifest (file, ord, start, end, page_id, n_bytes, written), itself written.

    Files are named by the task attempt; only those that finished are in the manifest.
    """

    def run(batches):
        fs, top = filesystem(root)
        sink = None
        for batch in batches:
            out = []
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if sink is None:
                    fs.create_dir(top, recursive=True)
                    name, at, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink = fs.open_output_stream(f"{top}/{name}", compression=None)
                raw = record(page_id, url, html)
                stored = gzip.compress(raw, 6, mtime=0)
                sink.write(stored)
                out.append((name, n, at, at + len(stored), page_id, len(raw), hashlib.sha256(stored).hexdigest()))
                at, n = at + len(stored), n + 1
                if at >= file_bytes:
                    sink.close()
                    sink = None
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) if k != 4 else pa.array(c, pa.int64()) for k, c in enumerate(zip(*out, strict=True))], names=["file", "ord", "start", "end", "page_id", "n_bytes", "written"])
        if sink is not None:
            sink.close()

    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    return materialise(rows.mapInArrow(run, "file string, ord long, start long, end long, page_id long, n_bytes long, written string"), "manifest")


def copy_replica(manifest: DataFrame, source: str, target: str, damage: DataFrame | None = None) -> None:
    """Copy all files; ``damage`` (file, at): byte places to invert on the way, for drills."""

    def run(batches):
        for batch in batches:
            for name, flips in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                (fs, a), (fs2, b) = filesystem(source), filesystem(target)
                fs2.create_dir(b, recursive=True)
                flips, at = sorted(flips or []), 0
                part = f"{b}/{name}.{uuid.uuid4().hex}"
                with fs.open_input_stream(f"{a}/{name}", compression=None) as src, fs2.open_output_stream(part, compression=None) as out:
                    while block := src.read(8_000_000):
                        block = bytearray(block)
                        while flips and flips[0] < at + len(block):
                            block[flips.pop(0) - at] ^= 0xFF
                        out.write(bytes(block))
                        at += len(block)
                fs2.move(part, f"{b}/{name}")
                yield pa.RecordBatch.from_arrays([pa.array([name])], names=["file"])

    files = manifest.select("file").distinct()
    files = files.join(damage.groupBy("file").agg(F.collect_list("at").alias("at")), "file", "left") if damage is not None else files.withColumn("at", F.array().cast("array<long>"))
    files.select("file", "at").mapInArrow(run, "file string").write.format("noop").mode("overwrite").save()


def leaves(manifest: DataFrame, root: str) -> DataFrame:
    """(file, ord, start, end, hash, record_sha256, intact): what a replica has in the manifest's ranges, and whether it is what was written; record_sha256 is null where the member can't be read, hash also where bytes are missing."""

    def run(batches):
        fs, top = filesystem(root)
        held: tuple[str, object] | None = None
        for batch in batches:
            names, starts, ends, written = (batch.column(k).to_pylist() for k in (0, 2, 3, 4))
            hashes, records = [], []
            for name, a, b in zip(names, starts, ends, strict=True):
                try:
                    if held is None or held[0] != name:
                        held = (name, fs.open_input_file(f"{top}/{name}"))
                    held[1].seek(a)
                    stored = held[1].read(b - a)
                except OSError:
                    stored = b""
                hashes.append(hashlib.sha256(stored).hexdigest() if len(stored) == b - a else None)
                try:
                    records.append(hashlib.sha256(gzip.decompress(stored)).hexdigest() if len(stored) == b - a else None)
                except (OSError, EOFError, ValueError, zlib.error):
                    records.append(None)
            intact = pa.array([h == w for h, w in zip(hashes, written, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(hashes, pa.string()), pa.array(records, pa.string()), intact], names=["file", "ord", "start", "end", "hash", "record_sha256", "intact"])

    run_of = F.floor(F.col("ord") / RUN)
    ordered = manifest.select("file", "ord", "start", "end", "written").repartition("file", run_of).sortWithinPartitions("file", "ord")
    return ordered.mapInArrow(run, "file string, ord long, start long, end long, hash string, record_sha256 string, intact boolean")


def longer_or_shorter(manifest: DataFrame, root: str) -> DataFrame:
    """(file, ord): the last record of each file that doesn't end where that record does."""

    def run(batches):
        fs, top = filesystem(root)
        for batch in batches:
            sizes = [fs.get_file_info(f"{top}/{name}").size for name in batch.column(0).to_pylist()]
            yield batch.filter(pa.array([s != e for s, e in zip(sizes, batch.column(2).to_pylist(), strict=True)], pa.bool_())).select(["file", "ord"])

    last = manifest.groupBy("file").agg(F.max("ord").alias("ord"), F.max("end").alias("end"))
    return last.mapInArrow(run, "file string, ord long")


def tree(leaf: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """The levels of all files' trees, leaves first, each (file, ord, start, end, hash) and written; the last has one node a file."""
    levels = [leaf.select("file", "ord", "start", "end", F.coalesce("hash", F.lit("missing")).alias("hash"))]
    while True:
        top = levels[-1].agg(F.max("ord")).first()[0]
        if not top:
            return levels
        child = F.struct("ord", "start", "end", "hash")
        said = F.transform(F.array_sort("kids"), lambda k: F.concat_ws(":", k["start"].cast("string"), k["end"].cast("string"), k["hash"]))
        up = levels[-1].groupBy("file", F.floor(F.col("ord") / fanout).alias("ord")).agg(F.collect_list(child).alias("kids"))  # at most fanout children
        up = up.select("file", "ord", F.array_min(F.transform("kids", lambda k: k["start"])).alias("start"), F.array_max(F.transform("kids", lambda k: k["end"])).alias("end"), F.sha2(F.array_join(said, ","), 256).alias("hash"))
        levels.append(materialise(up, "level"))


def audit(a: list[DataFrame], b: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """(file, ord, hash_a, hash_b) of the records that differ between two replicas' trees of one manifest."""
    spark = a[0].sparkSession
    frontier: DataFrame | None = None
    for x, y in zip(reversed(a), reversed(b), strict=True):
        if frontier is not None:  # only the children of nodes that differ
            n = frontier.count()
            if not n:
                return spark.createDataFrame([], "file string, ord long, hash_a string, hash_b string")
            above = maybe_broadcast(frontier.select(F.col("file"), F.col("ord").alias("_up")), n)
            x, y = (z.withColumn("_up", F.floor(F.col("ord") / fanout)).join(above, ["file", "_up"], "left_semi") for z in (x, y))
        both = x.select("file", "ord", F.col("hash").alias("hash_a")).join(y.select("file", "ord", F.col("hash").alias("hash_b")), ["file", "ord"], "full")
        frontier = materialise(both.filter(~F.col("hash_a").eqNullSafe(F.col("hash_b"))), "frontier")
    return frontier


def op3_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages, copy the archive with a drill's damage, audit the replicas: a row a page with what the first replica holds and whether either replica's record is not the one written."""
    first, second = scratch(spark, "warc-a"), scratch(spark, "warc-b")
    manifest = write_warc(load(spark, sf_dir, "pages"), first)
    drill = manifest.filter(F.col("page_id") % DRILL == 0).select("file", F.floor((F.col("start") + F.col("end")) / 2).cast("long").alias("at"))
    copy_replica(manifest, first, second, drill)
    one, two = (materialise(leaves(manifest, root), "leaves") for root in (first, second))
    bad = audit(tree(one), tree(two)).select("file", "ord")
    for leaf, root in ((one, first), (two, second)):
        bad = bad.union(leaf.filter("NOT intact").select("file", "ord")).union(longer_or_shorter(manifest, root))
    bad = materialise(bad.distinct().withColumn("corrupt", F.lit(True)), "bad")
    joined = manifest.join(one.select("file", "ord", "record_sha256"), ["file", "ord"]).join(maybe_broadcast(bad, bad.count()), ["file", "ord"], "left")
    return joined.select("page_id", "n_bytes", "record_sha256", F.coalesce("corrupt", F.lit(False)).alias("corrupt"))


ORACLE = f"""
WITH r AS (SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || coalesce(CAST(page_id AS VARCHAR), '') || '>' || chr(13) || chr(10) || 'WARC-Date: {DATE}' || chr(13) || chr(10)
  || 'WARC-Target-URI: ' || replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A') || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS rec FROM pages)
SELECT page_id, strlen(rec) AS n_bytes, sha256(rec) AS record_sha256, coalesce(page_id % {DRILL} = 0, false) AS corrupt FROM r
"""
