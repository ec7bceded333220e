"""Large text files read by splits: lines with their numbers in the file, and runs of lines that begin a record."""

from __future__ import annotations

import os
import posixpath
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.shared import written
from driftline.sinks import files

#: Places of the splits of cut files are broadcast up to so many; beyond that they are joined by shuffling.
BROADCAST_SPLITS = 100_000
#: What opening a file counts for when files are dealt to tasks: a task takes up to 2,000 small ones.
OPENED = 1 << 16
OPEN_COST = {"spark.sql.files.openCostInBytes": str(OPENED)}
#: Bytes read at a time, and what a task hands on at a time: rows, and bytes.
BLOCK, HANDED, HANDED_BYTES = 1 << 20, 2000, 1 << 22
_END = re.compile("\r\n|\r|\n")
_PIECES = "path string, file string, start long, cut boolean, first long, lines array<string>"


def _blocks(f, start: int, end: int, size: int):
    """(bytes, whether they end the file): the lines that begin in [start, end), cut after LFs."""
    at, rest, skips, end = max(start - 1, 0), b"", start > 0, min(end, size)
    f.seek(at)
    while True:
        got = f.read(min(BLOCK, max(size - at - len(rest), 1)))
        rest += got
        if skips:  # the line that an earlier split has
            stop = rest.find(b"\n")
            at, rest, skips = (at + len(rest), b"", bool(got)) if stop < 0 else (at + stop + 1, rest[stop + 1 :], False)
            if skips:
                continue
        if at >= end:
            return
        stop = rest.find(b"\n", max(end - 1 - at, 0))
        if stop >= 0 or not got:
            yield (rest[: stop + 1], at + stop + 1 >= size) if stop >= 0 else (rest, True)
            return
        if whole := rest.rfind(b"\n") + 1:
            yield rest[:whole], False
            at, rest = at + whole, rest[whole:]


def _read(folder: str, most: int):
    """Splits (name, size, start) -> rows of _PIECES: blocks of lines with the number of lines before them in their split."""

    def run(batches):
        import pyarrow as pa

        store, place = files.located(folder)
        kinds = [pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.string())]
        names = [x.split()[0] for x in _PIECES.split(", ")]

        def made(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        out, held = [], 0
        for batch in batches:
            for name, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                first = 0
                with store.open_input_file(f"{place}/{name}" if name else place) as f:
                    for block, ends in _blocks(f, start, start + most, size):
                        block = block.removeprefix(b"\xef\xbb\xbf") if start == first == 0 else block
                        lines = _END.split(block.decode("utf-8", "replace"))
                        lines = lines if ends else lines[:-1]  # a block ends in LF; what follows the file's last end is a line
                        out.append((name, posixpath.basename(name or place), start, size > most, first, lines))
                        first, held = first + len(lines), held + len(block)
                        if len(out) >= HANDED or held >= HANDED_BYTES:
                            yield made(out)
                            out, held = [], 0
        if out:
            yield made(out)

    return run


def read_lines(spark: SparkSession, folder: str, pattern: str, recursive: bool = False, mark: Column | None = None) -> DataFrame:
    """(path, file, line, text), lines from 1, of all files of the pattern; path is the one in the folder. mark, a condition on ``text``: also ``marks``, how many lines up to this one meet it.

    Lines end in CR LF, LF or CR, and what follows the last end is a line, even an empty one. The folder is listed by a task and read by
    tasks, so the driver holds nothing a file; files are cut into splits of ``spark.sql.files.maxPartitionBytes`` at LFs. Files are opened
    once, many small ones by a task, and their lines kept in the shared folder. Where a file was cut, the lines of its earlier splits are
    counted and added: no file is held whole, and no line is shuffled. An empty file has no lines.
    """
    folder = folder if "://" in folder or folder.startswith("file:") else os.path.abspath(folder)
    most = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))
    found = files.listed(spark, folder, pattern, recursive).filter("size > 0").filter(~F.col("name").rlike("(^|/)[._]"))  # Spark's readers skip these
    cuts = found.select("name", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(most).cast("long"))).alias("start"))
    n, weight = cuts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.least(F.col("size") - F.col("start"), F.lit(most)) + OPENED), F.lit(0))).first()
    tasks = max(1, min(n, max(spark.sparkContext.defaultParallelism, -(-weight // most))))
    rows = written(cuts.repartition(tasks).mapInArrow(_read(folder, most), _PIECES), "lines")
    counted = rows.filter("cut").groupBy("path", "start").agg(F.sum(F.size("lines")).alias("n"))
    whole = Window.partitionBy("path")  # a row a split from here on
    earlier = whole.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    places = written(counted.select("path", "start", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "splits")
    if n_places := places.count():
        rows = rows.join(F.broadcast(places) if n_places <= BROADCAST_SPLITS else places, ["path", "start"], "left")
    before = F.coalesce("before", F.lit(0)) if n_places else F.lit(0)
    each = rows.select("path", "file", "start", (before + F.col("first") + 1).alias("first"), F.posexplode("lines").alias("k", "text"))
    lines = each.select("path", "file", "start", (F.col("first") + F.col("k")).cast("int").alias("line"), "text")
    if mark is None:
        return lines.drop("start")
    marked = lines.withColumn("m", mark.cast("int"))
    sums = marked.groupBy("path", "start").agg(F.sum("m").alias("n")).select("path", "start", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("marks_before"))
    run = F.sum("m").over(Window.partitionBy("path", "start").orderBy("line").rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("run", run).join(sums, ["path", "start"]).select("path", "file", "line", "text", (F.col("marks_before") + F.col("run")).cast("int").alias("marks"))
