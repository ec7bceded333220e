"""Items, snapshots, checkpoints and logs: Parquet folders, or one JSON file where the path says so."""

from __future__ import annotations

import itertools
import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.shared import delete, scratch
from driftline.sinks import files
from driftline.sources.documents import exists, read_map

#: Bytes copied at a time, and rows.
BLOCK, HANDED = 1 << 23, 10_000


def write_items(items: DataFrame, path: str) -> None:
    """Items as Parquet, or as one JSON array in the order of ord, an item a line. Tasks write the lines; their bytes are then put together, a block at a time."""
    if not path.endswith(".json"):
        items.write.mode("overwrite").parquet(path)
        return
    ordered, spark = items.orderBy("ord") if "ord" in items.columns else items, items.sparkSession
    folder = scratch(spark, "json")
    ordered.select(F.concat(F.to_json(F.struct(*ordered.columns)), F.lit(",")).alias("j")).write.text(folder)
    store, place = files.located(path)
    part, held = f"{place}.{uuid.uuid4().hex}.tmp", b""
    store.create_dir(place.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(part, compression=None) as out:  # beside the place, which may be read meanwhile
        out.write(b"[")
        for name in (n for n in files.tree(folder)[1] if n.startswith("part-")):  # numbered in the order of the rows
            source, at = files.located(f"{folder}/{name}")
            with source.open_input_stream(at, compression=None) as lines:
                while block := lines.read(BLOCK):
                    block = (held or b"\n") + block
                    out.write(block[:-2])
                    held = block[-2:]  # the last item has no comma
        out.write(b"\n]" if held else b"]")
    store.move(part, place)
    delete(spark, folder)


def handed(spark: SparkSession, rows: Iterable[tuple], schema: str, name: str) -> DataFrame:
    """A table of rows that the driver goes through, written some thousands at a time."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import to_arrow_schema

    folder = scratch(spark, name)
    kinds, rows = spark.createDataFrame([], schema).schema, iter(rows)
    store, place = files.located(folder)
    store.create_dir(place, recursive=True)
    with store.open_output_stream(f"{place}/part-00000.parquet", compression=None) as out, pq.ParquetWriter(out, to_arrow_schema(kinds)) as writer:
        while some := list(itertools.islice(rows, HANDED)):
            writer.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), writer.schema, strict=True)], schema=writer.schema))
    return spark.read.schema(kinds).parquet(folder)


def export_items(items: DataFrame, status: str, path: str) -> int:
    """The items of one status; their number."""
    kept = items.filter(F.col("status") == status)
    write_items(kept, path)
    return kept.count()


def read_pairs(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """A two-column table of a JSON object or a Parquet folder; no rows where it is missing."""
    if path.endswith(".json") or not exists(spark, path):
        return read_map(spark, path, key, value)
    return spark.read.schema(f"{key} string, {value} string").parquet(path)


def write_pairs(pairs: DataFrame, path: str) -> None:
    """Replace a two-column table, which may be read by ``pairs`` itself: written beside, then swapped."""
    if path.endswith(".json"):
        found = dict(map(tuple, pairs.toLocalIterator()))
        files.put(path, json.dumps(found, ensure_ascii=False, indent=1).encode())
        return
    pairs.write.mode("overwrite").parquet(f"{path}.new")
    files.swap(f"{path}.new", path)
