"""Files with exact names on any file system that pyarrow knows, trees of them, archives."""

from __future__ import annotations

import datetime
import fnmatch
import hashlib
import io
import itertools
import os
import posixpath
import struct
import tempfile
import uuid
import zipfile
from collections.abc import Mapping

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.shared import written


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or a local path, and the path in it."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))


def safe_name(name: str) -> str:
    """A relative name as it is; names that would leave their folder are errors."""
    if not name or name.startswith(("/", "\\")) or ".." in name.replace("\\", "/").split("/") or ":" in name.split("/")[0]:
        raise ValueError(f"not a name inside a folder: {name!r}")
    return name


def exists(path: str) -> bool:
    store, place = located(path)
    return store.get_file_info(place).type != fs.FileType.NotFound


def get(path: str) -> bytes:
    store, place = located(path)
    with store.open_input_stream(place, compression=None) as f:
        return f.read()


def put(path: str, content: bytes) -> int:
    """Write beside the place, then move: readers see the old file or the new one, and a repeated task does no harm."""
    store, place = located(path)
    store.create_dir(posixpath.dirname(place), recursive=True)
    part = f"{place}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(part, compression=None) as f:
        f.write(content)
    store.move(part, place)
    return len(content)


def remove(path: str) -> None:
    store, place = located(path)
    kind = store.get_file_info(place).type
    if kind == fs.FileType.Directory:
        store.delete_dir(place)
    elif kind != fs.FileType.NotFound:
        store.delete_file(place)


def write_counted(files: DataFrame, folder: str) -> tuple[int, int]:
    """Write (file, content, applied) as one file a row, on the executors; the number of files and the sum of ``applied``. A null content is an empty file."""

    def run(frames):
        for frame in frames:
            for n, c in zip(frame["file"], frame["content"], strict=True):
                put(f"{folder}/{safe_name(n)}", (c or "").encode())
            yield frame[["applied"]]

    done = files.select("file", "content", F.col("applied").cast("long").alias("applied")).mapInPandas(run, "applied long")
    return tuple(done.agg(F.count(F.lit(1)), F.coalesce(F.sum("applied"), F.lit(0))).first())


def write_named(files: DataFrame, folder: str) -> int:
    """Write (file, content) as one file a row, on the executors; the number of files."""
    return write_counted(files.withColumn("applied", F.lit(0)), folder)[0]


HEAD, PIECE, TAIL = 0, 1, 2
_REPORT = "file string, n_bytes long, sha256 string, applied long"


class _Writing:
    """A file that is being written beside its place; it appears there once it is whole."""

    def __init__(self, folder: str, name: str, first: str, between: str, last: str):
        self.name, self.joints = name, (first, between, last)
        self.store, self.place = located(f"{folder}/{safe_name(name)}")
        self.store.create_dir(posixpath.dirname(self.place), recursive=True)
        self.part = f"{self.place}.{uuid.uuid4().hex}.tmp"
        self.out = self.store.open_output_stream(self.part, compression=None)
        self.sha, self.n_bytes, self.pieces, self.applied = hashlib.sha256(), 0, False, 0

    def _put(self, text: str) -> None:
        content = text.encode()
        self.out.write(content)
        self.sha.update(content)
        self.n_bytes += len(content)

    def add(self, part: int, texts: list[str | None], applied: int) -> None:
        """Texts of one kind, in order."""
        first, between, _ = self.joints
        self.applied += applied
        if part == PIECE:
            self._put((between if self.pieces else first) + between.join(t or "" for t in texts))
            self.pieces = True
        else:
            self.ended(part == TAIL)
            self._put("".join(t or "" for t in texts))

    def ended(self, tail: bool) -> None:
        if tail and self.pieces:
            self._put(self.joints[2])
            self.pieces = False

    def done(self) -> tuple[str, int, str, int]:
        self.ended(True)
        self.out.close()
        self.store.move(self.part, self.place)
        return self.name, self.n_bytes, self.sha.hexdigest(), self.applied

    def dropped(self) -> None:
        self.out.close()
        self.store.delete_file(self.part)


def write_streamed(rows: DataFrame, folder: str, by: list[str], first: str = "", between: str = "\n", last: str = "") -> DataFrame:
    """Write (file, part, *by, piece, applied) as files of exact names: each file's head, its pieces in order, its tail. (file, n_bytes, sha256, applied), a row a file, once all are written.

    Rows are dealt by file, sorted there and written as they come, so no file is held whole anywhere. ``first`` goes before
    the first piece, ``between`` between two, ``last`` after the last one. A file appears under its name once it is whole; one that
    a task wrote twice is the same. Rows without ``part`` are pieces; ``applied`` is summed, 0 where it lacks; a null piece is an empty one.
    """
    part = F.col("part") if "part" in rows.columns else F.lit(PIECE)
    applied = F.coalesce(F.col("applied"), F.lit(0)) if "applied" in rows.columns else F.lit(0)
    wanted = rows.select("file", part.cast("int").alias("part"), *by, "piece", applied.cast("long").alias("applied"))
    dealt = wanted.repartition("file").sortWithinPartitions("file", "part", *by).select("file", "part", "piece", "applied")

    def run(frames):
        import pyarrow as pa

        now, out = None, []
        try:
            for frame in frames:
                names, parts, pieces = frame["file"].to_numpy(), frame["part"].to_numpy(), frame["piece"].tolist()
                sums = frame["applied"].to_numpy()
                new = (names[1:] != names[:-1]) | (parts[1:] != parts[:-1])
                edges = [0, *(new.nonzero()[0] + 1).tolist(), len(names)]
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    if now is None or now.name != names[a]:
                        if now:
                            out.append(now.done())
                        now = _Writing(folder, names[a], first, between, last)
                    now.add(int(parts[a]), pieces[a:b], int(sums[a:b].sum()))
                if out:
                    yield pd.DataFrame(out, columns=["file", "n_bytes", "sha256", "applied"])
                    out = []
            if now:
                out, now = [now.done()], None
                yield pd.DataFrame(out, columns=["file", "n_bytes", "sha256", "applied"])
        except BaseException:
            if now:
                now.dropped()
            raise
        finally:
            pa.default_memory_pool().release_unused()

    return written(dealt.filter("file IS NOT NULL").mapInPandas(run, _REPORT), "files")


def write_totals(report: DataFrame) -> tuple[int, int]:
    """The number of files of a report, and the sum of ``applied``."""
    return tuple(report.agg(F.count(F.lit(1)), F.coalesce(F.sum("applied"), F.lit(0))).first())


def tree(folder: str) -> tuple[list[str], list[str]]:
    """Relative folders and files below a folder, each sorted by the parts of their paths."""
    store, place = located(folder)
    found = store.get_file_info(fs.FileSelector(place, recursive=True, allow_not_found=True))

    def names(kind):
        return sorted((posixpath.relpath(i.path, place) for i in found if i.type == kind), key=lambda p: p.split("/"))

    return names(fs.FileType.Directory), names(fs.FileType.File)


def listed(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = True, folders: bool = False) -> DataFrame:
    """(name, size) of the files of a folder, or of all below it, whose last name fits the pattern; with folders also theirs, whose size is null. Names are relative, that of a file itself is empty.

    One task lists and writes them, as a folder is listed in one go; the driver gets none.
    """

    def run(batches):
        import pyarrow as pa

        for _ in batches:
            store, place = located(folder)
            own = store.get_file_info(place)
            found = [own] if own.is_file else store.get_file_info(fs.FileSelector(place, recursive=recursive))
            for i in range(0, len(found), 10_000):
                some = [x for x in found[i : i + 10_000] if (x.is_file or folders) and fnmatch.fnmatchcase(x.base_name, pattern)]
                names = [posixpath.relpath(x.path, place) if x is not own else "" for x in some]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([x.size if x.is_file else None for x in some], pa.int64())], names=["name", "size"])

    return written(spark.range(1, numPartitions=1).mapInArrow(run, "name string, size long"), "listed")


#: Bytes copied at a time.
BLOCK = 1 << 23


def copy_tree(source: str, dest: str, spark: SparkSession | None = None) -> None:
    """Copy a folder over another, by tasks of the session if there is one; nothing happens without a source."""
    if not exists(source):
        return
    (store, place), (to, there) = located(source), located(dest)
    to.create_dir(there, recursive=True)
    if spark is None:
        fs.copy_files(place, there, source_filesystem=store, destination_filesystem=to)
        return

    def run(frames):
        (store, place), (to, there) = located(source), located(dest)
        for frame in frames:
            for name, size in frame[["name", "size"]].itertuples(index=False):
                if pd.isna(size):
                    to.create_dir(f"{there}/{name}", recursive=True)
                    continue
                to.create_dir(posixpath.dirname(f"{there}/{name}"), recursive=True)
                part = f"{there}/{name}.{uuid.uuid4().hex}.tmp"
                with store.open_input_stream(f"{place}/{name}", compression=None) as f, to.open_output_stream(part, compression=None) as out:
                    while block := f.read(BLOCK):
                        out.write(block)
                to.move(part, f"{there}/{name}")
            yield frame[["name"]]

    found = listed(spark, source, folders=True)
    found.repartition(spark.sparkContext.defaultParallelism).mapInPandas(run, "name string").agg(F.count(F.lit(1))).first()


def swap(new: str, dest: str) -> None:
    """Put a finished folder in the place of another; the old one comes back if that fails."""
    store, place = located(dest)
    fresh, old = located(new)[1], f"{place}.old"
    remove(f"{dest}.old")
    held = exists(dest)
    if held:
        store.move(place, old)
    try:
        store.move(fresh, place)
    except Exception:
        if held:
            store.move(old, place)
        raise
    if held:
        store.delete_dir(old)


def extract_zip(content: bytes, dest: str) -> int:
    """Replace a folder by an archive once all of it is unpacked; a single folder at its top is left out. The number of files."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        names = [safe_name(n) for n in archive.namelist()]
        tops = {n.split("/", 1)[0] for n in names}
        cut = next(iter(tops)) + "/" if len(tops) == 1 and all("/" in n for n in names) else ""
        fresh, n_files = f"{dest}.new", 0
        remove(fresh)
        store, place = located(fresh)
        store.create_dir(place, recursive=True)
        for name in names:
            inner = name.removeprefix(cut)
            if name.endswith("/"):
                store.create_dir(f"{place}/{inner}".rstrip("/"), recursive=True)
            else:
                put(f"{fresh}/{inner}", archive.read(name))
                n_files += 1
    swap(fresh, dest)
    return n_files


#: Entries of an archive that are packed together at most, and the bytes of their files beyond which no more are.
PACKED, PACKED_BYTES = 1000, 1 << 22
_LONG, _SHORT = 0xFFFFFFFF, 0xFFFF  # what an archive says where the number is in a ZIP64 field
_PACKS = "body binary, entries binary"


def _packs(source: str, level: int, names):
    """Names, those of folders ending in a slash -> (body, entries): small archives, and their directories by themselves."""
    store, place = located(source)

    def packed(some: list[tuple[str, bytes]]) -> tuple[bytes, bytes]:
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED, compresslevel=level) as archive:
            for name, content in some:
                if name.endswith("/"):
                    archive.writestr(name, content)
                else:
                    archive.writestr(zipfile.ZipInfo(name), content, zipfile.ZIP_DEFLATED, level)
        whole = held.getvalue()
        return whole[: archive.start_dir], whole[archive.start_dir :]

    some, size = [], 0
    for name in names:
        content = b""
        if not name.endswith("/"):
            with store.open_input_stream(f"{place}/{name}", compression=None) as f:
                content = f.read()
        some.append((name, content))
        size += len(content)
        if len(some) >= PACKED or size >= PACKED_BYTES:
            yield packed(some)
            some, size = [], 0
    if some:
        yield packed(some)


def _moved(entries: bytes, by: int):
    """The records of an archive's directory, for a body that begins so many bytes later; what follows them is left out."""
    at = 0
    while entries[at : at + 4] == b"PK\x01\x02":
        n_name, n_extra, n_said = struct.unpack_from("<3H", entries, at + 28)
        (offset,) = struct.unpack_from("<L", entries, at + 42)
        head, name = bytearray(entries[at : at + 46]), entries[at + 46 : at + 46 + n_name]
        extra, said = entries[at + 46 + n_name : at + 46 + n_name + n_extra], entries[at + 46 + n_name + n_extra : at + 46 + n_name + n_extra + n_said]
        at += 46 + n_name + n_extra + n_said
        sizes = b""
        if extra[:2] == b"\x01\x00":  # sizes, and maybe the place, as 8 bytes each
            n = struct.unpack_from("<H", extra, 2)[0]
            sizes, extra = extra[4 : 4 + n], extra[4 + n :]
            if offset == _LONG:
                sizes, offset = sizes[:-8], struct.unpack("<Q", sizes[-8:])[0]
        offset += by
        if offset >= _LONG:
            sizes, offset = sizes + struct.pack("<Q", offset), _LONG
        if sizes:
            extra = struct.pack("<2H", 1, len(sizes)) + sizes + extra
            struct.pack_into("<H", head, 6, max(45, struct.unpack_from("<H", head, 6)[0]))
        struct.pack_into("<H", head, 30, len(extra))
        struct.pack_into("<L", head, 42, offset)
        yield bytes(head) + name + extra + said


def _put_together(packs, out) -> int:
    """Write one archive of packs, in order; the number of its entries. The directory waits in a file of its own."""
    at, n = 0, 0
    with tempfile.TemporaryFile() as waiting:
        for body, entries in packs:
            for record in _moved(entries, at):
                waiting.write(record)
                n += 1
            out.write(body)
            at += len(body)
        size = waiting.tell()
        waiting.seek(0)
        while block := waiting.read(BLOCK):
            out.write(block)
    if n >= _SHORT or size >= _LONG or at >= _LONG:
        out.write(struct.pack("<4sQ2H2L4Q", b"PK\x06\x06", 44, 45, 45, 0, 0, n, n, size, at) + struct.pack("<4sLQL", b"PK\x06\x07", 0, at + size, 1))
    out.write(struct.pack("<4s4H2LH", b"PK\x05\x06", 0, 0, min(n, _SHORT), min(n, _SHORT), min(size, _LONG), min(at, _LONG), 0))
    return n


def create_package(source: str, dest: str, level: int = 9, spark: SparkSession | None = None) -> int:
    """A deflated archive of a folder, entries of folders first, all sorted; the number of files.

    With a session its tasks list, read and deflate; one writer puts what they made together, a few MB at a time.
    """
    store, place = located(dest)
    store.create_dir(posixpath.dirname(place), recursive=True)
    part = f"{place}.{uuid.uuid4().hex}.tmp"
    if spark is None:
        folders, names = tree(source)
        packs, n_files = _packs(source, level, itertools.chain((f"{f}/" for f in folders), names)), len(names)
    else:
        found = listed(spark, source, folders=True)
        n_files, n = found.agg(F.count("size"), F.count(F.lit(1))).first()
        own, parts = F.when(F.col("size").isNull(), F.concat("name", F.lit("/"))).otherwise(F.col("name")), F.split("name", "/")
        order = [F.col("size").isNotNull(), parts]
        dealt = found.repartitionByRange(max(spark.sparkContext.defaultParallelism, -(-n // (4 * PACKED))), *order).sortWithinPartitions(*order).select(own.alias("name"))

        def run(batches):
            import pyarrow as pa

            names = (n for batch in batches for n in batch.column(0).to_pylist())
            for pack in _packs(source, level, names):
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in pack], names=["body", "entries"])

        packs = rows_in_order(written(dealt.mapInArrow(run, _PACKS), "packs"))
    with store.open_output_stream(part, compression=None) as out:
        _put_together(packs, out)
    store.move(part, place)
    return n_files


def rows_in_order(table: DataFrame):
    """The rows of a table from ``written``, as tuples, in the order of its partitions; a row at a time, read by the driver itself."""
    import pyarrow.parquet as pq

    for name in (n for n in tree(table._folder)[1] if posixpath.basename(n).startswith("part-")):
        source, at = located(f"{table._folder}/{name}")
        with source.open_input_file(at) as f:
            for batch in pq.ParquetFile(f).iter_batches(batch_size=1):
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def build_version(environ: Mapping[str, str] = os.environ) -> str:
    return environ.get("BUILD_VERSION") or f"auto-{datetime.date.today().isoformat()}"
