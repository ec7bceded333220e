"""Token ids in Arrow stream files of equal-length sequences.

Format: documents in rising order of id are cut into shards of neighbouring ids and of about FILE_BYTES at most (a document isn't
cut, so one that is longer makes a longer shard). ``<shard>.arrow`` is an Arrow IPC stream whose
record batches hold ``ids: fixed_size_list<uint16, L>`` (uint32 for vocabularies beyond 65,536) and ``mask: fixed_size_list<bool, L>``: the
shard's ids, each document followed by the end id, cut every L places; the mask is false on the padding of the shard's last
sequence. Every batch
but the last has ``ROWS`` sequences, so sequence i is row i % ROWS of batch i // ROWS, a view into the mapped file without a
copy. ``<shard>.batches.arrow`` has the place in the file where each batch begins, and the end: stores other than the local disk
are read by these ranges, a batch at a time. ``<shard>.index.arrow`` has doc_id, start (in the shard) and n_tokens. A document's place in the whole corpus is its
start plus the tokens of all shards before: one number a shard.

Words between ASCII white space, and marks that trail a word, are encoded apart and joined, which gives what encoding the
whole text gives: the tokenizer drops white space, and no token of its model spans either place. Added tokens such as
<|endoftext|> are matched on raw text and may, so words that contain one are encoded whole (``test_token_files`` and
``test_added_tokens`` hold the ids against those of whole texts).

Nulls: a null text is empty and gets the end id alone; a null id sorts first. Texts of any length are encoded whole. Ties and
repeated rows: rows of one id are ordered by the hash of their text and each is a document. Empty table: no files, no rows.
Other columns are ignored.
"""

from __future__ import annotations

import ctypes
import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm.base import filesystem, load, scratch, text_of
from driftline.llm.wordcache import UnitEncoder, split_words

LENGTH, ROWS, END = 2048, 64, 1
#: A shard is closed once its ids take so many bytes.
FILE_BYTES = 256_000_000
TOKENIZER = "word_bpe_49k.json"
_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
_LIBC: dict[str, ctypes.CDLL] = {}
_TOKENIZERS: dict[str, WordTokenizer] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


class WordTokenizer:
    """A tokenizer file of the word-end kind: white space is dropped, and each run of letters ends in a token of its own kind."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]
        if any(t.normalized or t.content.split() != [t.content] for t in added):
            raise ValueError(f"{path}: added tokens with white space or matched on normalised text need whole texts")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.dtype = np.uint16 if len(self.ends) <= 1 << 16 else np.uint32
        self.units = UnitEncoder(self.encode_units, 600_000)

    def _each(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Units of plain letters are joined by spaces into long lines, whose ids are cut again where a word ends; others go one by one."""
        plain = pc.match_substring_regex(pa.array(units, pa.string()), "^[a-zA-ZÀ-ÖØ-öø-ÿ]+$").to_numpy(zero_copy_only=False)
        letters, others = np.flatnonzero(plain), np.flatnonzero(~plain)
        lines = [" ".join(units[i] for i in letters[a : a + 64].tolist()) for a in range(0, len(letters), 64)]
        flat = np.fromiter((i for e in self._each(lines) for i in e), np.uint32)
        stops = np.flatnonzero(self.ends[flat]) + 1
        if len(stops) != len(letters) or (len(flat) and stops[-1] != len(flat)):  # not what such a file promises
            letters, others, flat, stops = letters[:0], np.arange(len(units)), flat[:0], stops[:0]
        rest = self._each([units[i] for i in others.tolist()])
        lens = np.zeros(len(units), np.int64)
        lens[letters], lens[others] = np.diff(stops, prepend=0), np.fromiter(map(len, rest), np.int64, len(rest))
        out = np.zeros(int(lens.sum()), np.uint32)
        of = np.repeat(np.arange(len(units)), lens)
        is_letter = np.zeros(len(units), bool)
        is_letter[letters] = True
        out[is_letter[of]] = flat
        out[~is_letter[of]] = np.fromiter((i for e in rest for i in e), np.uint32)
        return out, lens

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words, offsets = split_words(texts)
        return self.units(words, offsets, trim=True, uncut=self.added)


def tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer; its cache lives as long as the worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


class ShardWriter:
    """Writes one shard's sequences as they come; holds less than one batch."""

    def __init__(self, sink, dtype: type = np.uint32, length: int = LENGTH, rows: int = ROWS):
        self.length, self.rows, self.held, self.n_held, self.total = length, rows, [], 0, 0
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.sink, self.dtype = sink, dtype
        self.out = pa.ipc.new_stream(sink, self.schema)
        self.places = [self.schema.serialize().size]  # the stream begins with the schema

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = np.zeros(len(ids), bool)
        mask[:real] = True
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)]
        self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.places.append(self.sink.tell())

    def append(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        self.total += len(ids)
        size = self.length * self.rows
        if self.n_held >= size:
            flat = np.concatenate(self.held)
            whole = len(flat) // size * size
            for at in range(0, whole, size):
                self._write(flat[at : at + size], size)
            self.held, self.n_held = [flat[whole:]], len(flat) - whole

    def close(self) -> list[int]:
        """The places of the batches and of the end."""
        if self.n_held:
            flat = np.concatenate(self.held)
            padded = np.zeros(-(-len(flat) // self.length) * self.length, flat.dtype)
            padded[: len(flat)] = flat
            self._write(padded, len(flat))
        self.out.close()
        return self.places


class TokenFile:
    """Random access to a shard: sequences and masks are views into the mapped file (local disk) or into the one batch that was read for them (other stores)."""

    def __init__(self, uri: str):
        fs, path = filesystem(uri)
        with fs.open_input_stream(f"{path.removesuffix('.arrow')}.batches.arrow", compression=None) as f:
            self.places = pa.ipc.open_stream(f.read()).read_all().column("place").to_pylist()
        self.mapped = fs.type_name == "local"
        self.source = pa.memory_map(path) if self.mapped else fs.open_input_file(path)
        self.bytes_read, self.held = 0, (-1, None)
        self.schema = pa.ipc.read_schema(self._range(0, self.places[0]))
        self.length, self.rows = self.schema.field("ids").type.list_size, 1
        self.rows = self.batch(0).num_rows if len(self.places) > 1 else 1

    def _range(self, start: int, end: int) -> pa.Buffer:
        self.source.seek(start)
        self.bytes_read += 0 if self.mapped else end - start
        return self.source.read_buffer(end - start)

    def batch(self, k: int) -> pa.RecordBatch:
        """The k-th batch; the last one asked for is kept."""
        if self.held[0] != k:
            self.held = (k, pa.ipc.read_record_batch(pa.ipc.read_message(self._range(*self.places[k : k + 2])), self.schema))
        return self.held[1]

    def __len__(self) -> int:
        n = len(self.places) - 1
        return (n - 1) * self.rows + self.batch(n - 1).num_rows if n else 0

    def _flat(self, k: int) -> np.ndarray:
        return self.batch(k).column(0).values.to_numpy()

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """ids and mask of the i-th sequence."""
        at = i % self.rows * self.length
        return self._flat(i // self.rows)[at : at + self.length], self.batch(i // self.rows).column(1).values.slice(at, self.length)

    def span(self, start: int, n: int) -> np.ndarray:
        """n ids from a place in the shard; a view if they lie in one batch."""
        size, parts = self.rows * self.length, []
        while n:
            part = self._flat(start // size)[start % size :][:n]
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate([*parts, np.zeros(0, np.uint32)])


def write_tokens(docs: DataFrame, out_dir: str, path: str, length: int = LENGTH, end: int = END, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = FILE_BYTES) -> list[dict]:
    """Encode and write all documents; returns the shards in order: name, base (ids in shards before it), n_docs, n_tokens.

    One row a shard, which has file_bytes or is the last of its task, reaches the driver. Tasks write under names of their own and name the files they finished, so that a
    task run twice does no harm; files of lost attempts are never read.
    """
    deal = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(deal, "doc_id", tie).sortWithinPartitions("doc_id", tie)

    def write(batches):
        words, shard, seq = tokenizer(path), None, 0
        fs, root = filesystem(out_dir)

        def done() -> pa.RecordBatch:
            places = pa.record_batch([pa.array(shard.close(), pa.int64())], names=["place"])
            index.close(), sink.close(), index_sink.close()
            with fs.open_output_stream(f"{root}/{name}.batches.arrow", compression=None) as out, pa.ipc.new_stream(out, places.schema) as stream:
                stream.write_batch(places)
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([seq]), pa.array([n_docs]), pa.array([shard.total])], names=["name", "seq", "n_docs", "n_tokens"])

        for batch in batches:
            for part in batches_of(batch, 8_000_000):
                if shard is None:
                    name, n_docs = uuid.uuid4().hex, 0
                    fs.create_dir(root, recursive=True)
                    sink, index_sink = (fs.open_output_stream(f"{root}/{name}{end_}", compression=None) for end_ in (".arrow", ".index.arrow"))
                    shard, index = ShardWriter(sink, words.dtype, length), pa.ipc.new_stream(index_sink, _INDEX)
                ids, at = words.encode(part.column(1))
                n = np.diff(at) + 1
                ends = np.cumsum(n)
                flat = np.full(int(ends[-1]), end, words.dtype)
                inside = np.ones(len(flat), bool)
                inside[ends - 1] = False
                flat[inside] = ids
                index.write_batch(pa.RecordBatch.from_arrays([part.column(0), pa.array(shard.total + ends - n), pa.array(n)], schema=_INDEX))
                shard.append(flat)
                n_docs += part.num_rows
                if shard.total * flat.itemsize >= file_bytes:
                    yield done()
                    shard, seq = None, seq + 1
        if shard is not None:
            yield done()

    made = ordered.mapInArrow(write, "name string, seq long, n_docs long, n_tokens long").withColumn("part", F.spark_partition_id())
    found, base = [], 0
    for r in sorted(made.collect(), key=lambda r: (r.part, r.seq)):
        found.append({"name": r.name, "base": base, "n_docs": r.n_docs, "n_tokens": r.n_tokens})
        base += r.n_tokens
    return found


def batches_of(batch: pa.RecordBatch, size: int = 3_000_000, column: int = 1):
    """The batch in slices of about so many bytes of text, one row at least. After the last, freed memory goes back to the system: a worker lives on between tasks."""
    group = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // size
    edges = np.r_[0, np.flatnonzero(np.diff(group)) + 1, batch.num_rows]
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b > a:
            yield batch.slice(a, b - a)
    tidy()


def tidy() -> None:
    """Give freed memory back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    if "libc" not in _LIBC:
        _LIBC["libc"] = ctypes.CDLL(None)
    if hasattr(_LIBC["libc"], "malloc_trim"):
        _LIBC["libc"].malloc_trim(0)


def read_back(spark: SparkSession, out_dir: str, shards: list[dict]) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files alone; a task a shard."""

    def read(batches):
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, root = filesystem(out_dir)
                tokens = TokenFile(f"{out_dir}/{name}.arrow")
                for part in pa.ipc.open_stream(fs.open_input_stream(f"{root}/{name}.index.arrow", compression=None)):
                    start, n = part.column(1).to_numpy(), part.column(2).to_numpy()
                    crc = [zlib.crc32(tokens.span(a, k).astype("<u4")) for a, k in zip(start.tolist(), n.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(start + base), part.column(2), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    table = spark.createDataFrame([(s["name"], s["base"]) for s in shards], "name string, base long").repartition(max(1, min(len(shards), 10_000)))
    return table.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch(spark, "tokens")
    return read_back(spark, out, write_tokens(load(spark, sf_dir, "documents"), out, default_tokenizer()))
