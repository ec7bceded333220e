"""What the operators share: tables, the shared scratch folder and written intermediate tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.shared import discard, made, release, scratch, shared_dir, written  # noqa: F401  the operators take them from here

#: A side of a join is broadcast only when it was counted and has at most so many (narrow) rows.
BROADCAST_ROWS = 100_000
#: Rows that hold lists or texts are measured as well: at most so many bytes.
BROADCAST_BYTES = 64_000_000
#: A sieve is a Bloom filter in slots of 32,768 bits, two bits a key, about BITS_PER_KEY bits for each. At most SLOTS slots
#: (32 MB) are broadcast at a time; a larger sieve goes out in segments, SEGMENTS at most. Beyond that its bits are shared
#: by more keys, and it lets more rows through to the join behind it, which is exact.
BITS_PER_KEY, SLOTS, SEGMENTS = 16, 8192, 8


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Rows of an Arrow batch where rows hold whole texts, or two of them.
TEXT_BATCH, PAIR_BATCH = 1000, 50


def materialise(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """``written``, with batch_rows rows in an Arrow batch of this write, which then has 4 MB at most; the session's settings are put back."""
    spark = df.sparkSession
    held = {"spark.sql.execution.arrow.maxRecordsPerBatch": batch_rows, "spark.sql.execution.arrow.maxBytesPerBatch": 4_000_000} if batch_rows else {}
    before = {k: spark.conf.get(k, None) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, str(v))
        return written(df, name)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def maybe_broadcast(df: DataFrame, rows: int, most: int | None = None, n_bytes: int = 0) -> DataFrame:
    """A hint to broadcast a counted (and, where rows hold lists or texts, measured) table, if it is small enough; else Spark joins by shuffling."""
    return F.broadcast(df) if rows <= (BROADCAST_ROWS if most is None else most) and n_bytes <= BROADCAST_BYTES else df


def _places(column: str) -> tuple[Column, Column, Column]:
    """A number for the slot, and two places in it."""
    x = F.xxhash64(column)
    return F.shiftrightunsigned(x, 32), x.bitwiseAND(32767), F.shiftright(x, 15).bitwiseAND(32767)


def sieve(keys: DataFrame, column: str, rows: int) -> DataFrame:
    """(slot, bits), written: the bits of so many keys. Keys go to their slots first, so that no task builds all slots."""
    slots = max(1, min(SLOTS * SEGMENTS, -(-rows * BITS_PER_KEY // 32768)))
    number, one, two = _places(column)
    each = keys.select((number % slots).cast("int").alias("slot"), one.alias("one"), two.alias("two")).repartition("slot")
    each = each.select("slot", F.explode(F.array("one", "two")).alias("p"))
    out = materialise(each.groupBy("slot").agg(F.bitmap_construct_agg("p").alias("bits")), "sieve")
    out._slots = slots
    return out


def _sifted(df: DataFrame, column: str, bits: DataFrame, passing: bool) -> DataFrame:
    names = fresh(df, "sieve_slot", "sieve_one", "sieve_two", "sieve_own", "sieve_bits")
    slot, one, two, own, held = names
    number, first, second = _places(column)
    rows = df.withColumns({slot: (number % bits._slots).cast("int"), one: first, two: second})
    table = bits.toDF(own, held)

    def there(at: str) -> Column:
        byte = F.ascii(F.decode(F.substring(held, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1)), "ISO-8859-1"))
        return F.get(F.lit([1, 2, 4, 8, 16, 32, 64, 128]), F.col(at).bitwiseAND(7).cast("int")).bitwiseAND(byte) != 0

    found = F.coalesce(there(one) & there(two), F.lit(False))
    parts = []
    for low in range(0, bits._slots, SLOTS):
        part, side = rows, table
        if bits._slots > SLOTS:
            part, side = (x.filter((F.col(c) >= low) & (F.col(c) < low + SLOTS)) for x, c in ((rows, slot), (table, own)))
        parts.append(part.join(F.broadcast(side), F.col(slot) == F.col(own), "left").filter(found if passing else ~found))  # SLOTS rows of 4 KB at most
    return reduce(DataFrame.unionAll, parts).select(*df.columns)


def passing(df: DataFrame, column: str, bits: DataFrame) -> DataFrame:
    """The rows whose column may be among the sieve's keys: all that are, and a few others. Nothing is shuffled."""
    return _sifted(df, column, bits, True)


def failing(df: DataFrame, column: str, bits: DataFrame) -> DataFrame:
    """The other rows."""
    return _sifted(df, column, bits, False)


def narrowed(df: DataFrame, column: str, keys: DataFrame, key: str, rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides for an exact join of a wide table with counted keys: the keys to broadcast if they are few, else the table's rows that pass a sieve, so that only candidates are shuffled."""
    return (df, F.broadcast(keys)) if rows <= BROADCAST_ROWS else (passing(df, column, sieve(keys, key, rows)), keys)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until no column of the table has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def drop_rows(docs: DataFrame, gone: DataFrame, id_col: str, mark: Column, name: str) -> DataFrame:
    """docs without the rows whose id and mark are in ``gone`` (id, mark), a written table; ids may be null."""
    gone = materialise(gone.distinct(), name)
    one, two, three = fresh(docs, "gone_id", "gone_mark", "own_mark")
    rows, gone = gone.count(), gone.toDF(one, two)
    marked, same = docs.withColumn(three, mark), F.col(id_col).eqNullSafe(F.col(one)) & F.col(three).eqNullSafe(F.col(two))
    if rows <= BROADCAST_ROWS:
        return marked.join(F.broadcast(gone), same, "left_anti").select(*docs.columns)
    bits = sieve(gone, two, rows)
    return failing(marked, three, bits).unionAll(passing(marked, three, bits).join(gone, same, "left_anti")).select(*docs.columns)


def text_of(column: str) -> Column:
    """The text, a null one being empty."""
    return F.coalesce(F.col(column), F.lit(""))


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5; 0 is held out. A null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5


def filesystem(uri: str):
    """pyarrow's file system and the path in it, for a folder URI that executors reach."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
