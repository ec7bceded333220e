"""A change feed of each nation's ten items of highest revenue, from a stateful stream.

Lines are cut into batches by the day they arrive, written, and fed one after another to a streaming query that is started anew
for each batch on one checkpoint. The state holds order-statistic treaps, one a nation, of its items keyed by (revenue
downwards, item_id): an item's new revenue is a deletion and an insertion, each of which tells a rank; where one of a day's ranks is below
ten, ten nodes are traversed and compared with the stored board. A node's priority is a hash of its item, so the keys alone give a
treap's shape, and the state's bytes are the nodes in order.

A nation can hold most lines, so its items are dealt to shards by hash, about SHARD_ITEMS items in one, and the state's key is the shard: it has a treap a
nation and the shard's prices. Before the shuffle each task adds up the lines of a nation, item and arrival day, so a
hot item comes to a row a day and task. Of a shard's board only changes leave the stream: an item's revenue from a day on, and whether it is
on its shard's board. A nation's ten best are always on their shards' boards; ranking those of each day, which Spark prunes to ten a task
before it shuffles them, and comparing days that follow each other gives the feed.

Lines that lag more than LAG days behind the latest of all earlier batches are dropped. Spark's own watermark can't say this: for
late rows it uses the one of the micro-batch before. So the bound is taken from the written batches, one number each, and put
into the query at its start.

Nulls: a null in sale_id, item_id, vendor_id or line_no is empty in the line's crc32; a line without shipped_at gets a day from it;
without item_id, vendor or nation it is ignored; without amount it counts quantity and price, and 0 if these lack. Repeated lines count again. Of repeated vendors the
least nation, of repeated items the highest price counts. Batches number from 1 to the last; lines that would have a lower number (days before
2024) are fed earlier still, by it. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from driftline.llm.base import load, maybe_broadcast, scratch
from driftline.shared import delete

TOP, BATCHES, LAG, FIRST_DAY, DAYS = 10, 10, 3, 19723, 180
#: Items that a shard has on average.
SHARD_ITEMS = 4096
#: Rows that a task adds up before it passes them on.
COMBINED_ROWS = 400_000
_FED = "item_id long, nation int, day int, arrival int, cents long, units long, price long"
_VERSION = "nation_id int, item_id long, arrival_day long, revenue long, shown boolean"


class Treap:
    """An order-statistic treap over (revenue downwards, item upwards). Nodes are places in lists; 0 is none."""

    def __init__(self, items: np.ndarray, revenues: np.ndarray):
        """From items in the treap's order."""
        n = len(items)
        self.item, self.revenue, self.prio = [0, *items.tolist()], [0, *revenues.tolist()], [0, *priorities(items).tolist()]
        self.left, self.right, self.size = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        self.at = dict(zip(self.item[1:], range(1, n + 1), strict=True))
        prio, left, right, size = self.prio, self.left, self.right, self.size
        spine: list[int] = []  # the right edge of what is built
        for i in range(1, n + 1):
            below = 0
            while spine and prio[spine[-1]] < prio[i]:
                below = spine.pop()
                size[below] = 1 + size[left[below]] + size[right[below]]
            left[i] = below
            if spine:
                right[spine[-1]] = i
            spine.append(i)
        self.root = spine[0] if spine else 0
        while spine:
            i = spine.pop()
            size[i] = 1 + size[left[i]] + size[right[i]]

    def _hang(self, parent: int, before: bool, node: int) -> None:
        if not parent:
            self.root = node
        elif before:
            self.left[parent] = node
        else:
            self.right[parent] = node

    def insert(self, node: int) -> int:
        """Hangs a node in; its rank from 0."""
        item, revenue, prio, left, right, size = self.item, self.revenue, self.prio, self.left, self.right, self.size
        r, it, p = revenue[node], item[node], prio[node]
        at, parent, before, rank = self.root, 0, False, 0
        while at and prio[at] > p:
            size[at] += 1
            parent = at
            before = r > revenue[at] or (r == revenue[at] and it < item[at])
            if before:
                at = left[at]
            else:
                rank += size[left[at]] + 1
                at = right[at]
        self._hang(parent, before, node)
        low = high = 0  # the last nodes of the two halves of what was there
        path = []
        while at:
            path.append(at)
            if revenue[at] > r or (revenue[at] == r and item[at] < it):
                if low:
                    right[low] = at
                else:
                    left[node] = at
                low, at = at, right[at]
            else:
                if high:
                    left[high] = at
                else:
                    right[node] = at
                high, at = at, left[at]
        if low:
            right[low] = 0
        else:
            left[node] = 0
        if high:
            left[high] = 0
        else:
            right[node] = 0
        for at in reversed(path):
            size[at] = 1 + size[left[at]] + size[right[at]]
        size[node] = 1 + size[left[node]] + size[right[node]]
        return rank + size[left[node]]

    def remove(self, node: int) -> int:
        """Takes a node out; the rank it had."""
        item, revenue, prio, left, right, size = self.item, self.revenue, self.prio, self.left, self.right, self.size
        r, it = revenue[node], item[node]
        at, parent, before, rank = self.root, 0, False, 0
        while at != node:
            size[at] -= 1
            parent = at
            before = r > revenue[at] or (r == revenue[at] and it < item[at])
            if before:
                at = left[at]
            else:
                rank += size[left[at]] + 1
                at = right[at]
        a, b = left[node], right[node]
        rank += size[a]
        while a and b:
            if prio[a] > prio[b]:
                size[a] += size[b]
                self._hang(parent, before, a)
                parent, before, a = a, False, right[a]
            else:
                size[b] += size[a]
                self._hang(parent, before, b)
                parent, before, b = b, True, left[b]
        self._hang(parent, before, a or b)
        return rank

    def add(self, item: int, cents: int, prio: int) -> int:
        """Adds to an item's revenue; the least rank that it had or has."""
        node = self.at.get(item)
        if node is None:
            node = self.at[item] = len(self.item)
            for own, x in ((self.item, item), (self.revenue, cents), (self.prio, prio), (self.left, 0), (self.right, 0), (self.size, 0)):
                own.append(x)
            return self.insert(node)
        if not cents:
            return len(self.item)
        old = self.remove(node)
        self.revenue[node] += cents
        return min(old, self.insert(node))

    def first(self, most: int) -> dict[int, int]:
        """The first items of positive revenue in order, with it."""
        out: dict[int, int] = {}
        path, at = [], self.root
        while len(out) < most and (path or at):
            while at:
                path.append(at)
                at = self.left[at]
            at = path.pop()
            if self.revenue[at] <= 0:
                break
            out[self.item[at]] = self.revenue[at]
            at = self.right[at]
        return out

    def nodes(self) -> tuple[np.ndarray, np.ndarray]:
        """Items and revenues in order."""
        items, revenues = np.array(self.item[1:], np.int64), np.array(self.revenue[1:], np.int64)
        order = np.lexsort((items, -revenues))
        return items[order], revenues[order]


def priorities(items: np.ndarray) -> np.ndarray:
    """A mix of the bits, one to one, so no two items tie."""
    x = items.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class Shard:
    """A shard's prices, and each nation's treap and board."""

    def __init__(self, data: bytes | None = None):
        self.ids, self.prices = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.treaps: dict[int, Treap] = {}
        self.kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # nodes of treaps that nothing has touched yet
        self.boards: dict[int, dict[int, int]] = {}
        if data:
            flat, at = np.frombuffer(zlib.decompress(data), "<i8"), 0

            def take(n: int) -> np.ndarray:
                nonlocal at
                at += n
                return flat[at - n : at]

            n_ids, n_nations = take(2).tolist()
            self.ids, self.prices = take(n_ids), take(n_ids)
            for _ in range(n_nations):
                nation, n, top = take(3).tolist()
                self.kept[nation] = take(n), take(n)
                self.boards[nation] = dict(zip(take(top).tolist(), take(top).tolist(), strict=True))

    def dump(self) -> bytes:
        nations = sorted({*self.treaps, *self.kept})
        parts = [np.array([len(self.ids), len(nations)]), self.ids, self.prices]
        for nation in nations:
            items, revenues = self.treaps[nation].nodes() if nation in self.treaps else self.kept[nation]
            board = self.boards.get(nation, {})
            parts += [np.array([nation, len(items), len(board)]), items, revenues, np.array([*board], np.int64), np.array([*board.values()], np.int64)]
        return zlib.compress(np.concatenate(parts).astype("<i8").tobytes(), 1)

    def learn(self, ids: np.ndarray, prices: np.ndarray) -> None:
        """Items and their prices in cents; of an item that comes again the highest counts."""
        ids, prices = np.r_[self.ids, ids], np.r_[self.prices, prices]
        order = np.lexsort((prices, ids))
        ids, prices = ids[order], prices[order]
        last = np.r_[ids[1:] != ids[:-1], np.ones(min(1, len(ids)), bool)]
        self.ids, self.prices = ids[last], prices[last]

    def treap(self, nation: int) -> Treap:
        if nation not in self.treaps:
            none = np.zeros(0, np.int64)
            self.treaps[nation] = Treap(*self.kept.pop(nation, (none, none)))
        return self.treaps[nation]

    def feed(self, nation: np.ndarray, item: np.ndarray, arrival: np.ndarray, cents: np.ndarray, units: np.ndarray) -> list[tuple[int, int, int, int, bool]]:
        """Adds lines, day by day; the changes of the shard's boards: nation, item, day, revenue from then on, whether it is on the board."""
        at = np.searchsorted(self.ids, item)
        there = at < len(self.ids)
        there[there] = self.ids[at[there]] == item[there]
        nation, item, arrival, gain = nation[there], item[there], arrival[there], cents[there] + units[there] * self.prices[at[there]]
        order = np.lexsort((item, nation, arrival))
        nation, item, arrival, gain = (x[order] for x in (nation, item, arrival, gain))
        if not len(item):
            return []
        first = np.flatnonzero(np.r_[True, (arrival[1:] != arrival[:-1]) | (nation[1:] != nation[:-1]) | (item[1:] != item[:-1])])
        gain, nation, item, arrival = np.add.reduceat(gain, first), nation[first], item[first], arrival[first]
        edges = np.r_[np.flatnonzero(np.r_[True, (arrival[1:] != arrival[:-1]) | (nation[1:] != nation[:-1])]), len(item)].tolist()
        items, gains, prios = item.tolist(), gain.tolist(), priorities(item).tolist()
        out = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            own, day = int(nation[a]), int(arrival[a])
            treap = self.treap(own)
            if min([treap.add(items[i], gains[i], prios[i]) for i in range(a, b)]) < TOP:
                board, old = treap.first(TOP), self.boards.get(own, {})
                out += [(own, i, day, r, True) for i, r in board.items() if old.get(i) != r]
                out += [(own, i, day, treap.revenue[treap.at[i]], False) for i in old if i not in board]
                self.boards[own] = board
        return out


def batch_of(arrival: Column) -> Column:
    return F.least(F.lit(BATCHES), 1 + F.floor((arrival - FIRST_DAY) * BATCHES / DAYS)).cast("int")


def prepared(lines: DataFrame, vendors: DataFrame) -> DataFrame:
    """Lines as they are fed: _FED's columns and batch. cents is the revenue of a line that has an amount, units the quantity of one that hasn't; both negative for returned ones."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    h = F.crc32(F.concat_ws(",", *map(text, ("sale_id", "item_id", "vendor_id", "line_no"))))
    sign = F.when(F.col("flag") == "returned", -1).otherwise(1)
    day = F.coalesce(F.unix_date(F.col("shipped_at").cast("date")), FIRST_DAY + h % 150).cast("int")
    arrival = (F.col("day") + h % 7 + F.when(h % 5 == 0, 20).otherwise(0)).cast("int")
    nations = vendors.filter("vendor_id is not null").groupBy(F.col("vendor_id").cast("long").alias("own_vendor")).agg(F.min("nation_id").cast("int").alias("nation"))
    rows = lines.withColumn("day", day).withColumn("arrival", arrival).select(
        F.col("item_id").cast("long").alias("item_id"), F.col("vendor_id").cast("long").alias("vendor_id"), "day", "arrival",
        F.coalesce(sign * F.floor(100 * F.col("amount") + 0.5), F.lit(0)).cast("long").alias("cents"),
        F.when(F.col("amount").isNull(), F.coalesce(sign * F.col("quantity"), F.lit(0))).otherwise(0).cast("long").alias("units"),
    )
    joined = rows.join(maybe_broadcast(nations, vendors.count()), F.col("vendor_id") == F.col("own_vendor"), "left")
    return joined.select("item_id", "nation", "day", "arrival", "cents", "units", F.lit(-1).cast("long").alias("price"), batch_of(F.col("arrival")).alias("batch"))


def catalogue(items: DataFrame) -> DataFrame:
    """Items as they are fed: prices in cents, 0 where none is known."""
    zero = lambda kind, name: F.lit(-1).cast(kind).alias(name)
    price = F.coalesce(F.floor(100 * F.col("price") + 0.5), F.lit(0)).cast("long").alias("price")
    return items.filter("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), zero("int", "nation"), zero("int", "day"), zero("int", "arrival"), zero("long", "cents"), zero("long", "units"), price)


def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up a task's lines by shard, nation, item and arrival day; items pass on."""
    keys = ["shard", "nation", "item_id", "arrival", "price"]
    held: list[pa.Table] = []
    rows = 0

    def added() -> pa.Table:
        whole = pa.concat_tables(held).group_by(keys).aggregate([("cents", "sum"), ("units", "sum")])
        return whole.rename_columns([c.removesuffix("_sum") for c in whole.column_names]).select([*keys, "cents", "units"])

    for batch in batches:
        held.append(pa.Table.from_batches([batch]).select([*keys, "cents", "units"]))
        rows += batch.num_rows
        if rows >= COMBINED_ROWS:
            held = [added()]
            rows = len(held[0])
            if rows >= COMBINED_ROWS / 2:
                yield from held[0].combine_chunks().to_batches()
                held, rows = [], 0
    if held:
        yield from added().combine_chunks().to_batches()


def _updated(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    shard = Shard(state.get[0] if state.exists else None)
    columns = [[f[c].to_numpy(np.int64) for c in ("nation", "item_id", "arrival", "cents", "units", "price")] for f in frames]
    nation, item, arrival, cents, units, price = (np.concatenate(x) for x in zip(*columns, strict=True))
    new = price >= 0
    if new.any():
        shard.learn(item[new], price[new])
    out = shard.feed(*(x[~new] for x in (nation, item, arrival, cents, units)))
    state.update((shard.dump(),))
    if out:
        yield pd.DataFrame(out, columns=["nation_id", "item_id", "arrival_day", "revenue", "shown"]).astype({"nation_id": "int32"})


class BoardStream:
    """The streaming query's folders under one shared folder: fed batches, checkpoint and what it wrote."""

    def __init__(self, spark: SparkSession, folder: str, shards: int):
        self.spark, self.folder, self.shards = spark, folder, shards
        self.source, self.out = f"{folder}/fed", f"{folder}/versions"
        self.fs = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self.fs.mkdirs(self._path(self.source))

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def offer(self, written: str, name: str) -> None:
        """Moves a written folder to where the stream looks, in one step."""
        if self.fs.exists(self._path(written)) and not self.fs.rename(self._path(written), self._path(f"{self.source}/{name}")):
            raise RuntimeError(f"{written} can't be moved to {self.source}/{name}")

    def run(self, since: int | None) -> None:
        """Starts the query on the checkpoint, and ends once all that is there has been read. since: lines of an earlier day are dropped."""
        fed = self.spark.readStream.schema(_FED).option("recursiveFileLookup", "true").parquet(self.source)
        real = F.col("nation").isNotNull() & F.col("item_id").isNotNull()
        fresh = real if since is None else real & ((F.col("day") >= since) | (F.col("price") >= 0))
        rows = fed.filter(fresh).select(F.pmod(F.xxhash64("item_id"), F.lit(self.shards)).cast("int").alias("shard"), "nation", "item_id", "arrival", "price", "cents", "units")
        added = rows.mapInArrow(combined, "shard int, nation int, item_id long, arrival int, price long, cents long, units long")
        changes = added.groupBy("shard").applyInPandasWithState(_updated, _VERSION, "data binary", "append", GroupStateTimeout.NoTimeout)
        sink = changes.writeStream.format("parquet").outputMode("append").option("path", self.out).option("checkpointLocation", f"{self.folder}/checkpoint")
        sink.trigger(availableNow=True).start().awaitTermination()

    def versions(self) -> DataFrame:
        """nation_id, item_id, arrival_day, revenue from that day on, shown: whether it is on its shard's board from then on."""
        return self.spark.read.schema(_VERSION).parquet(self.out)

    def forget(self) -> None:
        """Deletes what was fed and the state; the versions stay."""
        for name in (self.source, f"{self.folder}/checkpoint"):
            delete(self.spark, name)


def board_changes(versions: DataFrame) -> DataFrame:
    """The feed: nation_id, arrival_day, item_id, batch, change, old_rank, new_rank, revenue."""
    by_day = Window.partitionBy("nation_id").orderBy("arrival_day")
    days = versions.select("nation_id", "arrival_day").distinct().withColumn("k", F.row_number().over(by_day))  # a row a nation and day
    last = F.max("k").over(Window.partitionBy("nation_id"))
    days = days.withColumn("n", last)
    own = Window.partitionBy("nation_id", "item_id").orderBy("k")
    spans = versions.join(days, ["nation_id", "arrival_day"]).withColumn("until", F.coalesce(F.lead("k").over(own), F.col("n") + 1))
    spans = spans.select("nation_id", "item_id", "revenue", "shown", F.col("k").alias("since"), "until")
    each = spans.filter("shown").select("nation_id", "item_id", "revenue", F.explode(F.sequence("since", F.col("until") - 1)).alias("k"))
    ranked = each.withColumn("rank", F.row_number().over(Window.partitionBy("nation_id", "k").orderBy(F.desc("revenue"), "item_id"))).filter(F.col("rank") <= TOP)
    # at most ten rows a nation and day from here on
    marks = ranked.select("nation_id", "item_id", "k", F.col("rank").alias("new_rank"), F.lit(None).cast("int").alias("old_rank"), "revenue")
    past = ranked.select("nation_id", "item_id", (F.col("k") + 1).alias("k"), F.lit(None).cast("int").alias("new_rank"), F.col("rank").alias("old_rank"), F.lit(None).cast("long").alias("revenue"))
    both = marks.unionAll(past).groupBy("nation_id", "item_id", "k").agg(F.max("old_rank").alias("old_rank"), F.max("new_rank").alias("new_rank"), F.max("revenue").alias("revenue"))
    changed = both.filter(~F.col("old_rank").eqNullSafe(F.col("new_rank"))).join(days, ["nation_id", "k"])
    gone = changed.filter(F.col("new_rank").isNull()).drop("revenue")
    after = spans.select("nation_id", "item_id", "revenue", "since", "until")
    gone = gone.join(after, ["nation_id", "item_id"]).filter((F.col("k") >= F.col("since")) & (F.col("k") < F.col("until")))
    change = F.when(F.col("old_rank").isNull(), "enter").when(F.col("new_rank").isNull(), "exit").otherwise("move")
    rows = changed.filter(F.col("new_rank").isNotNull()).unionByName(gone.drop("since", "until"))
    return rows.select("nation_id", "arrival_day", "item_id", batch_of(F.col("arrival_day")).alias("batch"), change.alias("change"), "old_rank", "new_rank", "revenue")


def leaderboard(spark: SparkSession, lines: DataFrame, vendors: DataFrame, items: DataFrame) -> DataFrame:
    """Cuts the lines into batches, feeds them in order and returns the feed."""
    folder = scratch(spark, "leaderboard")
    prepared(lines, vendors).write.partitionBy("batch").parquet(f"{folder}/cut")
    catalogue(items).write.parquet(f"{folder}/items")
    latest = spark.read.schema(f"{_FED}, batch int").parquet(f"{folder}/cut").groupBy("batch").agg(F.max("day").alias("day")).collect()  # a row a batch
    stream = BoardStream(spark, folder, max(1, -(-items.count() // SHARD_ITEMS)))
    stream.offer(f"{folder}/items", "items")
    since = None
    for row in sorted(latest):
        stream.offer(f"{folder}/cut/batch={row.batch}", f"lines{row.batch}")
        stream.run(since)
        since = max(row.day - LAG, row.day - LAG if since is None else since)
    if not latest:
        return board_changes(spark.createDataFrame([], _VERSION))
    stream.forget()
    return board_changes(stream.versions())


def op12_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaderboard(spark, *(load(spark, sf_dir, t) for t in ("sale_lines", "vendors", "items")))


ORACLE = """
with crc as (
  select list(x order by i) as tab from (
    select i, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) as x from range(256) r(i))
), hashed as (
  select l.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(key, ''), lambda ch: ascii(ch)::bigint)), lambda c, b: xor(c // 256, tab[1 + xor(c, b) % 256])), 4294967295) as h
  from (select *, coalesce(sale_id::varchar, '') || ',' || coalesce(item_id::varchar, '') || ',' || coalesce(vendor_id::varchar, '') || ',' || coalesce(line_no::varchar, '') as key from sale_lines) l, crc
), dated as (
  select *, coalesce(shipped_at::date - date '1970-01-01', 19723 + h % 150) as s from hashed
), arrived as (
  select *, s + h % 7 + case when h % 5 = 0 then 20 else 0 end as a from dated
), cut as (
  select *, least(10, 1 + floor((a - 19723) * 10 / 180))::int as batch from arrived
), bounds as (
  select batch, max(m) over (order by batch rows between unbounded preceding and 1 preceding) as m from (select batch, max(s) as m from cut group by batch)
), v as (
  select vendor_id, min(nation_id) as nation_id from vendors group by vendor_id
), i as (
  select item_id, max(price) as price from items group by item_id
), daily as (
  select v.nation_id, c.item_id, c.a, sum(coalesce(floor(100 * amount + 0.5), quantity * floor(100 * i.price + 0.5), 0) * case when flag = 'returned' then -1 else 1 end)::bigint as gain
  from cut c join bounds b using (batch) join v on v.vendor_id = c.vendor_id join i on i.item_id = c.item_id
  where v.nation_id is not null and (b.m is null or c.s + 3 >= b.m) group by all
), grid as (
  select d.nation_id, d.a, p.item_id from (select distinct nation_id, a from daily) d join (select distinct nation_id, item_id from daily) p using (nation_id)
), running as (
  select nation_id, a, item_id, sum(coalesce(gain, 0)) over (partition by nation_id, item_id order by a)::bigint as revenue from grid left join daily using (nation_id, item_id, a)
), ranked as (
  select *, case when revenue > 0 then row_number() over (partition by nation_id, a order by revenue desc, item_id) end as place from running
), kept as (
  select *, case when place <= 10 then place end as new_rank from ranked
), both_ranks as (
  select *, lag(new_rank) over (partition by nation_id, item_id order by a) as old_rank from kept
)
select nation_id::int as nation_id, a::bigint as arrival_day, item_id, least(10, 1 + floor((a - 19723) * 10 / 180))::int as batch,
  case when old_rank is null then 'enter' when new_rank is null then 'exit' else 'move' end as change, old_rank::int as old_rank, new_rank::int as new_rank, revenue
from both_ranks where old_rank is distinct from new_rank"""
