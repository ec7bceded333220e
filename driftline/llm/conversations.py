"""Repair of conversation structure: the cheapest edits that give a conversation's roles the form ``(s?(ua)+)?``.

The grammar has four states: 0 nothing yet, 1 after the system turn, 2 after a user turn, 3 after an assistant turn; 0 and 3
may end. What a rerole or an insertion writes follows from the state alone, so edits are a string of K(eep), R(erole),
D(elete) and I(nsert). Within a batch of whole conversations one DuckDB recursive query advances all of them by a turn at each recursion, and keeps for each
conversation and state the least (cost, edits). Two edit strings of equal cost that reach the same state are never one the
beginning of the other (it would have to add insertions, which cost), so the least string stays least whatever follows. Two
insertions in a row are never cheapest: what they reach, deleting or nothing reaches for less.

Conversations are dealt to partitions by hash, sorted there and cut into batches of whole conversations. One of more than SEGMENT
turns is numbered by ranges (``operators.numbering``) and cut into segments, which are dealt by hash of conversation and
segment: the same query then gives each segment's least (cost, edits) from every state to every state, and the segments are
joined in order. So no task holds a whole long conversation's texts; only its edits, a letter a turn, which are one value of the
result anyway, and its digest, which SHA-256 takes in order, run through one task, as a stream.

Nulls: null roles, texts, turns and conv_ids are one space (in the texts and in the damage's crc32); null turns come first; a
null conv_id is a conversation. Ties: turns of equal number are taken by role, then text. Empty and very long texts are turns like others. A role without a first letter s, u
or a can only be reroled or deleted. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.base import load, materialise, maybe_broadcast
from driftline.operators.numbering import numbered

#: Longer conversations are cut into segments of so many turns.
SEGMENT = 1024
#: A batch is closed once it has so many turns, or so many bytes.
BATCH_ROWS, BATCH_BYTES = 20_000, 16_000_000
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANKS = r"\x20\x09-\x0D"
#: By state: what may be kept, the role that a rerole or an insertion writes, and the state that it leads to.
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ROLE, NEXT = ("user", "user", "assistant", "user"), (2, 2, 3, 2)
STATS = ("turns", "blank", "duplicate", "truncated", "illegal")


def moves() -> list[tuple[int, str, int, int, str]]:
    """(state, turn, next state, cost, edits). A turn is its role's first letter, o for others, in capitals if truncated; x has to go."""
    out = []
    for state in range(4):
        for turn in "suaoSUAOx":
            for at, cost, edits in ((state, 0, ""), (NEXT[state], INSERT, "I")):
                out.append((state, turn, at, cost + DELETE, edits + "D"))
                if turn != "x":
                    more = cost + TRUNCATED * turn.isupper()
                    out.append((state, turn, NEXT[at], more + REROLE, edits + "R"))
                    if turn.lower() in KEPT[at]:
                        out.append((state, turn, KEPT[at][turn.lower()], more + KEEP, edits + "K"))
    return out


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: the drill's damage by crc32(``conv_id:turn``) % 20; copies is 0 for a row that goes and 2 for one that is repeated."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    return turns.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(blank("role")).alias("role"), text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def faults(text: str = "text") -> tuple[Column, Column]:
    """Whether a text is blank, and whether it is truncated (blank ones count)."""
    return ~F.col(text).rlike(f"[^{BLANKS}]"), ~F.col(text).rlike(rf"[.!?][{BLANKS}]*\z")


_FOLDED = """
create or replace temp table folded as
with marked as (
  select conv, pos, initial, blank, truncated, coalesce(repeated, row_number() over (partition by conv, role, text order by pos) > 1) and not blank as duplicate,
    lag(initial) over (partition by conv order by pos) || initial as pair
  from turns)
select conv, count(*) as turns, count(*) filter (blank) as blank, count(*) filter (duplicate) as duplicate,
  count(*) filter (truncated and not blank and not duplicate) as truncated, count(*) filter (pair not in ('su', 'ua', 'au')) as illegal,
  string_agg(case when blank or duplicate then 'x' when initial not in ('s', 'u', 'a') then case when truncated then 'O' else 'o' end when truncated then upper(initial) else initial end, '' order by pos) as letters
from marked group by conv"""
_WALK = """
with recursive walk(conv, entry, state, pos, best) using key (conv, entry, state) as (
  select conv, entry, entry, 0::bigint, {'cost': 0::bigint, 'edits': ''} from folded, entries
  union
  select w.conv, w.entry, m.nxt, min(w.pos) + 1, min({'cost': w.best.cost + m.cost, 'edits': w.best.edits || m.edits})
  from walk w join folded f on f.conv = w.conv join moves m on m.state = w.state and m.turn = substr(f.letters, w.pos + 1, 1)
  where w.pos < f.turns group by w.conv, w.entry, m.nxt)
select conv, entry, state, best.cost as cost, best.edits as edits, f.turns, f.blank, f.duplicate, f.truncated, f.illegal
from walk join folded f using (conv) where pos = f.turns order by conv, entry, state"""


class Walker:
    """A task's DuckDB connection. It holds one batch at a time, in memory only."""

    def __init__(self, entries: tuple[int, ...]):
        import duckdb

        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "1GB", "temp_directory": ""})
        self.con.execute("create table moves(state int, turn varchar, nxt int, cost bigint, edits varchar)")
        self.con.executemany("insert into moves values (?, ?, ?, ?, ?)", moves())
        self.con.execute("create table entries(entry int)")
        self.con.executemany("insert into entries values (?)", [(e,) for e in entries])

    def __call__(self, turns: pa.Table) -> pa.Table:
        """turns (conv, pos, role, text, initial, blank, truncated, repeated) -> conv, entry, state, cost, edits and the counts of faults, in order."""
        self.con.register("turns", turns)
        self.con.execute(_FOLDED)
        self.con.unregister("turns")
        return self.con.sql(_WALK).to_arrow_table()


def applied(edits: str, state: int, roles: list[str], texts: list[str]) -> list[str]:
    """The repaired turns, ``role:text``."""
    out, i = [], 0
    for e in edits:
        if e == "I":
            out.append(f"{ROLE[state]}:")
            state = NEXT[state]
            continue
        if e == "K":
            out.append(f"{roles[i]}:{texts[i]}")
            state = KEPT[state][roles[i][:1]]
        elif e == "R":
            out.append(f"{ROLE[state]}:{texts[i]}")
            state = NEXT[state]
        i += 1
    return out


def _least(states: dict[int, tuple[int, str]]) -> tuple[int, str]:
    """The least (cost, edits) of those that may end, by state; after a user turn an assistant's is inserted."""
    return min(((c + INSERT, e + "I") if s == 2 else (c, e)) for s, (c, e) in states.items() if s != 1)


def _wholes(batches, keys: int):
    """Tables of whole groups, of rows sorted by the first columns, and where each group begins and the end."""
    held: list[pa.RecordBatch] = []
    rows = size = 0

    def table() -> tuple[pa.Table, np.ndarray]:
        whole = pa.Table.from_batches(held)
        new = np.zeros(len(whole), bool)
        new[:1] = True
        for k in range(keys):
            codes = pc.dictionary_encode(whole.column(k).combine_chunks(), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            new[1:] |= codes[1:] != codes[:-1]
        return whole, np.r_[np.flatnonzero(new), len(whole)]

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= BATCH_ROWS or size >= BATCH_BYTES:
            whole, begin = table()
            if len(begin) > 2:  # the last group may go on
                yield whole.slice(0, begin[-2]), begin[:-1]
                held = whole.slice(begin[-2]).to_batches()
                rows, size = len(whole) - begin[-2], sum(b.nbytes for b in held)
    if held:
        yield table()


def _prepared(whole: pa.Table, begin: np.ndarray) -> pa.Table:
    counts = np.diff(begin)
    conv = np.repeat(np.arange(len(counts)), counts)
    pos = np.arange(len(whole)) - np.repeat(begin[:-1], counts)
    return pa.table({"conv": conv, "pos": pos, **{c: whole.column(c) for c in ("role", "text", "initial", "blank", "truncated", "repeated")}})


def _of(found: pa.Table) -> tuple[dict[tuple[int, int], dict[int, tuple[int, str]]], dict[int, list[int]]]:
    """By (conv, entry) the least (cost, edits) of each state, and by conv the counts."""
    best, stats = {}, {}
    for conv, entry, state, cost, edits, *counts in zip(*(c.to_pylist() for c in found.columns), strict=True):
        best.setdefault((conv, entry), {})[state] = cost, edits
        stats[conv] = counts
    return best, stats


def _fields(kind: T.DataType) -> list[T.StructField]:
    return [T.StructField("conv_id", kind), *(T.StructField(c, T.LongType()) for c in (*STATS, "cost")), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]


def _short(rows: DataFrame) -> DataFrame:
    """conv_id, counts, cost, audit and digest of conversations that are not cut."""
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn")]
    dealt = rows.repartition("conv_id").sortWithinPartitions(*order, "role", "text")
    dealt = dealt.select("conv_id", "role", "text", "initial", "blank", "truncated", F.lit(None).cast("boolean").alias("repeated"))

    def run(batches):
        walk = None
        for whole, begin in _wholes(batches, 1):
            walk = walk or Walker((0,))
            best, stats = _of(walk(_prepared(whole, begin)))
            roles, texts = whole.column("role").to_pylist(), whole.column("text").to_pylist()
            out = []
            for conv, (a, b) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)):
                cost, audit = _least(best[conv, 0])
                sha = hashlib.sha256("\n".join(applied(audit, 0, roles[a:b], texts[a:b])).encode("utf-8", "surrogatepass")).hexdigest()
                out.append((*stats[conv], cost, audit, sha))
            ids = whole.column("conv_id").take(pa.array(begin[:-1])).combine_chunks()
            numbers = [pa.array(c, pa.int64()) for c in list(zip(*out, strict=True))[:6]]
            yield pa.RecordBatch.from_arrays([ids, *numbers, *(pa.array([r[k] for r in out], pa.string()) for k in (6, 7))], names=["conv_id", *STATS, "cost", "audit", "repaired_sha256"])

    return dealt.mapInArrow(run, T.StructType(_fields(rows.schema["conv_id"].dataType)))


def _long(rows: DataFrame, size: int) -> DataFrame:
    """The same of conversations that are cut into segments."""
    spark, kind = rows.sparkSession, rows.schema["conv_id"].dataType
    placed = numbered(rows, ["conv_id"], ["turn", "role", "text"], "pos")
    # a turn repeats an earlier one if it isn't the first of its role and text; firsts are joined by place, so no key is hot
    firsts = placed.groupBy("conv_id", "role", "text").agg(F.min("pos").alias("pos")).select(F.col("conv_id").alias("first_id"), F.col("pos").alias("first_pos"))
    marked = placed.join(firsts, F.col("conv_id").eqNullSafe(F.col("first_id")) & (F.col("pos") == F.col("first_pos")), "left")
    cut = marked.select("conv_id", F.floor(F.col("pos") / size).cast("long").alias("segment"), "pos", "role", "text", "initial", "blank", "truncated", F.col("first_pos").isNull().alias("repeated"))
    segments = materialise(cut.repartition("conv_id", "segment").sortWithinPartitions(F.asc_nulls_first("conv_id"), "segment", "pos"), "segments")

    def dealt(names: tuple[str, ...]) -> DataFrame:
        table = segments.repartition("conv_id", "segment").sortWithinPartitions(F.asc_nulls_first("conv_id"), "segment", "pos")
        return table.select("conv_id", "segment", *names)

    def walked(batches):
        walk = None
        for whole, begin in _wholes(batches, 2):
            walk = walk or Walker((0, 1, 2, 3))
            found = walk(_prepared(whole, begin))
            first = pa.array(begin[:-1])
            ends = [whole.column("initial").take(x).combine_chunks() for x in (first, pa.array(begin[1:] - 1))]
            at = found.column("conv").combine_chunks()
            keys = [whole.column(c).take(first).combine_chunks().take(at) for c in ("conv_id", "segment")]
            table = pa.table([*keys, *(x.take(at) for x in ends), *found.columns[1:]], names=["conv_id", "segment", "opens", "closes", *found.column_names[1:]])
            yield from table.cast(out_schema).to_batches()

    numbers = ("cost", "edits", *STATS)
    fields = [T.StructField("conv_id", kind), T.StructField("segment", T.LongType()), T.StructField("opens", T.StringType()), T.StructField("closes", T.StringType()), T.StructField("entry", T.IntegerType()), T.StructField("state", T.IntegerType())]
    fields += [T.StructField(c, T.StringType() if c == "edits" else T.LongType()) for c in numbers]
    from pyspark.sql.pandas.types import to_arrow_schema

    out_schema = to_arrow_schema(T.StructType(fields))
    paths = materialise(dealt(("role", "text", "initial", "blank", "truncated", "repeated")).mapInArrow(walked, T.StructType(fields)), "segment-paths")

    def joined(batches):
        """A row a segment: the state it begins in and its edits; the last one's has the counts and the cost."""
        for conv_id, segs in _by_conversation(batches):
            states: dict[int, tuple[int, str, tuple | None]] = {0: (0, "", None)}  # cost, edits, and the segments' choices as a chain
            total, closes = [0] * 5, None
            for segment, opens, last, best, counts in segs:
                total = [x + y for x, y in zip(total, counts, strict=True)]
                total[4] += closes is not None and closes + opens not in ("su", "ua", "au")
                closes, after = last, {}
                for (entry, state), (cost, edits) in best.items():
                    if entry in states:
                        c, e, chain = states[entry]
                        found = (c + cost, e + edits)
                        if state not in after or found < after[state][:2]:
                            after[state] = (*found, (chain, segment, entry, edits))
                states = after
            cost, audit = _least({s: x[:2] for s, x in states.items()})
            state = min((s for s in states if s != 1), key=lambda s: (states[s][0] + INSERT, states[s][1] + "I") if s == 2 else states[s][:2])
            chain, pieces, tail = states[state][2], [], "I" if state == 2 else ""
            while chain:
                chain, segment, entry, edits = chain
                pieces.append((segment, entry, edits + tail))
                tail = ""
            pieces.reverse()
            n = len(pieces)
            yield pa.RecordBatch.from_arrays([pa.array([conv_id] * n, ids), pa.array([p[0] for p in pieces], pa.int64()), pa.array([p[1] for p in pieces], pa.int32()), pa.array([p[2] for p in pieces], pa.string()), *(pa.array([None] * (n - 1) + [v], pa.int64()) for v in (*total, cost))], names=["conv_id", "segment", "entry", "edits", *STATS, "cost"])

    def _by_conversation(batches):
        """conv_id, and its segments in order: number, first and last initials, least (cost, edits) by (entry, state), counts."""
        own, at, segs = None, None, []
        for batch in batches:
            for conv_id, segment, opens, closes, entry, state, cost, edits, *counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != (conv_id,):
                    if own:
                        yield own[0], segs
                    own, at, segs = (conv_id,), None, []
                if at != segment:
                    at = segment
                    segs.append((segment, opens, closes, {}, counts))
                segs[-1][3][entry, state] = cost, edits
        if own:
            yield own[0], segs

    ids = to_arrow_schema(T.StructType([T.StructField("x", kind)])).field(0).type
    chosen_fields = [T.StructField("conv_id", kind), T.StructField("segment", T.LongType()), T.StructField("entry", T.IntegerType()), T.StructField("edits", T.StringType()), *(T.StructField(c, T.LongType()) for c in (*STATS, "cost"))]
    in_order = paths.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "segment", "entry", "state")
    chosen = materialise(in_order.mapInArrow(joined, T.StructType(chosen_fields)), "segment-edits")

    # each segment's choice comes before its turns, so that texts are repaired as they stream
    head = chosen.select("conv_id", "segment", F.lit(-1).cast("long").alias("pos"), F.lit("").alias("role"), F.lit("").alias("text"), "entry", "edits")
    body = segments.select("conv_id", "segment", "pos", "role", "text", F.lit(None).cast("int").alias("entry"), F.lit(None).cast("string").alias("edits"))
    both = head.unionByName(body).repartition("conv_id", "segment").sortWithinPartitions(F.asc_nulls_first("conv_id"), "segment", "pos")

    def repaired(batches):
        for whole, begin in _wholes(batches, 2):
            roles, texts, entries, edits = (whole.column(c).to_pylist() for c in ("role", "text", "entry", "edits"))
            lines = [applied(edits[a], entries[a], roles[a + 1 : b], texts[a + 1 : b]) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
            first = pa.array(begin[:-1])
            yield pa.RecordBatch.from_arrays([*(whole.column(c).take(first).combine_chunks() for c in ("conv_id", "segment")), pa.array(["\n".join(x) if x else None for x in lines], pa.string())], names=["conv_id", "segment", "lines"])

    lines = both.mapInArrow(repaired, T.StructType([T.StructField("conv_id", kind), T.StructField("segment", T.LongType()), T.StructField("lines", T.StringType())]))

    def hashed(batches):
        own, sha, began = None, None, False
        for batch in batches:
            for conv_id, _, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != (conv_id,):
                    if own:
                        yield pa.RecordBatch.from_arrays([pa.array([own[0]], ids), pa.array([sha.hexdigest()])], names=["sha_id", "repaired_sha256"])
                    own, sha, began = (conv_id,), hashlib.sha256(), False
                if text is not None:
                    sha.update((("\n" if began else "") + text).encode("utf-8", "surrogatepass"))
                    began = True
        if own:
            yield pa.RecordBatch.from_arrays([pa.array([own[0]], ids), pa.array([sha.hexdigest()])], names=["sha_id", "repaired_sha256"])

    shas = lines.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "segment").mapInArrow(hashed, T.StructType([T.StructField("sha_id", kind), T.StructField("repaired_sha256", T.StringType())]))
    # one value a conversation, put together by tasks that hold one group of lists at a time
    audits = chosen.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", "edits"))), lambda x: x["edits"]), "").alias("audit"), *(F.max(c).alias(c) for c in (*STATS, "cost")))
    out = audits.join(shas, F.col("conv_id").eqNullSafe(F.col("sha_id")))
    return out.select("conv_id", *STATS, "cost", "audit", "repaired_sha256")


def repair(turns: DataFrame, segment: int | None = None) -> DataFrame:
    """(conv_id, turn, role, text, copies) -> conv_id, turns, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conv_id; copies: how often a row stands (0: not at all)."""
    there = F.col("copies") > 0
    by_turn = turns.groupBy("conv_id", "turn").agg(F.sum("copies").alias("n"), F.max(there).alias("there"))
    turn = F.when(F.col("there"), F.col("turn"))
    gaps = F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count(turn), F.lit(0)).cast("long")
    counts = materialise(by_turn.groupBy("conv_id").agg(F.sum("n").alias("rows"), gaps.alias("gaps")), "conversations")
    size = SEGMENT if segment is None else segment
    long = counts.filter(F.col("rows") > size).select(F.col("conv_id").alias("long_id"))
    n_long = long.count()
    blank, truncated = faults()
    rows = turns.filter(there).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("conv_id", "turn", "role", "text", F.substring("role", 1, 1).alias("initial"), blank.alias("blank"), truncated.alias("truncated"))
    if n_long:
        same, few = F.col("conv_id").eqNullSafe(F.col("long_id")), maybe_broadcast(long, n_long)
        found = _short(rows.join(few, same, "left_anti")).unionByName(_long(rows.join(few, same, "left_semi"), size))
    else:
        found = _short(rows)
    found = found.withColumnRenamed("conv_id", "found_id")
    out = counts.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in (*STATS, "cost")}
    empty = hashlib.sha256(b"").hexdigest()
    return out.withColumns(zero | {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.lit(empty))}).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256", "turns")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(load(spark, sf_dir, "conversations")))


ORACLE = (
    """
with recursive crc as (
  select list(x order by i) as tab from (
    select i, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) as x from range(256) r(i))
), moves(state, turn, nxt, cost, edits) as (values """
    + ", ".join(map(str, moves()))
    + r"""
), convs as (
  select conv_id, row_number() over () as conv from (select distinct conv_id from conversations)
), hashed as (
  select v.conv, t.turn, t.role, t.text, xor(list_reduce(list_concat([4294967295], list_transform(string_split(coalesce(t.conv_id::varchar, ' ') || ':' || coalesce(t.turn::varchar, ' '), ''), lambda ch: ascii(ch)::bigint)), lambda c, b: xor(c // 256, tab[1 + xor(c, b) % 256])), 4294967295) % 20 as k
  from conversations t join convs v on v.conv_id is not distinct from t.conv_id, crc
), damaged as (
  select conv, turn, case when k = 4 then 'user' else coalesce(role, ' ') end as role,
    case k when 1 then '' when 2 then regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') else coalesce(text, ' ') end as text, unnest(range(case k when 0 then 0 when 3 then 2 else 1 end)) as copy
  from hashed
), placed as (
  select conv, turn, role, text, substr(role, 1, 1) as initial, row_number() over (partition by conv order by turn nulls first, role, text, copy) - 1 as pos from damaged
), judged as (
  select *, not regexp_matches(text, '[^\x20\x09-\x0D]') as blank, not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') as cut_off,
    row_number() over (partition by conv, role, text order by pos) > 1 as seen, lag(initial) over (partition by conv order by pos) || initial as pair
  from placed
), folded as (
  select conv, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank, count(*) filter (seen and not blank) as duplicate,
    count(*) filter (cut_off and not blank and not seen) as truncated, count(*) filter (pair not in ('su', 'ua', 'au')) as illegal,
    string_agg(case when blank or seen then 'x' when initial not in ('s', 'u', 'a') then case when cut_off then 'O' else 'o' end when cut_off then upper(initial) else initial end, '' order by pos) as letters
  from judged group by conv
), walk(conv, state, pos, best) using key (conv, state) as (
  select conv, 0, 0::bigint, {'cost': 0::bigint, 'edits': ''} from folded
  union
  select w.conv, m.nxt, min(w.pos) + 1, min({'cost': w.best.cost + m.cost, 'edits': w.best.edits || m.edits})
  from walk w join folded f on f.conv = w.conv join moves m on m.state = w.state and m.turn = substr(f.letters, w.pos + 1, 1)
  where w.pos < f.n group by w.conv, m.nxt
), chosen as (
  select w.conv, min({'cost': best.cost + case state when 2 then 5 else 0 end, 'edits': best.edits || case state when 2 then 'I' else '' end}) as best
  from walk w join folded f on f.conv = w.conv where w.pos = f.n and state <> 1 group by w.conv
), steps as (
  select conv, unnest(range(length(best.edits))) as j, substr(best.edits, j + 1, 1) as edit from chosen
), at_turn as (
  select conv, edit, count(*) filter (edit <> 'I') over w - 1 as pos, count(*) filter (edit <> 'D') over w - 1 as m from steps window w as (partition by conv order by j rows between unbounded preceding and current row)
), kept as (
  select a.conv, a.m, a.edit, p.role, p.text, max((a.m = 0 and a.edit = 'K' and p.initial = 's')::int) over (partition by a.conv) as opening
  from at_turn a left join placed p on p.conv = a.conv and p.pos = a.pos and a.edit <> 'I' where a.edit <> 'D'
), repaired as (
  select conv, string_agg(case when edit = 'K' then role when (m - opening) % 2 = 0 then 'user' else 'assistant' end || ':' || coalesce(text, ''), chr(10) order by m) as lines from kept group by conv
)
select conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal,
  coalesce(best.cost, 0)::bigint as cost, coalesce(best.edits, '') as audit, sha256(coalesce(lines, '')) as repaired_sha256, coalesce(n, 0)::bigint as turns
from convs left join folded using (conv) left join chosen using (conv) left join repaired using (conv)"""
)
