"""What keeps large groups, large files and paid calls whole: numbering by ranges, streamed files, the reply ledger."""

import hashlib
import json
import random
import threading
import time

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from driftline import app
from driftline.backend import EchoBackend
from driftline.operators import work
from driftline.operators.ledger import ReplyLedger
from driftline.operators.numbering import forget, numbered
from driftline.sinks import files
from driftline.sinks.buckets import BucketTable, snapshot, update_snapshot
from tests.test_app import cfg  # noqa: F401  a fixture
from tests.test_operators import work_items


def test_numbers_of_a_hot_group(spark):
    deal = random.Random(1)
    rows = [(None if i % 7 == 0 else "hot" if i % 7 < 5 else f"g{i % 40}", deal.choice([None, *range(50)]), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, o int, i int")
    out = numbered(df, ["g"], ["o", "i"], "n", 5)
    want, seen = {}, {}
    for g, _, i in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        want[i] = seen[g] = seen.get(g, 4) + 1
    assert {r.i: r.n for r in out.collect()} == want and out.columns == ["g", "o", "i", "n"]
    held = [r["count"] for r in out._tables[0].groupBy("_number_part").count().collect()]
    assert max(held) < 2 * 6000 / len(held)  # though one group has 4/7 of all rows
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    ties = numbered(spark.range(1000).select(F.lit(1).alias("g"), F.lit(2).alias("o")), ["g"], ["o"])
    assert sorted(r["row"] for r in ties.collect()) == list(range(1000))
    forget(out)
    assert numbered(df.limit(0), ["g"], ["o"]).count() == 0
    with pytest.raises(ValueError, match="already"):
        numbered(df, ["g"], ["o"], "I")


def test_batches_have_no_window_over_groups(spark):
    items = work_items(spark, 50)
    planned = work.batches(items, 3)
    assert "Window" not in planned._jdf.queryExecution().executedPlan().toString()
    assert {r.uid: (r.pos, r.batch) for r in planned.collect()} == {f"f:{i}:text": (i, i // 3) for i in range(50)}


def test_streamed_files(spark, tmp_path):
    rows = [("b/two", 1, i, f"p{i}", 1) for i in range(3000)] + [("b/two", 0, None, "<", None), ("b/two", 2, None, ">", 2), ("one", 1, 5, None, 0), ("one", 1, 7, "ü", 0), ("bare", 0, None, "[", 0), ("bare", 2, None, "]", 0), (None, 1, 1, "no name", 0)]
    df = spark.createDataFrame(rows, "file string, part int, o long, piece string, applied int")
    report = files.write_streamed(df, str(tmp_path), ["o"], "\n", ",", "\n ")
    want = {"b/two": "<\n" + ",".join(f"p{i}" for i in range(3000)) + "\n >", "one": "\n,ü\n ", "bare": "[]"}
    assert {n: (tmp_path / n).read_text() for n in want} == want and not list(tmp_path.rglob("*.tmp"))
    assert {r.file: (r.n_bytes, r.sha256, r.applied) for r in report.collect()} == {n: (len(t.encode()), hashlib.sha256(t.encode()).hexdigest(), 3002 if n == "b/two" else 0) for n, t in want.items()}
    assert files.write_totals(report) == (3, 3002)
    with pytest.raises(PythonException, match="not a name inside"):
        files.write_streamed(df.withColumn("file", F.lit("../x")), str(tmp_path), ["o"])
    assert not list(tmp_path.rglob("*.tmp")) and files.write_totals(files.write_streamed(df.limit(0), str(tmp_path), ["o"])) == (0, 0)


def test_ledger_keeps_whole_replies(spark, tmp_path):
    ledger = ReplyLedger(str(tmp_path / "l"))
    key = ledger.key("g", 1, "p")
    assert ledger.find(key) is None and ledger.rows(spark).count() == 0 and key != ledger.key("g", 1, "q")
    ledger.keep(key, "g", 1, [("u", "s", "ü\n")])
    (tmp_path / "l" / key[:2] / key / "x.json.part.tmp").write_text("{broken")
    assert ledger.find(key) == {"u": "ü\n"}
    ledger.keep(key, "g", 1, [("u", "s", "ü\n")])
    assert [(r.key, r.gk, r.uid, r.jp_sha, r.cn) for r in ledger.rows(spark).collect()] == [(key, "g", "u", "s", "ü\n")] * 2
    ledger.clear()
    assert ledger.find(key) is None


class Counting(EchoBackend):
    """Notes each call, and the most that were under way at a time, in a folder."""

    def __init__(self, folder, fails=None):
        self.folder, self.fails, self.now, self.lock = folder, fails, 0, threading.Lock()

    def translate(self, prompt):
        with self.lock:
            self.now += 1
            (self.folder / f"{time.time_ns()}-{self.now}").write_text(prompt)
        time.sleep(0.05)
        with self.lock:
            self.now -= 1
        if self.fails and self.fails in prompt:
            raise KeyboardInterrupt  # ends the task
        return super().translate(prompt)


def test_calls_under_way_are_bounded(spark, tmp_path):
    assert [work.shares(n) for n in (1, 5, 8, 9, 100)] == [(1, 1), (1, 5), (1, 8), (2, 4), (13, 7)]
    rows = work.translate(work.batches(work_items(spark, 40), 2), lambda: Counting(tmp_path), concurrency=5, waits=()).collect()
    assert {r.cn for r in rows} == {f"TEXT {i}" for i in range(40)} and sum(r.first for r in rows) == 20
    under_way = [int(p.name.rsplit("-", 1)[1]) for p in tmp_path.iterdir()]
    assert len(under_way) == 20 and 1 < max(under_way) <= 5


def test_a_run_that_died_is_gone_on_with(spark, cfg, tmp_path):  # noqa: F811
    """The job ends within its first wave; the next run asks only for what has no file, under other batch borders too."""
    app.extract(spark, cfg)
    first, second = tmp_path / "first", tmp_path / "second"
    first.mkdir(), second.mkdir()
    cfg["llm"]["max_concurrent"] = 1
    with pytest.raises(Exception, match="KeyboardInterrupt|crash|exited"):
        app.translate(spark, cfg, lambda: Counting(first, "master:New"), waits=())
    kept = {r.uid for r in ReplyLedger(f"{cfg['paths']['work']}/ledger").rows(spark).collect()}
    asked = "".join(p.read_text() for p in first.iterdir())
    cfg["llm"]["batch_size"] = 3
    did = app.translate(spark, cfg, lambda: Counting(second), waits=())
    again = "".join(p.read_text() for p in second.iterdir())
    assert did["n_eligible"] == 6 and did["n_skipped"] == len(kept) and did["n_answered"] == 6 - len(kept) and not did["n_failed_batches"]
    assert all(f"[{u}]" in asked and f"[{u}]" not in again for u in kept)
    assert not files.exists(f"{cfg['paths']['work']}/ledger") and not files.exists(f"{cfg['paths']['work']}/checkpoint")
    texts = {r.uid: r.cn for r in app.documents.read_items(spark, f"{cfg['paths']['work']}/translated").collect()}
    assert texts["master:New:0:7:name"] == "かな新" and texts["localization:a.b[0]"] == "かな" and json.dumps(texts)


def test_bucket_table(spark, tmp_path):
    path = str(tmp_path / "t")
    table = lambda: BucketTable(spark, path, buckets=8, most=2)
    rows = lambda pairs: spark.createDataFrame(pairs, "uid string, jp string")
    assert table().read().count() == 0
    held = {f"u{i}": f"s{i}" for i in range(400)}
    assert table().upsert(rows(list(held.items()))) == {"version": 1, "rows": 400, "buckets": 8, "together": 0}
    first = table()
    listed = json.loads((tmp_path / "t/_state.json").read_text())["files"]
    reader = first.read()  # planned on the first version's files
    assert table().upsert(rows([("u5", "a"), ("u5", "new"), ("fresh", None)])) == {"version": 2, "rows": 2, "buckets": 2, "together": 0}
    held |= {"u5": "new", "fresh": None}
    now = json.loads((tmp_path / "t/_state.json").read_text())["files"]
    assert sum(now[b] != listed[b] for b in now) == 2  # other buckets weren't written
    assert {r.uid: r.jp for r in reader.collect()}["u5"] == "s5" and {r.uid: r.jp for r in table().read().collect()} == held
    did = [table().upsert(rows([("u5", f"v{i}")])) for i in range(3)]
    assert [d["together"] for d in did] == [1, 0, 1] and all(d["buckets"] == 1 and d["rows"] == 1 for d in did)
    held["u5"] = "v2"
    assert {r.uid: r.jp for r in table().read().collect()} == held and table().upsert(rows([]))["rows"] == 0
    table().upsert(rows([]))
    assert {r.uid: r.jp for r in table().read().collect()} == held
    named = {p.split("/")[0] for own in json.loads((tmp_path / "t/_state.json").read_text())["files"].values() for _, p in own}
    gone = [d for d in (tmp_path / "t").iterdir() if d.is_dir() and d.name not in named and any(d.rglob("*.parquet"))]
    assert not gone  # files that no list names are deleted

    class Late(BucketTable):  # another writer comes in between
        def _write(self, rows, name):
            table().upsert(spark.createDataFrame([("other", "o")], "uid string, jp string"))
            return super()._write(rows, name)

    with pytest.raises(RuntimeError, match="another writer"):
        Late(spark, path).upsert(rows([("u1", "lost")]))
    assert {r.uid: r.jp for r in table().read().collect()} == held | {"other": "o"}


def test_older_snapshots_are_taken_over(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.createDataFrame([("a", "1"), ("b", "2")], "uid string, jp string").write.parquet(path)
    assert {tuple(r) for r in snapshot(spark, path).collect()} == {("a", "1"), ("b", "2")}
    update_snapshot(spark, path, spark.createDataFrame([("b", "3"), ("c", "4")], "uid string, jp string"))
    assert {tuple(r) for r in snapshot(spark, path).collect()} == {("a", "1"), ("b", "3"), ("c", "4")}
    assert snapshot(spark, str(tmp_path / "none")).count() == 0
