"""Diff, record tables, work planning and rebuilding."""

import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from driftline.backend import EchoBackend, create_backend, endpoint, read_reply
from driftline.operators import diff, master, rebuild, work
from driftline.sinks import files as sink
from driftline.sources import documents, scripts


def rec(spark, rows):
    return spark.createDataFrame([("t", i, r) for i, r in rows], "table string, rec_idx int, rec map<string,string>")


def test_record_lookup_levels(spark):
    rows = rec(spark, [(0, {"id": "1", "name": '"かな"'}), (1, {"id": '"1"', "name": '"かな"'}), (2, {"name": '"かな"'}), (3, {"id": '"x"', "name": '"かな"'}), (4, {"id": '"e"', "name": '"かな"'})])
    one = rec(spark, [(0, {"id": "1", "name": '"P0"'}), (2, {"name": '"P2"'}), (7, {"id": '"x"', "name": '"old"'}), (8, {"id": '"x"', "name": '"Px"'}), (4, {"id": '"e"', "name": '""'})])
    two = rec(spark, [(1, {"id": '"1"', "name": '"F1"'}), (4, {"id": '"e"', "name": '"F4"'})])
    got = {r.uid: r.existing_cn for r in master.lookup(master.record_fields(rows), one, two).collect()}
    assert got == {"master:t:0:1:name": "P0", "master:t:1:1:name": "F1", "master:t:2:_idx2:name": "P2", "master:t:3:x:name": "Px", "master:t:4:e:name": ""}


def test_record_updates(spark):
    records = rec(spark, [(0, {"id": '"a"', "name": '"x"'}), (1, {"id": '"b"', "name": '"y"'}), (2, {"name": '"z"'}), (3, {"id": '"a"', "name": '"w"'})])
    rows = [("t", 0, '"a"', "name", "A", ""), ("t", 9, '"b"', "name", "B", ""), ("t", 2, '""', "name", "C", ""), ("t", 0, '"a"', "more", "Q", ""), ("t", 1, '"a"', "late", "", "L"), ("t", 8, '"none"', "name", "N", ""), ("t", 0, '"a"', "empty", "", "")]
    items = spark.createDataFrame(rows, "table string, rec_idx int, record_id string, field string, cn string, existing_cn string")
    got = {r.rec_idx: (r.rec, r.applied) for r in master.apply_updates(records, items).collect()}
    assert got == {0: ({"id": '"a"', "name": '"A"', "more": '"Q"'}, 2), 1: ({"id": '"b"', "name": '"B"'}, 1), 2: ({"name": '"C"'}, 1), 3: ({"id": '"a"', "name": '"w"', "late": '"L"'}, 1)}
    blind = {r.rec_idx: r.rec for r in master.apply_updates(records, items, check_id=False).collect()}
    assert blind[1] == {"id": '"b"', "name": '"B"', "late": '"L"'} and blind[3] == {"id": '"a"', "name": '"w"'}


def test_yaml_scalars_and_bad_files(spark):
    files = spark.createDataFrame([("x/T.yaml", "- id: 1\n  a: yes\n  b: true\n  c: 010\n  d: 1:30\n- 3\n"), ("x/bad.yaml", "a: [")], "path string, value string")
    rows = documents.table_rows(files).collect()
    assert [(r.table, r.rec_idx, r.rec) for r in rows] == [("T", 0, {"id": "1", "a": '"yes"', "b": "true", "c": '"010"', "d": '"1:30"'})]


def test_status_and_names(spark):
    items = spark.createDataFrame([("f", 1, "message", "text", "A", 0), ("f", 1, "message", "name", "花", 1), ("f", 2, "message", "text", "{user}", 0), ("f", 3, "narration", "text", "C", 0)], "file string, line int, command string, field string, jp string, seq int")
    one = spark.createDataFrame([("f", 1, "text", r"<r\=old>a</r>", 0), ("f", 3, "text", "C", 0)], "file string, line int, field string, jp string, seq int")
    two = spark.createDataFrame([("f", 3, "text", r"<r\=C>c</r>", 0)], "file string, line int, field string, jp string, seq int")
    got = {(r.line, r.field): (r.existing_cn, r.status, r.speaker) for r in diff.resource_diff(items, one, two, {"k": "花海"}).collect()}
    assert got == {(1, "text"): ("a", "changed", "花"), (1, "name"): ("花海", "existing", None), (2, "text"): ("{user}", "existing", None), (3, "text"): ("c", "existing", None)}


def test_localization(spark):
    files = spark.createDataFrame([("l.json", '{"a": "かな", "b": {"c": ["漢字", "x", "#かな 漢"]}}')], "file string, value string")
    assert {r.field: r.status for r in documents.localization_items(files).collect()} == {"a": "new", "b.c[0]": "existing", "b.c[2]": "existing"}
    items = spark.createDataFrame([("l.json", "a", "A", "", 1), ("l.json", "zz", "Z", "", 1)], "file string, field string, cn string, existing_cn string, ord int")
    assert rebuild.apply_localization(files, items).first().value == '{"a":"A","b":{"c":["漢字","x","#かな 漢"]}}'


def work_items(spark, n=5, cn=""):
    rows = [(f"f:{i}:text", "resource", "f.txt", i, f"text {i}", "new", None, i) for i in range(n)]
    return spark.createDataFrame(rows, "uid string, category string, file string, line int, jp string, status string, speaker string, ord long").withColumn("existing_cn", F.lit(cn)).withColumn("file_context", F.lit(None).cast("struct<story_type:string,character:string,chapter:string>"))


class Flaky:
    """Leaves out an item for one batch."""

    def translate(self, prompt):
        reply = EchoBackend().translate(prompt)
        return "---" if "[f:3:text]" in prompt else reply


def test_translate_merge_and_failures(spark):
    items = work_items(spark)
    planned = work.batches(items, 2)
    got = work.merge_results(items, work.translate(planned, EchoBackend, waits=()))
    assert {r.uid: r.cn for r in got.collect()} == {f"f:{i}:text": f"TEXT {i}" for i in range(5)}
    bad = {r.uid: (r.cn, r.error is None) for r in work.translate(planned, Flaky, waits=()).collect()}
    assert bad["f:2:text"] == (None, False) and bad["f:3:text"] == (None, False) and bad["f:4:text"] == ("TEXT 4", True)


class Silent:
    """An error without a message."""

    def translate(self, prompt):
        raise RuntimeError


class HalfThenError:
    """A part of the first batch, then errors."""

    def __init__(self):
        self.asked = 0

    def translate(self, prompt):
        self.asked += 1
        if self.asked > 1:
            raise ValueError
        return "[f:0:text] T"


def test_errors_are_never_successes(spark, monkeypatch):
    from driftline import backend

    planned = work.batches(work_items(spark, 2), 2)
    for kind, partial, want in ((Silent, True, {None}), (HalfThenError, False, {None}), (HalfThenError, True, {None, "T"})):
        rows = work.translate(planned, kind, waits=(), keep_partial=partial).collect()
        assert {r.cn for r in rows} == want and all(r.error for r in rows)
    service = backend.MessagesBackend("http://h", "m", "k", api_version="v9")
    said = []
    for reply in ({"content": []}, {"content": [{"type": "tool_use"}]}, {}):
        monkeypatch.setattr(backend, "_post", lambda url, body, headers, timeout, reply=reply: said.append(headers["anthropic-version"]) or reply)
        with pytest.raises(ValueError, match="no text block"):
            service.translate("p")
    assert set(said) == {"v9"}
    monkeypatch.setattr(backend, "_post", lambda *a: {"choices": [{"message": {"content": None}}]})
    with pytest.raises(ValueError, match="no text"):
        backend.ChatBackend("http://h", "m", "k").translate("p")


def test_package_files_keep_order_and_refuse_bad_json(spark, tmp_path):
    text = '{"rules": {"primaryKeys": ["id"]}, "data": [{"id": "r1", "x": 1, "y": [1, {"b": 2, "a": 1.50}], "z": "old", "a": null, "b": true, "c": "k"}]}'
    files = spark.createDataFrame([("T", text)], "table string, value string")
    items = spark.createDataFrame([("T", 0, '"r1"', "z", "new", ""), ("T", 0, '"r1"', "more", "m", "")], "table string, rec_idx int, record_id string, field string, cn string, existing_cn string")
    made = master.package_pieces(files, items).withColumnRenamed("table", "file")
    row = sink.write_streamed(made, str(tmp_path), ["place"], **master.JOINTS).first()
    content = (tmp_path / "T").read_text()
    assert content == json.dumps(json.loads(content), ensure_ascii=False, indent=1)
    assert list(json.loads(content)["data"][0].items()) == [("id", "r1"), ("x", 1), ("y", [1, {"b": 2, "a": 1.5}]), ("z", "new"), ("a", None), ("b", True), ("c", "k"), ("more", "m")] and row.applied == 2
    for bad in ("{", "[]", '{"data": [1]}', '{"data": 3}'):
        with pytest.raises(PythonException, match="not a JSON object"):
            documents.package_rows(spark.createDataFrame([("a/T.json", bad)], "path string, value string")).collect()
    assert documents.package_rows(spark.createDataFrame([("a/T.json", "{}")], "path string, value string")).count() == 0


def test_replies():
    uids = ["a:1", "a:2"]
    assert read_reply("[a:2] y\n---\n[a:1] x", uids) == {"a:2": "y", "a:1": "x"}
    assert read_reply("x\n---\ny", uids) == {"a:1": "x", "a:2": "y"}
    assert read_reply("x", uids) == {}
    assert endpoint("http://h/v1/", "/chat/completions") == "http://h/v1/chat/completions" == endpoint("http://h/v1/chat/completions", "/chat/completions")
    assert isinstance(create_backend("echo"), EchoBackend)


def test_pending_by_source(spark):
    items = spark.createDataFrame([("a", "x", "new"), ("b", "y", "changed"), ("c", "z", "existing")], "uid string, jp string, status string")
    done = items.filter("uid = 'a'").select("uid", F.sha2(F.lit("other"), 256).alias("jp_sha"))
    assert {r.uid for r in work.pending(items, done).collect()} == {"a", "b"}
    assert {r.uid for r in work.pending(items, done, skip_changed=True, by_source=False).collect()} == set()


def test_rebuild_scripts(spark):
    lines = scripts.numbered(spark.createDataFrame([("f", "[message text=A name=N]\nkeep\n[title text=T]")], "file string, value string"))
    items = spark.createDataFrame([("f", 1, "text", "a", "", 0), ("f", 3, "text", "", "t", 0)], "file string, line int, field string, cn string, existing_cn string, ord int")
    assert "\n".join(r.text for r in rebuild.rebuilt_lines(lines, items).orderBy("line").collect()) == "[message text=<r\\=A>a</r> name=N]\nkeep\n[title text=<r\\=T>t</r>]"


def test_catalogue_against_duckdb(spark):
    """Every query with SQL gives the same rows on the smallest tables."""
    import duckdb

    from driftline.plans import catalogue, oracles

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "events", "documents", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")

    def differs(name):
        df = catalogue.QUERIES[name](spark, sf)
        names = sorted(df.columns)
        ours = sorted(repr(tuple(r)) for r in df.select(*names).collect())
        want = con.cursor().execute(f"SELECT {', '.join(chr(34) + n + chr(34) for n in names)} FROM ({oracles.ORACLES[name]})").fetchall()
        return name if ours != sorted(repr(tuple(r)) for r in want) else None

    assert set(catalogue.QUERIES) == set(oracles.ORACLES)
    with ThreadPoolExecutor(4) as pool:  # most of a small query's time is the driver's
        assert [x for x in pool.map(differs, catalogue.QUERIES) if x] == []
