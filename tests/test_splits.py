"""Files read by splits give what whole files give."""

import random
import re

import pytest
from pyspark.sql import functions as F

from driftline.shared import settings
from driftline.sources import documents, scripts, splits
from driftline.streaming.arrivals import Arrivals

SMALL = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}


@pytest.fixture(scope="module")
def texts():
    deal = random.Random(9)
    out = {f"f{i}.txt": "".join(deal.choice(["a", "ü漢", "b c", "\n", "\r\n", "\r", "\n\r", "", "=" * 30]) for _ in range(deal.randint(1, 120))) for i in range(25)}
    out |= {"unix.txt": "line\n" * 200, "old.txt": "x\r" * 50, "tail.txt": "a\r\nb\r", "one.txt": "no end", "ends.txt": "\n", "dos.txt": "a\r\n" * 60}
    return {n: t for n, t in out.items() if t}


def test_lines(spark, tmp_path, texts):
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    want = {(n, i, x) for n, t in texts.items() for i, x in enumerate(re.split(r"\r\n|\r|\n", t), 1)}
    for held in ({}, SMALL):
        with settings(spark, held):
            got = splits.read_lines(spark, str(tmp_path), "*.txt", mark=F.startswith("text", F.lit("a")))
            rows = got.collect()
            assert got.rdd.getNumPartitions() >= 1
        assert {(r.file, r.line, r.text) for r in rows} == want and len(rows) == len(want)
        marks = {(r.file, r.line): r.marks for r in rows}
        for n, t in texts.items():
            seen = 0
            for i, x in enumerate(re.split(r"\r\n|\r|\n", t), 1):
                seen += x.startswith("a")
                assert marks[n, i] == seen
    assert splits.read_lines(spark, str(tmp_path), "*.none").count() == 0


def test_one_script_in_many_splits(spark, tmp_path):
    text = "".join(f"[message text=t{i} name=n{i % 3}]\n# note\n" for i in range(200))
    (tmp_path / "adv_dear_amao_01.txt").write_text(text)
    whole = sorted(map(tuple, scripts.items(scripts.numbered(spark.createDataFrame([("adv_dear_amao_01.txt", text)], "file string, value string"))).collect()))
    with settings(spark, SMALL):
        lines = spark.read.text(str(tmp_path))
        assert lines.rdd.getNumPartitions() > 50
        assert sorted(map(tuple, scripts.items(scripts.read_lines(spark, str(tmp_path))).collect())) == whole and len(whole) == 400


def test_tables_by_record(spark, tmp_path):
    plain = "# head\n---\n" + "".join(f"- id: k{i}\n  name: 'かな {i}'\n  list:\n  - 1\n  - {{a: [x, {i}]}}\n" for i in range(60))
    held = {
        "Plain.yaml": plain,
        "Block.yaml": "- text: |\n    - not a record\n    second\n  id: 1\n-\n  id: 2\n- 5\n- id: 3\n",
        "Anchors.yaml": "- &a {id: 1, name: x}\n- *a\n- id: 2\n  <<: *a\n",
        "Quoted.yaml": '- "a\n- b"\n- id: 7\n',
        "Flow.yaml": "[{id: 1}, {id: 2}]\n",
        "Map.yaml": "id: 1\nname: x\n",
        "Bad.yaml": "- id: 1\n- id: [\n- id: 3\n",
        "Two.yaml": "- id: 1\n---\n- id: 2\n",
        "Bare.yaml": "# nothing\n",
        "Dos.yaml": "- id: 1\r\n  name: yes\r\n- id: 0o17\r\n",
    }
    for name, text in held.items():
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "Empty.yaml").write_text("")
    want = sorted((r.table, r.rec_idx, r.rec) for r in documents.table_rows(documents.whole_files(spark, str(tmp_path), "*.yaml")).collect())
    for settings_of in ({}, SMALL):
        with settings(spark, settings_of):
            assert sorted((r.table, r.rec_idx, r.rec) for r in documents.read_tables(spark, str(tmp_path)).collect()) == want
    assert len(want) > 60 and documents.read_tables(spark, str(tmp_path / "none")).count() == 0


def test_arrivals_are_applied_once(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    stream = Arrivals(spark, str(source), target, files_at_a_time=2)
    assert stream.items().count() == 0 and stream.snapshot().count() == 0
    want = set()
    for run in range(3):
        for i in range(3):
            (source / f"adv_x_{run}{i}.txt").write_text(f"[message text=t{run}{i} name=n]\n[title text=e{i}]")
            want |= {(f"adv_x_{run}{i}:1:text", f"t{run}{i}"), (f"adv_x_{run}{i}:1:name", "n"), (f"adv_x_{run}{i}:2:text", f"e{i}")}
        (source / "other.txt").write_text("[title text=no]")
        stream.run()
        stream.run()  # nothing new
        got = stream.items().select("uid", "jp").collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)
        assert {tuple(r) for r in stream.snapshot().select("uid", "jp").collect()} == want
    last = spark.createDataFrame([("adv_x_20.txt", "[message text=t20 name=n]\n[title text=e0]")], "file string, value string")
    n = max(int(p.name.split("=")[1]) for p in (tmp_path / "out/items").glob("batch=*"))
    held = {tuple(r) for r in spark.read.parquet(f"{target}/items/batch={n}").select("file", "line", "field", "jp").collect()}
    files = {f for f, *_ in held}
    again = spark.createDataFrame([(f, (source / f).read_text()) for f in files], last.schema)
    stream.apply(again, n)  # a batch that was written but not committed is made again
    got = stream.items().select("uid", "jp").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
