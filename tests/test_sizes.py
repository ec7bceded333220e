"""What the stages do once a file, a wave or an archive, whatever the size."""

import json
import zipfile

from pyspark.sql import functions as F

from driftline import app
from driftline.functions import script
from driftline.plans import workspace
from driftline.sinks import files, tables
from driftline.sources import documents, scripts
from tests.test_app import cfg  # noqa: F401  a fixture


def test_an_archive_is_tested_once(spark, tmp_path, monkeypatch):
    top, seen, test = f"{tmp_path}/package", [], zipfile.ZipFile.testzip
    for i in range(50):
        files.put(f"{top}/local-files/f{i}.txt", b"x")
    files.put(f"{top}/version.txt", files.build_version().encode())
    monkeypatch.setattr(workspace, "_translated", lambda *_: ({"paths": {"output": str(tmp_path)}}, {}))
    monkeypatch.setattr(app, "build", lambda *_: None)
    monkeypatch.setattr(zipfile.ZipFile, "testzip", lambda z: seen.append(1) or test(z))
    rows = workspace.stage_package(spark, "").collect()
    assert len(rows) == 52 and all(r.whole and r.n_files == 51 for r in rows) and len(seen) == 1


def test_items_as_lines_of_json(spark, tmp_path):
    """Written by tasks, in order, as one array; a line an item is read by splits, any other layout as a whole."""
    rows = spark.range(5000).select(F.concat(F.lit("u"), "id").alias("uid"), F.lit('a "q",\n]{').alias("jp"), (5000 - F.col("id")).alias("ord")).repartition(7)
    path = f"{tmp_path}/new.json"
    tables.write_items(rows, path)
    held = json.loads(files.get(path))
    assert [r["ord"] for r in held] == list(range(1, 5001)) and files.get(path)[:3] == b"[\n{" and files.get(path)[-3:] == b"}\n]"
    back = documents.read_items(spark, path)
    assert {(r.uid, r.jp, r.ord) for r in back.select("uid", "jp", "ord").collect()} == {(r["uid"], r["jp"], r["ord"]) for r in held}
    assert "FileScan text" in back._jdf.queryExecution().executedPlan().toString()
    for text in (json.dumps(held, indent=1), json.dumps(held), "[" + ",\n".join(f"{json.dumps(a)}, {json.dumps(b)}" for a, b in zip(held[::2], held[1::2], strict=True)) + "]"):
        files.put(path, text.encode())
        assert documents.read_items(spark, path).agg(F.count("uid"), F.sum("ord")).first() == (5000, 12502500)
    tables.write_items(rows.limit(0), path)
    assert files.get(path) == b"[]" and documents.read_items(spark, path).count() == 0


def test_waves_and_files_are_bounded(spark, cfg, monkeypatch):  # noqa: F811
    monkeypatch.setattr(app, "WAVE", 1)
    monkeypatch.setattr(app, "WAVES", 2)
    cfg["llm"]["batch_size"], said = 1, []
    app.extract(spark, cfg)
    did = app.translate(spark, cfg, waits=(), report=said.append)
    assert did["n_batches"] == did["n_answered"] == 6 and len(said) == 2 and said[-1].startswith("[6/6] 100.0% ok 6 failed 0")


def test_small_files_are_opened_once_by_few_tasks(spark, tmp_path):
    for i in range(300):
        files.put(f"{tmp_path}/adv_{i}.txt", f"a{i}\nb".encode())
    lines = scripts.read_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() <= 16 and "FileScan text" not in lines._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, lines.collect())) == sorted((f"adv_{i}.txt", n, t) for i in range(300) for n, t in ((1, f"a{i}"), (2, "b")))


def test_a_line_is_searched_once(spark):
    """What a rebuilt line needs of the line is found once, not once a use; the rows stay those of the tests of functions."""
    made = spark.createDataFrame([("[message clip={{{{{{x}}}}}} name=u text=ab ]", {"text": "T", "name": "N"})], "l string, t map<string,string>").select(script.build_line(F.col("l"), F.col("t")).alias("o"))
    plan = made._jdf.queryExecution().analyzed().toString()
    assert made.first().o == "[message clip={{{{{{x}}}}}} name=N text=<r\\=ab >T</r>]" and plan.count("_scanned(") <= 2
