"""What the driver doesn't hold: a row a file, whatever the number of files."""

import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from driftline import app
from driftline.shared import measured_broadcasts, settings, written
from driftline.sinks import files, tables
from driftline.sources import documents, scripts, splits
from tests.test_app import cfg  # noqa: F401  a fixture


def test_folders_of_scripts_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    """Spark's file sources keep a status of each file in the driver."""
    for name in ("adv_0", "adv_1", "adv_a b", "adv_か+%", "_adv", "other"):
        files.put(f"{tmp_path}/{name}.txt", f"{name}\r\nlast".encode())
    files.put(f"{tmp_path}/under/adv_2.txt", b"under")
    files.put(f"{tmp_path}/adv_empty.txt", b"")
    files.put(f"{tmp_path}/adv_bom.txt", "\ufeffa\n".encode())
    monkeypatch.setattr(type(spark.read), "text", lambda *_, **__: pytest.fail("listed by the driver"))
    want = {(f"{n}.txt", i, t) for n in ("adv_0", "adv_1", "adv_a b", "adv_か+%") for i, t in ((1, n), (2, "last"))} | {("adv_bom.txt", 1, "a"), ("adv_bom.txt", 2, "")}
    assert {tuple(r) for r in scripts.read_lines(spark, str(tmp_path)).collect()} == want
    assert {r.path for r in splits.read_lines(spark, f"file://{tmp_path}", "adv_[0-9].txt", recursive=True).collect()} == {"adv_0.txt", "adv_1.txt", "under/adv_2.txt"}


@pytest.mark.parametrize("text", ["a\n" * 40, "x" * 100 + "\n" + "y" * 90, "a\rb\n" * 30 + "c\r", "\n" * 50, "long " * 60, "ü\r\n" * 40])
def test_blocks_of_splits(tmp_path, monkeypatch, text):
    """Each line is in one split, whole, and one split ends the file."""
    content = text.encode()
    for most, block in ((7, 3), (16, 5), (64, 1 << 20), (1000, 11)):
        monkeypatch.setattr(splits, "BLOCK", block)
        (tmp_path / "t").write_bytes(content)
        with open(tmp_path / "t", "rb") as f:
            got = [x for start in range(0, len(content), most) for x in splits._blocks(f, start, start + most, len(content))]
        assert b"".join(b for b, _ in got) == content and [e for _, e in got] == [False] * (len(got) - 1) + [True]
        assert all(b.endswith(b"\n") for b, e in got if not e)


def test_one_file_is_read_without_its_neighbours(spark, tmp_path):
    """A glob filter would leave the driver with all that is below the folder."""
    files.put(f"{tmp_path}/localization.json", b"{}")
    files.put(f"{tmp_path}/resource/x.txt", b"x")
    with settings(spark, {"spark.sql.maxMetadataStringLength": "2000"}):
        found = documents.whole_files(spark, str(tmp_path), "localization.json")
        assert "localization.json]" in found._jdf.queryExecution().executedPlan().toString()
    assert [r.value for r in found.select(F.col("value")).collect()] == ["{}"] and found.first().path.endswith("/localization.json")
    assert documents.whole_files(spark, str(tmp_path), "none.json").count() == 0 and documents.whole_files(spark, str(tmp_path / "none"), "*.json").count() == 0


def test_an_archive_is_packed_by_tasks(spark, tmp_path, monkeypatch):
    """The driver opens none of the files."""
    top, held = f"{tmp_path}/top", {f"b{i % 3}/f {i}é.txt": os.urandom(i) for i in range(60)} | {"b0.txt": b"", "b0-/x": b"a" * 9000}
    for name, content in held.items():
        files.put(f"{top}/{name}", content)
    monkeypatch.setattr(files, "PACKED", 7)
    files.create_package(top, f"{tmp_path}/one.zip")
    monkeypatch.setattr(files, "get", lambda *_: pytest.fail("read by the driver"))
    assert files.create_package(top, f"{tmp_path}/two.zip", spark=spark) == 62
    want = [f"{d}/" for d in sorted(("b0", "b1", "b2", "b0-"))] + sorted(held, key=lambda n: n.split("/"))
    for made in ("one", "two"):
        with zipfile.ZipFile(tmp_path / f"{made}.zip") as z:
            assert z.namelist() == want and z.testzip() is None and all(z.read(n) == c for n, c in held.items())
            assert {i.date_time for i in z.infolist() if not i.is_dir()} == {(1980, 1, 1, 0, 0, 0)}


def test_many_entries_and_far_places(tmp_path):
    """More entries than the archive's end can say, and a body whose place takes more than 4 bytes."""
    packs = list(files._packs(str(tmp_path), 1, (f"d{i}/" for i in range(70_000))))
    with io.BytesIO() as out:
        assert files._put_together(packs, out) == 70_000
        assert len(zipfile.ZipFile(out).infolist()) == 70_000
    records = list(files._moved(packs[0][1], 1 << 33))
    assert len(records) == 1000 and all(r[42:46] == b"\xff" * 4 for r in records)
    assert [int.from_bytes(r[-8:], "little") - (1 << 33) for r in records[:2]] == [0, 35]
    again = list(files._moved(b"".join(records), 5))
    assert int.from_bytes(again[0][-8:], "little") == (1 << 33) + 5


def test_a_tree_is_copied_by_tasks(spark, tmp_path, monkeypatch):
    for name in ("a/x.txt", "a/b/y é.txt", "z"):
        files.put(f"{tmp_path}/from/{name}", name.encode())
    (tmp_path / "from/empty").mkdir()
    files.put(f"{tmp_path}/to/a/x.txt", b"old")
    monkeypatch.setattr(files.fs, "copy_files", lambda *_, **__: pytest.fail("copied by the driver"))
    files.copy_tree(f"{tmp_path}/from", f"{tmp_path}/to", spark)
    assert files.tree(f"{tmp_path}/to") == (["a", "a/b", "empty"], ["a/b/y é.txt", "a/x.txt", "z"]) and files.get(f"{tmp_path}/to/a/x.txt") == b"a/x.txt"
    files.copy_tree(f"{tmp_path}/none", f"{tmp_path}/to", spark)


def test_rows_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(tables, "HANDED", 3)
    made = tables.handed(spark, ((i, f"n{i}", i % 2 == 0) for i in range(10)), "place int, name string, even boolean", "handed")
    assert [tuple(r) for r in made.orderBy("place").collect()] == [(i, f"n{i}", i % 2 == 0) for i in range(10)]
    assert tables.handed(spark, iter(()), "place int", "handed").count() == 0


def test_packed_tables_are_not_broadcast(spark):
    """A file of a few 100 KB whose rows take 60 MB: by the file's size Spark sends it through the driver."""
    packed = written(spark.range(200_000).select("id", F.repeat(F.lit("x"), 300).alias("cn")), "packed")
    wide = spark.range(400_000).select("id", F.lit("y").alias("v"))

    def plan():
        made = wide.join(packed, "id", "left").agg(F.max("v"), F.max("cn"))
        made.collect()
        return made._jdf.queryExecution().executedPlan().toString()

    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "10m"}):
        assert "BroadcastHashJoin" in plan()
        with measured_broadcasts(spark):
            assert "BroadcastHashJoin" not in plan()
        assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10m"


def test_stages_broadcast_by_measured_sizes(spark, cfg, monkeypatch):  # noqa: F811
    seen, before, write = [], spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), tables.write_items
    monkeypatch.setattr(tables, "write_items", lambda *a: seen.append(spark.conf.get("spark.sql.autoBroadcastJoinThreshold")) or write(*a))
    app.extract(spark, cfg)
    app.translate(spark, cfg, waits=(), report=lambda said: None)
    assert seen == ["-1", "-1"] and spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before
