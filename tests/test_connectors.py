"""Manifests, downloads, exact-named files, archives, configuration."""

import io
import json
import os
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from driftline.config import load_config, validate_llm
from driftline.sinks import files, tables
from driftline.sources import manifest, web, wire


def number(n):
    out = b""
    n &= 0xFFFFFFFFFFFFFFFF
    while True:
        out += bytes([(n & 127) | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return out


def rec(field, value):
    if isinstance(value, int):
        return number(field << 3) + number(value)
    value = value.encode() if isinstance(value, str) else value
    return number(field << 3 | 2) + number(len(value)) + value


RESOURCE = rec(1, 7) + rec(3, "adv_a.txt") + rec(5, 2**32 - 1) + rec(6, -3) + rec(7, number(1) + number(300)) + rec(7, 5) + rec(11, "Kx") + rec(12, 2**64 - 1) + rec(99, "unknown")
MESSAGE = rec(1, 454) + rec(4, RESOURCE) + rec(4, rec(3, "other.bin")) + rec(3, "tag") + rec(5, "https://host/{o}")


def test_wire_format():
    got = wire.decode(MESSAGE, wire.MANIFEST_FIELDS)
    one = got["resourceList"][0]
    assert (got["revision"], got["tagname"], got["urlFormat"], got["assetBundleList"]) == (454, ["tag"], "https://host/{o}", [])
    assert (one["id"], one["crc"], one["priority"], one["tagid"], one["generation"], one["md5"], one["state"]) == (7, 2**32 - 1, -3, [1, 300, 5], Decimal(2**64 - 1), "", 0)
    for broken in (MESSAGE[:-1], b"\xff" * 12, b"\x0b"):
        with pytest.raises(ValueError):
            wire.decode(broken, wire.MANIFEST_FIELDS)


def encrypted(spark, plain, key, vector):
    """Spark's ciphertext, the vector first."""
    row = spark.createDataFrame([(bytearray(plain),)], "p binary")
    return bytes(row.select(F.aes_encrypt("p", F.unhex(F.lit(key)), F.lit("CBC"), F.lit("PKCS"), F.unhex(F.lit(vector)))).first()[0])


def test_manifest_chain(spark, tmp_path):
    key, vector = "00112233445566778899aabbccddeeff", "0f" * 16
    options = manifest.ManifestOptions("https://host/", 400, "9", "secret", "seed", key, vector, {"X-Key": "{client_secret}", "Accept": "x/{app_id}"})
    asked, json_path, cache_path = [], str(tmp_path / "m" / "manifest.json"), str(tmp_path / "cache.bin")
    seed_key = spark.range(1).select(F.sha2(F.lit("seed"), 256)).first()[0]
    reply = encrypted(spark, MESSAGE, seed_key, vector)

    def service(url, headers, timeout):
        asked.append((url, headers))
        return reply

    def down(url, headers, timeout):
        raise OSError("down")

    with pytest.raises(RuntimeError, match="down"):
        manifest.load_manifest(spark, options, json_path, cache_path, down)
    files.put(cache_path, b"\x01" + encrypted(spark, b"c" * 16 + MESSAGE, key, vector)[16:])
    cached, origin = manifest.load_manifest(spark, options, json_path, cache_path, down)
    fresh, origin_2 = manifest.load_manifest(spark, options, json_path, cache_path, service)
    copy, origin_3 = manifest.load_manifest(spark, options, json_path, cache_path, lambda *a: b"short")
    assert (origin, origin_2, origin_3) == ("cache", "service", "json") and asked == [("https://host/v2/pub/a/400/v/9/list/0", {"X-Key": "secret", "Accept": "x/400"})]
    assert cached.first() == fresh.first() == copy.first() and fresh.first().resourceList[0].generation == Decimal(2**64 - 1)
    assert json.loads(manifest.index_json(fresh)) == {"revision": 454, "urlFormat": "https://host/{o}", "resources": [{"name": "adv_a.txt", "objectName": "Kx"}, {"name": "other.bin", "objectName": ""}]}


def test_downloads_are_logged_and_tried_again(spark, tmp_path):
    folder = str(tmp_path / "raw")
    wanted = web.eligible(spark.createDataFrame([("adv_a.txt", "A"), ("adv_b.txt", "B"), ("x.txt", "X"), ("adv_../../c.txt", "C")], "name string, objectName string"))
    log = spark.createDataFrame([], "name string, state string")

    def broken(url, headers, timeout):
        return b"a" if url.endswith("/A") else b""

    first = web.fetch(wanted, "http://host/{o}", folder, workers=2, fetcher=broken).collect()
    assert {r.name: r.state for r in first} == {"adv_a.txt": "ok", "adv_b.txt": "empty answer", "adv_../../c.txt": "empty answer"}
    log = web.logged(log, spark.createDataFrame(first, "name string, state string"))
    left = web.missing(wanted, log, web.stored(spark, folder))
    assert {r.name for r in left.collect()} == {"adv_b.txt", "adv_../../c.txt"}
    second = {r.name: r.state for r in web.fetch(left, "http://host/{o}", folder, workers=2, fetcher=lambda *a: b"b").collect()}
    assert second["adv_b.txt"] == "ok" and "not a name" in second["adv_../../c.txt"] and files.tree(folder)[1] == ["adv_a.txt", "adv_b.txt"]
    assert web.missing(wanted, log, web.stored(spark, str(tmp_path / "none"))).count() == 3


def zipped(**texts):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for name, text in texts.items():
            z.writestr(name.replace("__", "/").replace("_dot_", "."), text)
    return held.getvalue()


def test_archives(tmp_path):
    dest = str(tmp_path / "cache")
    files.put(f"{dest}/old.txt", b"old")
    assert files.extract_zip(zipped(top__new_dot_txt="new", top__d__x="x"), dest) == 2
    assert files.tree(dest) == (["d"], ["d/x", "new.txt"])
    for bad in (b"no archive", zipped(**{"..__x": "x"})):
        with pytest.raises((zipfile.BadZipFile, ValueError)):
            files.extract_zip(bad, dest)
        assert files.tree(dest)[1] == ["d/x", "new.txt"]
    assert files.create_package(dest, str(tmp_path / "o" / "p.zip")) == 2
    with zipfile.ZipFile(tmp_path / "o" / "p.zip") as z:
        assert z.namelist() == ["d/", "d/x", "new.txt"] and z.getinfo("d/").is_dir() and z.read("new.txt") == b"new"
    assert files.build_version({"BUILD_VERSION": "v"}) == "v" and files.build_version({}).startswith("auto-20")


def test_releases(tmp_path):
    dest, got = str(tmp_path / "pkg"), []

    def service(url, headers, timeout):
        got.append(url)
        return json.dumps({"tag_name": "v2", "assets": [{"browser_download_url": "http://host/z"}]}).encode() if url.endswith("api") else zipped(a="1")

    assert web.refresh_release("http://host/api", dest, service) == ("v2", True) and web.refresh_release("http://host/api", dest, service) == ("v2", False)
    assert got == ["http://host/api", "http://host/z", "http://host/api"]

    def down(*_):
        raise OSError("down")

    assert web.refresh_archive("http://host/z", dest, down) == "down" and files.exists(f"{dest}/a")
    with pytest.raises(OSError):
        web.refresh_archive("http://host/z", str(tmp_path / "none"), down)


def test_named_files_items_and_pairs(spark, tmp_path):
    rows = spark.createDataFrame([("a/é.txt", "x\ny"), ("b.txt", None)], "file string, content string")
    assert files.write_named(rows, str(tmp_path / "out")) == 2
    assert files.get(str(tmp_path / "out/a/é.txt")) == b"x\ny" and files.get(str(tmp_path / "out/b.txt")) == b""
    items = spark.createDataFrame([("u2", "new", 2), ("u1", "new", 1), ("u3", "changed", 3)], "uid string, status string, ord long")
    assert tables.export_items(items, "new", str(tmp_path / "e" / "new.json")) == 2
    assert [r["uid"] for r in json.loads((tmp_path / "e" / "new.json").read_text())] == ["u1", "u2"]
    assert tables.export_items(items, "none", str(tmp_path / "e" / "none.json")) == 0 and json.loads((tmp_path / "e" / "none.json").read_text()) == []
    for path in (str(tmp_path / "s.json"), str(tmp_path / "s")):
        assert tables.read_pairs(spark, path, "uid", "jp").count() == 0
        tables.write_pairs(spark.createDataFrame([("a", "1")], "uid string, jp string"), path)
        tables.write_pairs(tables.read_pairs(spark, path, "uid", "jp").unionByName(spark.createDataFrame([("b", "2")], "uid string, jp string")), path)
        assert sorted(map(tuple, tables.read_pairs(spark, path, "uid", "jp").collect())) == [("a", "1"), ("b", "2")]


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text("llm: {model: m, batch_size: 3}\npaths: {output: /abs, tables: 'hdfs://n/t'}\nmanifest: {url: u, version: 7, extra: 1}\ncharacter_names: {a: b, c: null}\n")
    got = load_config(tmp_path / "c.yaml", {"LLM_BATCH_SIZE": "9", "LLM_BASE_URL": "http://h"})
    assert (got["llm"]["batch_size"], got["llm"]["backend"], got["llm"]["skip_changed"], got["names"]) == (9, "openai", True, {"a": "b", "c": ""})
    assert (got["paths"]["output"], got["paths"]["tables"], got["paths"]["work"], got["manifest"].version) == ("/abs", "hdfs://n/t", os.path.join(str(tmp_path), "cache"), "7")
    with pytest.raises(ValueError, match="LLM_TIMEOUT"):
        load_config(tmp_path / "c.yaml", {"LLM_TIMEOUT": "soon"})
    with pytest.raises(ValueError, match="api_key"):
        validate_llm(got["llm"])
