"""The stages from files to a package, with a service of our own."""

import json
import zipfile

import pytest

from driftline import app
from driftline.backend import EchoBackend
from driftline.config import load_config
from driftline.sinks import files
from driftline.sources import documents

CONFIG = "llm: {backend: echo, batch_size: 2, skip_changed: false}\ncharacter_names: {amao: 麻央}\n"


def lay(root, tree):
    for name, text in tree.items():
        files.put(f"{root}/{name}", (text if isinstance(text, str) else json.dumps(text, ensure_ascii=False)).encode())


@pytest.fixture()
def cfg(tmp_path):
    lay(tmp_path, {
        "config.yaml": CONFIG,
        "cache/server/res_raw/adv_dear_amao_01.txt": "[message text=すabc name=麻]\n# note\n[narration text=うdef]\n[choicegroup choices=[choice text=えx] choices=[choice text=おy]]",
        "cache/primary/local-files/resource/adv_dear_amao_01.txt": "[message text=<r\\=旧abc>T1</r> name=麻]\n# note\n[narration text=<r\\=うdef>T3</r>]",
        "cache/primary/local-files/masterTrans/Card.json": {"rules": {"primaryKeys": ["id"]}, "data": [{"id": "c1", "name": "P1", "n": 3}]},
        "cache/primary/local-files/genericTrans/d/g.json": {"かな": "G", "n": "x", "かず": 5},
        "cache/primary/local-files/localization.json": {"a": {"b": ["かな", "漢字"]}, "z": 1},
        "cache/primary/local-files/keep.txt": "kept",
        "cache/fallback/local-files/genericTrans/d/g.json": {"かな": "F", "ほか": "F2"},
        "cache/tables/Card.yaml": "- id: c1\n  name: かな札\n  n: 3\n",
        "cache/tables/New.yaml": "- id: 7\n  name: かな新\n- id: e\n  name: かな無\n",
    })
    return load_config(tmp_path / "config.yaml", {})


class Partial(EchoBackend):
    def translate(self, prompt):
        return "" if "master:New" in prompt else super().translate(prompt)


def test_stages(spark, cfg, tmp_path):
    items = {r.uid: r for r in app.extract(spark, cfg).collect()}
    stem = "adv_dear_amao_01"
    assert {u: (r.status, r.existing_cn) for u, r in items.items()} == {
        f"{stem}:1:text": ("changed", "T1"), f"{stem}:1:name": ("existing", "麻央"), f"{stem}:3:text": ("existing", "T3"), f"{stem}:4:text[0]": ("new", ""), f"{stem}:4:text[1]": ("new", ""),
        "master:Card:0:c1:name": ("existing", "P1"), "master:New:0:7:name": ("new", ""), "master:New:1:e:name": ("new", ""),
        "generic:local-files/genericTrans/d/g.json:かな": ("existing", "G"), "generic:local-files/genericTrans/d/g.json:ほか": ("existing", "F2"),
        "localization:a.b[0]": ("new", "かな"), "localization:a.b[1]": ("existing", "漢字"),
    }
    assert items[f"{stem}:1:text"].speaker == "麻" and items[f"{stem}:1:text"].file_context.character == "amao"
    in_order = [r.category for r in sorted(items.values(), key=lambda r: r.ord)]
    assert in_order == ["resource"] * 5 + ["master"] * 3 + ["generic"] * 2 + ["localization"] * 2
    assert app.export(spark, cfg) == {"new": 5, "changed": 1}

    said = []
    assert app.translate(spark, cfg, Partial, waits=(), report=said.append) == {"n_eligible": 6, "n_skipped": 0, "n_pending": 6, "n_answered": 4, "n_batches": 4, "n_failed_batches": 1}
    assert said[-1].startswith("[4/4] 100.0% ok 4 failed 1 | ")
    assert files.exists(f"{cfg['paths']['work']}/checkpoint")
    assert app.translate(spark, cfg, EchoBackend, waits=()) == {"n_eligible": 6, "n_skipped": 4, "n_pending": 2, "n_answered": 2, "n_batches": 1, "n_failed_batches": 0}
    assert not files.exists(f"{cfg['paths']['work']}/checkpoint")
    assert app.translate(spark, cfg, EchoBackend, waits=())["n_pending"] == 0
    cn = {r.uid: r.cn for r in documents.read_items(spark, f"{cfg['paths']['work']}/translated").collect()}
    assert cn[f"{stem}:1:text"] == "すABC" and cn[f"{stem}:4:text[1]"] == "おY" and cn[f"{stem}:3:text"] == "T3" and cn["master:New:0:7:name"] == "かな新"

    assert app.build(spark, cfg) == {"scripts": 1, "tables": 2, "flat": 1, "nested": 1, "applied": {"tables": 3, "flat": 1, "nested": 2}}
    out = tmp_path / "output" / "package"
    assert (out / f"local-files/resource/{stem}.txt").read_text() == "[message text=<r\\=すabc>すABC</r> name=麻央]\n# note\n[narration text=<r\\=うdef>T3</r>]\n[choicegroup choices=[choice text=<r\\=えx]>えX</r> choices=[choice text=<r\\=おy]>おY</r>]"
    read = lambda name: json.loads((out / "local-files" / name).read_text())
    assert read("masterTrans/Card.json") == {"rules": {"primaryKeys": ["id"]}, "data": [{"id": "c1", "name": "P1", "n": 3}]}
    assert read("masterTrans/New.json") == {"rules": {"primaryKeys": ["id"]}, "data": [{"id": 7, "name": "かな新"}, {"id": "e", "name": "かな無"}]}
    assert read("genericTrans/d/g.json") == {"かな": "G", "n": "x", "かず": 5} and read("localization.json") == {"a": {"b": ["かな", "漢字"]}, "z": 1}
    assert (out / "local-files/keep.txt").read_text() == "kept" and (out / "version.txt").read_text().startswith("auto-")
    assert app.package(cfg) == 7
    with zipfile.ZipFile(tmp_path / "output" / "package.zip") as z:
        assert "local-files/" in z.namelist()

    # built files are read back as an earlier package: brackets that wrapped choices keep are mended
    files.copy_tree(str(out), cfg["paths"]["primary"])
    lay(tmp_path, {"cache/tables/Card.yaml": "- id: c1\n  name: かな札二\n"})
    again = {r.uid: (r.status, r.existing_cn) for r in app.extract(spark, cfg).collect()}
    assert again["master:Card:0:c1:name"] == ("changed", "P1") and again["master:New:0:7:name"] == ("existing", "かな新")
    assert {u: again[u] for u in again if u.startswith(stem)} == {f"{stem}:1:text": ("existing", "すABC"), f"{stem}:1:name": ("existing", "麻央"), f"{stem}:3:text": ("existing", "T3"), f"{stem}:4:text[0]": ("existing", "えX"), f"{stem}:4:text[1]": ("existing", "おY")}


def test_stages_leave_no_intermediate_tables(spark, cfg):
    from driftline.shared import made

    before = made(spark)
    app.extract(spark, cfg)
    app.translate(spark, cfg, EchoBackend, waits=(), report=lambda said: None)
    app.build(spark, cfg)
    assert made(spark) == before and documents.read_items(spark, f"{cfg['paths']['work']}/translated").count() == 12
