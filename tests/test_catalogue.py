"""Catalogue queries over texts with script signs, markup, rules and nulls, against brute force."""

import re
from hashlib import sha256

import pytest

from driftline.plans import catalogue
from tests.test_functions import brute_pairs

TURNS = ["plain words", None, "", "  ", "a=b", "k = v x=y", "[open", "close]", "[a [b]] c", "{x} clip={{{{{y}}}}} z", "text=inner name=other", "one\nlist[0] = {1: 2}\r\n--- x=1", "<r\\=山>やま</r> 富士", "x]", "] text=q", "a\\=b", "tab\tkey=v"]
DOCS = ["plain", None, "", " ", "a\nb", "a<b>c", "1 > 2", "x\\ny", "q\\", "r\rs\r\nt", "---", "a\n---\n", "<r\\=山>やま</r>\nx", "<em\\=・>e</em>", "</r>", "<r\\=", "a\n<b\nc>", "code <T> => {}\nnext"]


def digest(t):
    return sha256(t.encode()).hexdigest()


def wrapped(source, answer):
    a, b = source.split("\\n"), answer.split("\\n")
    both = zip(a, b, strict=True) if len(a) > 1 and len(a) == len(b) else [(source, answer)]
    return "\\r\\n".join(f"<r\\={x}>{y}</r>" for x, y in both)


def halves(text):
    """Sign by sign."""
    out, at = [], 0
    while text.startswith("<r\\=", at):
        depth, i, end = 0, at, None
        while i < len(text) and end is None:
            mark = next((m for m in ("<r\\=", "</r\\>", "</r>") if text.startswith(m, i)), "")
            depth += {"<r\\=": 1, "": 0}.get(mark, -1)
            i += len(mark) or 1
            if mark and not depth:
                end = i - len(mark)
        if end is None:
            return text, ""
        inside, ruby, j, cut = text[at + 4 : end], 0, 0, None
        while j < len(inside) and cut is None:
            close = next((m for m in ("</r\\>", "</r>") if inside.startswith(m, j)), "")
            if close:
                ruby, j = ruby - 1, j + len(close)
            elif inside[j] == "<":
                ruby += inside.startswith("<r\\=", j)
                if (j := inside.find(">", j) + 1) == 0:
                    return text, ""
            elif inside[j] == ">" and not ruby:
                cut = j
            else:
                j += 1
        if cut is None:
            return text, ""
        out.append((inside[:cut], inside[cut + 1 :]))
        at = i
        while m := next((m for m in ("\\r\\n", "\\n") if text.startswith(m, at)), ""):
            at += len(m)
    return ("\\n".join(a for a, _ in out), "\\n".join(b for _, b in out)) if out and at == len(text) else (text, "")


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("signs"))
    spark.createDataFrame([(i // 4, i % 4, "user" if i % 2 else "helper", t) for i, t in enumerate(TURNS)], "conv_id long, turn int, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    spark.createDataFrame([(i, t, "en") for i, t in enumerate(DOCS)], "doc_id long, text string, lang string").write.parquet(f"{folder}/documents.parquet")
    return folder


def turns():
    for i, t in enumerate(TURNS):
        said = re.sub(r"[^\x20-\U0010FFFF]", " ", re.sub(r"\r\n|\r|\n", r"\\n", t or "")).strip(" ")
        yield str(i // 4), i % 4 + 1, "user" if i % 2 else "helper", said


def test_lines_with_signs(spark, sf):
    items, speakers, files = set(), set(), {}
    for file, line, role, said in turns():
        body = f"text={said} name={role}"
        kv = dict(brute_pairs(body))
        items |= {(file, line, "message", k, kv[k]) for k in ("text", "name") if k in kv}
        if "text" in kv:
            speakers.add((file, line, kv["text"], kv.get("name")))
            if line % 2 == 0 and kv["text"]:
                body = body.replace(f"text={kv['text']}", f"text={wrapped(kv['text'], f'T{line}')}", 1)
        files.setdefault(file, []).append(f"[message {body}]")
    assert {tuple(r) for r in catalogue.command_parse(spark, sf, escape=False).collect()} == items
    assert {tuple(r) for r in catalogue.speaker_for_text(spark, sf, escape=False).collect()} == speakers
    assert {tuple(r) for r in catalogue.script_rebuild(spark, sf, escape=False).collect()} == {(f, digest("\n".join(x))) for f, x in files.items()}


def test_choices_with_signs(spark, sf):
    want = set()
    for file, line, role, said in turns():
        body = f"choices=[choice text={said}] choices=[choice text={role}]"
        found = re.findall(r"text=(.*?)(?:\](?=\s+[a-zA-Z_]\w*=|$)|(?=\s+(?:text=|[a-zA-Z_]\w*=)|$))", body)
        want |= {(file, line, "choice", f"text[{i}]", t) for i, t in enumerate(found)}
    assert {tuple(r) for r in catalogue.choice_indexed(spark, sf, escape=False).collect()} == want


def test_wrapping_with_signs(spark, sf):
    both = []
    for i, t in enumerate(DOCS):
        s = (t or "").replace("\n", "\\n")
        both.append((i, wrapped(s, "\\n".join(f"EN{len(x)}" for x in s.split("\\n")))))
    assert {tuple(r) for r in catalogue.wrap_multiline(spark, sf, escape=False).collect()} == {(i, digest(w)) for i, w in both}
    assert {tuple(r) for r in catalogue.split_wrapped_back(spark, sf, escape=False).collect()} == {(i, digest(halves(w)[0]), halves(w)[1]) for i, w in both}


def test_sql_follows_hard_texts(spark, sf):
    """Where the signs are escaped, the SQL has the query's rows, also of nulls, blanks and texts with signs."""
    import duckdb

    from driftline.plans import oracles

    con = duckdb.connect()
    for t in ("conversations", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet/*.parquet'")
    for name in ("command_parse", "choice_indexed", "speaker_for_text", "script_rebuild", "wrap_multiline", "split_wrapped", "json_flatten"):
        rows = catalogue.QUERIES[name](spark, sf)
        found = con.execute(oracles.ORACLES[name])
        names = [d[0] for d in found.description]
        assert sorted(map(str, found.fetchall())) == sorted(str(tuple(r)) for r in rows.select(*names).collect()), name


def test_leaves_with_nulls(spark, sf):
    got = [(r.conv_id * 4 + r.k, r.path, r.text_sha256) for r in catalogue.json_flatten(spark, sf).collect()]
    want = [(i, p, digest(x)) for i, t in enumerate(TURNS) for p, x in (("turn.role", "user" if i % 2 else "helper"), ("turn.said[0]", t), ("turn.said[1]", "user" if i % 2 else "helper")) if x is not None]
    assert sorted(got) == sorted(want)


def test_manifest_wants_empty_files(spark, tmp_path):
    rows = [(0, "https://a", "x"), (4, "https://b", ""), (8, "https://c", None), (1, "https://d", "x"), (2, "http://e", "x"), (3, "https://f#top", "x")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert {r.page_id for r in catalogue.manifest_filter(spark, str(tmp_path)).collect()} == {4, 8, 1}


def test_names_beyond_the_bound(spark, tmp_path):
    spark.createDataFrame([(i, {1100: "xSIx", 1101: "ySIy", 1102: ""}.get(i, "-")) for i in range(1200)], "n_nationkey long, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(1, "ASIA"), (2, "AFRICA"), (3, None)], "r_regionkey long, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    assert {tuple(r) for r in catalogue.first_name_match(spark, str(tmp_path)).collect()} == {(1, "xSIx"), (2, None), (3, None)}


def test_moved_places_meet_no_others(spark, tmp_path):
    """Parts whose keys are a million apart and share a name: the fallback has them under other places only."""
    import duckdb

    from driftline.plans import oracles

    rows = [(k, "a name", f"B{k}", f"T{k}") for k in (1, 3, 999_999, 1_000_001, 1_000_003)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    got = catalogue.dup_id_index_join(spark, str(tmp_path)).select("uid", "rec_idx", "jp", "existing_cn").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(f"SELECT uid, rec_idx, jp, existing_cn FROM ({oracles.ORACLES['dup_id_index_join']})").fetchall())
    assert {r.existing_cn for r in got} == {"B1000003"}
