"""Text, script and wrapper functions on literals."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from driftline.functions import script, text
from driftline.functions.jsontree import parse_path, set_path
from driftline.functions.wrapper import prior, split_text, split_wrapped
from driftline.sources import scripts


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first().x


def test_wrapper_shapes():
    assert split_text(r"<r\=A>B</r>") == ("A", "B")
    assert split_text(r"<r\=A>B</r\>") == ("A", "B")
    assert split_text("plain") == ("plain", "")
    assert split_text(r"<r\=A>B</r>\r\n<r\=C>D</r>") == (r"A\nC", r"B\nD")
    assert split_text(r"<r\=A『<r\=x>y</r>』Z>B</r>\r\n<r\=C>D</r>") == (r"A『<r\=x>y</r>』Z\nC", r"B\nD")
    assert split_text(r"<r\=A<em\=q>e</em>>B</r>") == (r"A<em\=q>e</em>", "B")
    assert split_text(r"<r\=A>B") == (r"<r\=A>B", "")
    assert split_text(r"<r\=A>B</r>rest") == (r"<r\=A>B</r>rest", "")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("abXぁ- ", max_size=5), st.text("abYぁ- ", max_size=5)), min_size=1, max_size=4))
def test_wrapper_round_trip(rows):
    joined = r"\r\n".join(rf"<r\={a}>{b}</r>" for a, b in rows)
    assert split_text(joined) == (r"\n".join(a for a, _ in rows), r"\n".join(b for _, b in rows))


def test_splitting_by_columns_is_splitting_by_scan(spark):
    rng = random.Random(5)
    parts = ["<r\\=", ">", "</r>", "</r\\>", "<em\\=x>", "</em>", "A", "b c", "\\r\\n", "\\n", "\n", "<r\\=S>T</r>", "<r\\=S>T</r>\\r\\n", "", "é<", "=", "<r\\=>", "\\"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(9))) for _ in range(3000)] + [r"<r\=A>B</r>\r\n" * 30_000]
    rows = spark.createDataFrame(list(enumerate(texts)) + [(-1, None)], "i int, t string").select("i", split_wrapped(F.col("t")).alias("x")).select("i", "x.*").collect()
    assert {r.i: (r.src, r.dst) for r in rows} == {-1: (None, None)} | {i: split_text(t) for i, t in enumerate(texts)}


def test_prior_translation(spark):
    def got(field, wrapped, current):
        r = one(spark, prior(F.col("f"), F.col("w"), F.col("c")), f=field, w=wrapped, c=current)
        return r.src, r.dst

    assert got("text[0]", r"<r\=S]>T</r>", "S") == ("S", "T")
    assert got("text[0]", "答案", "かな") == ("かな", "答案")
    assert got("text[0]", "かな", "かな") == ("かな", "")
    assert got("text[0]", "漢字", "漢字") == ("漢字", "漢字")
    assert got("text", "plain", "plain") == ("plain", "")


def test_normalise_and_wrap(spark):
    assert one(spark, text.normalise_answer(F.col("a")), a="a\nb<r=x>y</r\\>\n---") == r"a\nb<r\=x>y</r>"
    assert one(spark, text.wrap(F.col("s"), F.col("a")), s=r"A\nB", a="a\nb") == r"<r\=A>a</r>\r\n<r\=B>b</r>"
    assert one(spark, text.wrap(F.col("s"), F.col("a")), s=r"A\nB", a="a") == r"<r\=A\nB>a</r>"
    assert one(spark, text.sources_equal(F.col("a"), F.col("b")), a=r"<r\=x>漢</r>—", b="漢―")
    assert one(spark, text.looks_like_source(F.col("a")), a="#かな 漢字") is False
    assert one(spark, text.looks_like_source(F.col("a")), a="漢字かな") is True
    assert one(spark, text.strip(F.col("a")), a="　 x ") == "x"


def test_script_items(spark):
    lines = [("adv_dear_hski_01.txt", "[message text=A\\nB name={user}]\nno command\n[choicegroup choices=[choice text=一 clip=none] choices=[choice text=二]]\n[title text=T=x]\r\n[narration text={a=[b c]} k=v]\n[unclosed text=a")]
    found = scripts.items(scripts.numbered(spark.createDataFrame(lines, "file string, value string"))).orderBy("line", "seq")
    assert [tuple(r)[1:5] for r in found.collect()] == [(1, "message", "text", "A\\nB"), (1, "message", "name", "{user}"), (3, "choice", "text[0]", "一"), (3, "choice", "text[1]", "二"), (4, "title", "text", "T"), (5, "narration", "text", "{a=[b c]}")]
    c = one(spark, script.context_of(F.col("s")), s="adv_dear_hski_01-02")
    assert tuple(c) == ("dear", "hski", "01-02")
    assert tuple(one(spark, script.context_of(F.col("s")), s="adv_event_x")) == ("event_x", "", "")


def brute_pairs(body):
    """Sign by sign."""
    word, out, i = lambda ch: ch.isalnum() or ch == "_", [], 0

    def key_at(j):
        k = j
        while k < len(body) and word(body[k]):
            k += 1
        return k if j < k < len(body) and body[k] == "=" else None

    while i < len(body):
        if (k := key_at(i)) is None:
            i += 1
            continue
        key, i = body[i:k], k + 1
        if i >= len(body):
            break
        j, a = i, body[i]
        if a in "{[":
            b, depth, j = "}" if a == "{" else "]", 1, i + 1
            while j < len(body) and depth:
                depth += (body[j] == a) - (body[j] == b)
                j += 1
        else:
            while j < len(body):
                if body[j] in " \t":
                    n = j
                    while n < len(body) and body[n] in " \t":
                        n += 1
                    if n < len(body) and (body[n] == "_" or (body[n].isascii() and body[n].isalpha())) and key_at(n):
                        break
                elif body[j] == "=" and j > i and body[j - 1] != "\\":
                    break
                j += 1
        out.append((key, body[i:j]))
        i = j
    return out


def test_pairs_to_any_depth(spark):
    rng = random.Random(6)
    bodies = [f"clip={'{' * n}x{'}' * n} text=hello name=bob" for n in range(9)] + [f"clip={'[' * n}x=1 {']' * n} text=hello" for n in (4, 5, 40, 2000)]
    bodies += ["a={{{{{x}}}} text=t", "text==x", "text=", "a=\\=b c", "x=[{{{{{{]}}}}}} y=2"]
    bodies += ["".join(rng.choice(["{", "{{{", "}", "}}}", "[", "[[", "]", "]]", "key=", "text=", "é=", " ", "\t", "\\=", "=", "a", "1", "_"]) for _ in range(rng.randrange(40))) for _ in range(1500)]
    rows = spark.createDataFrame(list(enumerate(bodies)), "i int, b string").select("i", script.pairs(F.col("b")).alias("kv")).collect()
    assert {r.i: [tuple(p) for p in r.kv] for r in rows} == {i: brute_pairs(b) for i, b in enumerate(bodies)}
    five = "[message clip={{{{{x}}}}} text=hello name=bob]"
    assert [r.jp for r in scripts.items(spark.createDataFrame([("f", 1, five)], "file string, line int, text string")).orderBy("seq").collect()] == ["hello", "bob"]
    assert one(spark, script.build_line(F.col("l"), F.col("t")), l=five, t={"text": "T"}) == r"[message clip={{{{{x}}}}} text=<r\=hello>T</r> name=bob]"


def test_blanks_at_the_edges_belong_to_values(spark):
    def jp(line):
        return [(r.field, r.jp) for r in scripts.items(spark.createDataFrame([("f", 1, line)], "file string, line int, text string")).orderBy("seq").collect()]

    assert jp("[message text=hello ]") == [("text", "hello ")]
    assert jp("  [message  text= a  name=b\t] ") == [("text", " a"), ("name", "b\t")]
    assert jp("[choicegroup text=a text=b ]") == [("text[0]", "a"), ("text[1]", "b ")]
    assert one(spark, script.build_line(F.col("l"), F.col("t")), l="[message text=hello ]", t={"text": "T"}) == r"[message text=<r\=hello >T</r>]"


def test_build_line(spark):
    def built(line, texts):
        return one(spark, script.build_line(F.col("l"), F.col("t")), l=line, t=texts)

    assert built("[choicegroup text=A text=B text=C]", {"text[0]": "a", "text[2]": "c"}) == r"[choicegroup text=<r\=A>a</r> text=B text=<r\=C>c</r>]"
    assert built(r"[message text=A\nB name={user}]", {"text": "a\nb"}) == r"[message text=<r\=A>a</r>\r\n<r\=B>b</r> name={user}]"
    assert built("[message text=A name=N]", {"name": "M", "text": ""}) == "[message text=A name=M]"
    assert built("no command", {"text": "x"}) == "no command"


def test_json_paths():
    tree = {"a": {"b": [{"c": "x"}, "y"]}, "n": 1}
    assert parse_path("a.b[0].c") == ["a", "b", 0, "c"]
    assert set_path(tree, "a.b[0].c", "z") and tree["a"]["b"][0]["c"] == "z"
    assert not set_path(tree, "a.missing", "z") and not set_path(tree, "a.b[7]", "z")
