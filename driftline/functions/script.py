"""Bracket-command script lines: parsing and rebuilding, as column expressions."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.text import strip, wrap
from driftline.schema import CHARACTER_KEYS, CONTEXT

WORD = r"[\p{L}\p{N}_]"


def _balanced(a: str, b: str, levels: int = 4) -> str:
    inner = rf"(?:[^\{a}\{b}]++)*+"
    for _ in range(levels - 1):
        inner = rf"(?:[^\{a}\{b}]++|\{a}{inner}\{b})*+"
    return rf"\{a}{inner}\{b}"


_NEXT = rf"[ \t]+[a-zA-Z_]{WORD}*="
#: key=value: a value is balanced {...} or [...] (to the end if it never closes), or runs to the next key or bare "=". The pattern counts four levels; ``DEEP`` bodies are scanned.
PAIR = rf"({WORD}+)=({_balanced('{', '}')}|{_balanced('[', ']')}|[{{\[][\s\S]*|(?![{{\[])(?!\z)(?:(?!{_NEXT})[\s\S](?:[^= \t]++|(?!{_NEXT})[ \t]|(?<=\\)=)*+)?)"
#: More opening signs of a kind than the pattern has levels.
DEEP = r"(?:\{[^{]*+){5}|(?:\[[^\[]*+){5}"
# Fixed values, the format's own: how the texts of choices are found (to read and to replace them).
CHOICE = rf"(?Ud)text=(.*?)\]?(?=\s+(?:text=|[a-zA-Z_]\w*=)|$)"
CHOICE_SPAN = rf"(?Ud)text=(.*?)(?=\s+(?:text=|[a-zA-Z_]\w*=)|$)"


def is_command(line: Column) -> Column:
    s = strip(line)
    return F.startswith(s, F.lit("[")) & s.rlike(rf"(?U)^\[{WORD}+\s") & F.contains(s, F.lit("]"))


def command(line: Column) -> Column:
    return F.regexp_extract(strip(line), rf"(?U)^\[({WORD}+)\s", 1)


def body(line: Column) -> Column:
    """What is between the command's white space and the last "]", blanks at either end included: they belong to values."""
    return F.regexp_extract(strip(line), rf"(?Us)^\[{WORD}+\s(.*)\]", 1)


_KEY = re.compile(r"(\w+)=")
_STOP = re.compile(r"[ \t]+[a-zA-Z_]\w*=|(?<!\\)=")
_SIGNS = {"{": re.compile(r"[{}]"), "[": re.compile(r"[\[\]]")}


def scan_pairs(text: str) -> list[tuple[str, str]]:
    """Keys and values in order of appearance, brackets counted to any depth."""
    found, at = [], 0
    while (key := _KEY.search(text, at)) and key.end() < len(text):
        start = key.end()
        opening, end = text[start], len(text)
        if opening in _SIGNS:
            depth = 0
            for sign in _SIGNS[opening].finditer(text, start):
                depth += 1 if sign.group() == opening else -1
                if not depth:
                    end = sign.end()
                    break
        elif stop := _STOP.search(text, start + (opening == "=")):
            end = stop.start()
        found.append((key.group(1), text[start:end]))
        at = end
    return found


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())])))
def _scanned(texts: pd.Series) -> pd.Series:
    """Null for null."""
    return texts.map(lambda t: None if t is None else [{"k": k, "v": v} for k, v in scan_pairs(t)])


def pairs(c: Column) -> Column:
    """array<struct<k,v>> in order of appearance."""
    deep = c.rlike(DEEP)
    return F.when(deep, _scanned(F.when(deep, c))).otherwise(_matched(c))


def _matched(c: Column) -> Column:
    return F.arrays_zip(F.regexp_extract_all(c, F.lit(PAIR), F.lit(1)).alias("k"), F.regexp_extract_all(c, F.lit(PAIR), F.lit(2)).alias("v"))


def value(kv: Column, key: str) -> Column:
    """The last value of a key, or null."""
    found = F.filter(kv, lambda p: p["k"] == key)
    return F.get(found, F.size(found) - 1)["v"]


def choices(c: Column) -> Column:
    """The texts of a choice group in order."""
    return F.regexp_extract_all(c, F.lit(CHOICE), F.lit(1))


def context_of(stem: Column) -> Column:
    """struct<story_type, character, chapter> from a script's stem such as adv_<story>_<character>_<chapter>."""
    name = F.regexp_replace(stem, "^adv_", "")
    keys = F.array(*[F.lit(k) for k in CHARACTER_KEYS])
    key = F.get(F.filter(F.split(name, "[-_]"), lambda t: F.array_contains(keys, t)), F.lit(0))
    at = F.instr(name, key)
    before = F.substring(name, F.lit(1), at - 1)
    story = F.regexp_replace(before, "[_-]+$", "")
    found = F.struct(F.when(story == "", name).otherwise(story).alias("story_type"), key.alias("character"), F.regexp_replace(F.substring(name, at + F.length(key), F.length(name)), "^[_-]+", "").alias("chapter"))
    none = F.struct(name.alias("story_type"), F.lit("").alias("character"), F.lit("").alias("chapter"))
    return F.when(key.isNull(), none).otherwise(found).cast(CONTEXT)


def once(c: Column, use) -> Column:
    """use(c) with c computed once, however often it is used there. c may hold a Python function, use not."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def replace_first(c: Column, old: Column, new: Column) -> Column:
    def put(x: Column) -> Column:
        at, text = x["at"], x["c"]
        return F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), x["new"], F.substring(text, at + F.length(x["old"]), F.length(text)))).otherwise(text)

    return once(F.struct(c.alias("c"), old.alias("old"), new.alias("new"), F.instr(c, old).alias("at")), put)


def replace_choices(c: Column, texts: Column) -> Column:
    """Wrap the i-th choice with texts[i] (map<int,string>); choices without a text stay."""
    hits = F.regexp_extract_all(c, F.lit(CHOICE_SPAN), F.lit(0))
    inner = F.regexp_extract_all(c, F.lit(CHOICE_SPAN), F.lit(1))
    gaps = F.split(c, CHOICE_SPAN, -1)
    new = F.transform(F.arrays_zip(hits.alias("h"), inner.alias("s")), lambda x, i: F.when(F.coalesce(F.try_element_at(texts, i), F.lit("")) == "", x["h"]).otherwise(F.concat(F.lit("text="), wrap(x["s"], F.try_element_at(texts, i)))))
    return F.array_join(F.zip_with(gaps, F.concat(new, F.array(F.lit(""))), lambda g, n: F.concat(g, n)), "")


def build_line(line: Column, texts: Column) -> Column:
    """A command line with its texts put in: texts is map<string,string> by field (text, name, text[i]); empty ones are skipped.

    What is found in the line is computed once: written out in full, each use would search the line anew.
    """
    whole = rf"(?Us)^(\[{WORD}+\s+)(.*)(\])"
    inner = F.regexp_extract(strip(line), whole, 2)
    said = once(pairs(inner), lambda kv: F.struct(F.coalesce(value(kv, "text"), F.lit("")).alias("text"), F.coalesce(value(kv, "name"), F.lit("")).alias("name")))
    cut = once(strip(line), lambda s: F.struct(s.rlike(whole).alias("is"), *[F.regexp_extract(s, whole, k).alias(n) for k, n in enumerate(("head", "inner", "tail"), 1)]))
    return once(F.struct(line.alias("line"), texts.alias("texts"), said.alias("had"), cut.alias("cut")), _built)


def _built(x: Column) -> Column:
    texts, inner, old = x["texts"], x["cut"]["inner"], x["had"]["text"]
    indexed = F.map_filter(texts, lambda k, v: k.rlike(r"^text\[\d+\]$"))
    numbered = F.transform_keys(indexed, lambda k, v: F.regexp_extract(k, r"(\d+)", 1).cast("int"))
    text, name = F.try_element_at(texts, F.lit("text")), F.try_element_at(texts, F.lit("name"))

    def with_text(out: Column) -> Column:
        put = replace_first(out, F.concat(F.lit("text="), old), F.concat(F.lit("text="), wrap(old, text)))
        return F.when((F.coalesce(text, F.lit("")) != "") & (old != ""), put).otherwise(out)

    def with_name(out: Column) -> Column:
        put = replace_first(out, F.concat(F.lit("name="), x["had"]["name"]), F.concat(F.lit("name="), name))
        return F.when(F.coalesce(name, F.lit("")) != "", put).otherwise(out)

    out = once(once(F.when(F.size(indexed) > 0, replace_choices(inner, numbered)).otherwise(inner), with_text), with_name)
    return F.when(x["cut"]["is"], F.concat(x["cut"]["head"], out, x["cut"]["tail"])).otherwise(x["line"])
