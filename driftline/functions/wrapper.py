"""The translation wrapper <r\\=SOURCE>ANSWER</r>: texts without other markup are split by built-in functions; nested markup needs a stack, hence an Arrow UDF."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.text import looks_like_source

_EDGES = re.compile(r"<r\\=|</r\\?>")
_MARKS = re.compile(r"<r\\=[^>]*>|</r\\?>|<[^>]*>|<|>")
_BREAKS = re.compile(r"(?:\\r\\n|\\n)*")
#: A segment whose halves hold no markup, and the breaks after it.
_PLAIN = r"<r\\=([^<>]*+)>([^<>]*+)</r\\?>(?:\\r\\n|\\n)*+"


def _segment(text: str, at: int) -> tuple[str, int] | None:
    """The inside of the wrapper that opens at the place and where it ends, by matching opens and closes."""
    depth = 0
    for edge in _EDGES.finditer(text, at):
        depth += 1 if edge.group() == "<r\\=" else -1
        if not depth:
            return text[at + 4 : edge.start()], edge.end()
    return None


def _halves(inside: str) -> tuple[str, str] | None:
    """Source and answer: cut at the first ">" that belongs to no tag and stands outside ruby."""
    depth = 0
    for mark in _MARKS.finditer(inside):
        kind = mark.group()
        if kind == ">" and depth == 0:
            return inside[: mark.start()], inside[mark.end() :]
        if kind == "<":
            return None
        depth += kind.startswith("<r\\=") - bool(re.fullmatch(r"</r\\?>", kind))
    return None


def split_text(text: str) -> tuple[str, str]:
    """(source, answer) of a wrapped text, several segments joined by the two characters of a line break; (text, "") if it isn't one."""
    found, at = [], 0
    while text.startswith("<r\\=", at):
        segment = _segment(text, at)
        halves = _halves(segment[0]) if segment else None
        if halves is None:
            return text, ""
        found.append(halves)
        at = _BREAKS.match(text, segment[1]).end()
    if not found or at != len(text):
        return text, ""
    return tuple("\\n".join(x) for x in zip(*found, strict=True))


_HALVES = T.StructType([T.StructField("src", T.StringType()), T.StructField("dst", T.StringType())])


@F.pandas_udf(_HALVES)
def _scanned(texts: pd.Series) -> pd.DataFrame:
    """Nulls give null halves."""
    both = [(None, None) if t is None else split_text(t) for t in texts]
    return pd.DataFrame(both, columns=["src", "dst"])


def split_wrapped(c: Column) -> Column:
    """struct<src,dst>: source and answer, several segments joined by the two characters of a line break; (text, "") if it isn't a wrapped text. Nulls give null halves."""
    wrapped = F.startswith(c, F.lit("<r\\="))
    plain = F.regexp_replace(c, _PLAIN, "") == ""
    src, dst = (F.array_join(F.regexp_extract_all(c, F.lit(_PLAIN), F.lit(k)), "\\n") for k in (1, 2))
    hard = wrapped & ~plain
    easy = F.when(wrapped, F.struct(src.alias("src"), dst.alias("dst"))).otherwise(F.struct(c.alias("src"), F.when(c.isNotNull(), F.lit("")).alias("dst")))
    return F.when(hard, _scanned(F.when(hard, c))).otherwise(easy).cast(_HALVES)


def prior(field: Column, wrapped: Column, current: Column) -> Column:
    """struct<src,dst>: the earlier source and answer in a package's text; choices may be plain answers without a wrapper."""
    choice = F.startswith(field, F.lit("text["))
    at = F.instr(wrapped, F.lit("]>"))
    mended = F.when(choice & F.startswith(wrapped, F.lit("<r\\=")) & (at > 0), F.concat(F.substring(wrapped, F.lit(1), at - 1), F.substring(wrapped, at + 1, F.length(wrapped)))).otherwise(wrapped)
    split = split_wrapped(mended)
    plain = choice & (split["src"] != "") & (split["dst"] == "") & ((split["src"] != current) | ~looks_like_source(split["src"]))
    return F.when(plain, F.struct(current.alias("src"), split["src"].alias("dst"))).otherwise(split)
