"""Text predicates and normalisers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Code points that mark source text: CJK punctuation to Han.
SOURCE_CLASS = r"[\x{3000}-\x{9FFF}]"
#: Hiragana and katakana letters.
KANA_CLASS = r"[\x{3040}-\x{309F}\x{30A1}-\x{30FA}]"
NL = "\\n"  # the two characters that stand for a line break in scripts


def strip(c: Column) -> Column:
    """Drop white space, Unicode's included, at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def lines(c: Column) -> Column:
    return F.split(c, r"\r\n|\r|\n", -1)


def contains_source(c: Column, char_class: str = SOURCE_CLASS) -> Column:
    return c.rlike(char_class)


def looks_like_source(c: Column, char_class: str = KANA_CLASS) -> Column:
    """Whether letters of the source script remain once hashtags are gone."""
    return F.regexp_replace(c, r"(?U)#[^\s#]+", "").rlike(char_class)


def normalise_source(c: Column, tags: str = "r|em") -> Column:
    """Drop markup tags and unify dashes. The tag pattern and the two dashes are fixed values of the format."""
    return F.replace(F.regexp_replace(c, rf"</?(?:{tags})(?:\\=[^>]*)?>", ""), F.lit("—"), F.lit("―"))


def sources_equal(a: Column, b: Column, tags: str = "r|em") -> Column:
    return normalise_source(a, tags) == normalise_source(b, tags)


def normalise_answer(c: Column) -> Column:
    """Make an answer safe for one line: no trailing separator, line breaks as two characters, tags in the script's spelling. The patterns are fixed values of the format."""
    c = F.regexp_replace(c, r"(?:\r?\n|\\r\\n|\\n)+---\s*$", "")
    c = F.regexp_replace(c, r"\r\n|\r|\n", r"\\n")
    return F.replace(F.replace(c, F.lit("<r="), F.lit("<r\\=")), F.lit("</r\\>"), F.lit("</r>"))


def wrap(source: Column, answer: Column) -> Column:
    """Source and answer in the wrapper; a segment for each line if both have as many."""
    a = normalise_answer(answer)
    parts, answers = F.split(source, r"\\n", -1), F.split(a, r"\\n", -1)

    def one(x: Column, y: Column) -> Column:
        return F.concat(F.lit("<r\\="), x, F.lit(">"), y, F.lit("</r>"))

    many = F.array_join(F.zip_with(parts, answers, one), "\\r\\n")
    return F.when((F.size(parts) > 1) & (F.size(parts) == F.size(answers)), many).otherwise(one(source, a))


def no_text(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def best_text(*columns: Column) -> Column:
    """The first that is neither null nor empty, else an empty text."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def first_prefix(c: Column, table: dict[str, str]) -> Column:
    """The label of the first key that the text begins with, else the text."""
    rows = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in table.items()])
    return F.coalesce(F.get(F.filter(rows, lambda r: F.startswith(c, r["k"])), F.lit(0))["v"], c)


def first_containing(c: Column, names: dict[str, str]) -> Column:
    """The first non-empty name that contains the text, else null."""
    rows = F.array(*[F.lit(v) for v in names.values()]) if names else F.array().cast("array<string>")
    return F.get(F.filter(rows, lambda v: (v != "") & F.contains(v, c)), F.lit(0))


def mapped(c: Column, names: dict[str, str]) -> Column:
    """The name of a key, else the key."""
    if not names:
        return c
    return F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[c], c)


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?$", 1)


def content_key(c: Column) -> Column:
    return F.sha2(F.coalesce(c, F.lit("")), 256)
