"""Text clean-up and scoring as column expressions."""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Characters that clean-up of web text replaces.
WEB = {
    "\u00a0": " ", "\u200b": "", "\u200c": "", "\u200d": "", "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2014": "-", "\u2015": "-",
    "\u2018": "'", "\u2019": "'", "\u201c": '"', "\u201d": '"', "\u2026": "...", "\u00ad": "", "\ufeff": "", "\u202f": " ", "\u2060": "",
}
#: Ligatures of page text, longer names first, and its spaces, dashes and quotes.
NAMED_LIGATURES = {"f_f_i": "ffi", "f_f_l": "ffl", "f_i": "fi", "f_l": "fl", "f_f": "ff"}
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl"}
PAGE = (
    {chr(c): " " for c in range(0x2000, 0x200B)} | {chr(c): "" for c in range(0x200B, 0x2010)} | {chr(c): "-" for c in [*range(0x2010, 0x2016), 0x2212]}
    | {"\u201a": ","} | {chr(c): "'" for c in (0x2018, 0x2019, 0x201B, 0x201C, 0x201D, 0x201E, 0x201F)}
)
#: Characters of assembled text.
ASSEMBLED = {"⁄": "/", "’": "'", "‘": "'", "“": '"', "”": '"', "•": "·"}

BAD = "�"
GLYPH = r"GLYPH<[0-9A-Fa-f]+>"
SLASH_G = r"(?:/G\d+){2,}"
SLASHED = r"^(?:/\w+\s*){2,}"
FRAGMENT = r"\b[A-Za-z](?:/[a-z]{1,3}\.[a-z]{1,3}){2,}\b"


def replaced(text: Column, table: dict[str, str]) -> Column:
    """``text`` with each key replaced: one pass for single characters, then the longer values."""
    single = {k: v for k, v in table.items() if len(k) == 1 and len(v) <= 1}
    order = sorted(single, key=lambda k: single[k] == "")  # translate drops characters without a counterpart
    out = F.translate(text, "".join(order), "".join(single[k] for k in order)) if single else text
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), [(k, v) for k, v in table.items() if k not in single], out)


def clean_web(text: Column) -> Column:
    return replaced(text, WEB)


def clean_page(text: Column) -> Column:
    return replaced(replaced(replaced(text, NAMED_LIGATURES), LIGATURES), PAGE)


def joined_lines(lines: Column) -> Column:
    """Lines as one text: a hyphen between two words at a line's end goes, other ends get a space."""
    words = r"(?U)\w+"
    def step(acc: Column, line: Column) -> Column:
        last = F.element_at(F.regexp_extract_all(acc.prev, F.lit(words), F.lit(0)), -1)
        first = F.element_at(F.regexp_extract_all(line, F.lit(words), F.lit(0)), 1)
        joins = F.coalesce(last.rlike(r"(?U)^[\w&&[^_]]+$") & first.rlike(r"(?U)^[\w&&[^_]]+$"), F.lit(False))
        end = F.when(~acc.prev.endswith("-"), F.concat(acc.prev, F.lit(" "))).when(joins, F.substring(acc.prev, 1, F.length(acc.prev) - 1)).otherwise(acc.prev)
        return F.struct(F.concat(acc.done, end).alias("done"), line.alias("prev"))
    start = F.struct(F.lit("").alias("done"), F.coalesce(F.get(lines, 0), F.lit("")).alias("prev"))
    folded = F.aggregate(F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1))), start, step, lambda a: F.concat(a.done, a.prev))
    return F.trim(replaced(folded, ASSEMBLED))


def quality(text: Column) -> Column:
    """0 for broken text; else 1, less a tenth per fragmented word if there are three or more."""
    fragments = F.size(F.regexp_extract_all(text, F.lit(FRAGMENT), F.lit(0)))
    bad = text.contains(BAD) | text.rlike(GLYPH) | text.rlike(SLASH_G) | text.rlike(SLASHED)
    return F.when(bad, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.lit(1.0) - F.when(fragments >= 3, fragments * 0.1).otherwise(F.lit(0.0))))


def markdown_escape(text: Column) -> Column:
    """Underscores escaped unless they are, then &, < and > as entities."""
    return F.replace(F.replace(F.replace(F.regexp_replace(text, r"(?<!\\)_", r"\\_"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def shortened_underscores(text: Column, most: int = 10) -> Column:
    return F.regexp_replace(text, f"_{{{most + 1},}}", "_" * most)


RTL = "[\u0590-\u08ff\ufb1d-\ufdff\ufe70-\ufeff]"


def direction(text: Column) -> Column:
    """right_to_left if the first character is, or more than half of all are."""
    n = F.length(text)
    rtl = n - F.length(F.regexp_replace(text, RTL, ""))
    return F.when((n > 0) & (F.substring(text, 1, 1).rlike(RTL) | (rtl > n / 2)), "right_to_left").otherwise("left_to_right")


def plain_controls(text: Column) -> Column:
    """Breaking hyphens (\\x02) as hyphens, trimmed."""
    return F.trim(F.replace(text, F.lit("\x02"), F.lit("-")))


def single_spaced(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", " ")


def code_language(text: Column) -> tuple[Column, Column]:
    """(language, rest) of a text that begins with ``<_language_>``; (null, the text) otherwise."""
    pattern = r"(?s)^<_([^_>]+)_>\s(.*)"
    marked = text.rlike(pattern)
    return F.when(marked, F.regexp_extract(text, pattern, 1)), F.when(marked, F.regexp_extract(text, pattern, 2)).otherwise(text)


def heading_style(style: Column) -> tuple[Column, Column]:
    """(label, level) of a style name of a word and a number in either order; other names are labels without a level."""
    after, before = r"^(\D+)(\d+)$", r"^(\d+)(\D+)"
    word = F.when(style.rlike(after), F.regexp_extract(style, after, 1)).when(style.rlike(before), F.regexp_extract(style, before, 2))
    number = F.when(style.rlike(after), F.regexp_extract(style, after, 2)).when(style.rlike(before), F.regexp_extract(style, before, 1)).cast("int")
    heading = F.lower(F.trim(word)) == "heading"
    return F.when(word.isNull(), style).when(heading, "Heading").otherwise(""), F.when(heading, number).when(word.isNotNull(), 0)


def label_name(text: Column) -> Column:
    return F.translate(F.lower(text), " -", "__")


def data_uri(uri: Column) -> tuple[Column, Column]:
    """(media type, bytes) of a base64 data URI; nulls for other ones."""
    is_data = uri.rlike(r"^data:[^;,]*;base64,")
    return F.when(is_data, F.regexp_extract(uri, r"^data:([^;,]*);", 1)), F.when(is_data, F.try_to_binary(F.split_part(uri, F.lit(","), F.lit(2)), F.lit("base64")))


def is_datetime(text: Column) -> Column:
    """Whether a text that is not only digits reads as an ISO date and time."""
    return F.coalesce(~text.rlike(r"^\d+$") & text.rlike(r"^\d{4}-\d{2}-\d{2}") & F.try_to_timestamp(text).isNotNull(), F.lit(False))


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """The ratio of matching blocks of two texts, 0 to 1."""
    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)])
