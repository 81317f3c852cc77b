"""Column expressions on multilingual text."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Iterable
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labels in brackets that name no speech (fixed values).
NON_SPEECH_LABELS = (
    "applause", "background music", "bgm", "breathing", "cheering", "cheers", "inaudible", "laughter", "laughs", "music", "sigh", "sighs", "silence", "singing",
    "呼吸声", "呼吸聲", "喝彩", "噪音", "拍手", "掌声", "掌聲", "无声", "无音乐", "歌声", "歌聲", "欢呼", "歡呼", "笑", "笑声", "笑聲", "背景音乐", "背景音樂", "静音", "音樂", "音乐",
    "息", "歓声", "無音", "笑い", "音楽", "鼻息",
)

#: Classes of sounds that count as singing or as speech (fixed values).
SINGING_LABELS = ("chant", "child singing", "choir", "female singing", "male singing", "rapping", "singing", "synthetic singing", "yodeling")
SPEECH_LABELS = (
    "child speech, kid speaking", "conversation", "female speech, woman speaking", "hubbub, speech noise, speech babble", "male speech, man speaking", "narration, monologue", "speech", "speech synthesizer",
)
MUSIC_LABELS = ("music", "musical instrument", "orchestra")

#: Display widths in hundredths of the font size (fixed values).
SPACE_WIDTH, WIDE_WIDTH, OTHER_WIDTH = 35, 100, 55


def character_class(test: Callable[[str], bool], last: int = sys.maxunicode) -> list[tuple[int, int]]:
    """Ranges of the code points for which `test` holds."""
    ranges: list[tuple[int, int]] = []
    for point in range(last + 1):
        if 0xD800 <= point < 0xE000 or not test(chr(point)):
            continue
        if ranges and ranges[-1][1] == point - 1:
            ranges[-1] = (ranges[-1][0], point)
        else:
            ranges.append((point, point))
    return ranges


def as_class(ranges: Iterable[tuple[int, int]]) -> str:
    """A bracket expression that both Java and RE2 read."""
    return "[" + "".join(rf"\x{{{a:x}}}" if a == b else rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in ranges) + "]"


@cache
def wide_ranges() -> list[tuple[int, int]]:
    return character_class(lambda c: unicodedata.east_asian_width(c) in "WF" and not unicodedata.combining(c) and not c.isspace())


@cache
def combining_ranges() -> list[tuple[int, int]]:
    return character_class(lambda c: unicodedata.combining(c) != 0 and not c.isspace())


def wide_class() -> str:
    return as_class(wide_ranges())


def combining_class() -> str:
    return as_class(combining_ranges())


@cache
def space_class() -> str:
    return as_class(character_class(str.isspace))


@cache
def punctuation_class() -> str:
    return as_class(character_class(lambda c: unicodedata.category(c)[0] == "P"))


@cache
def _widths() -> np.ndarray:
    """The width of every code point."""
    table = np.full(sys.maxunicode + 1, OTHER_WIDTH, np.int64)
    for kinds, width in ((wide_ranges(), WIDE_WIDTH), (combining_ranges(), 0), (character_class(str.isspace), SPACE_WIDTH)):
        for a, b in kinds:
            table[a : b + 1] = width
    return table


def code_point_widths(text: str) -> np.ndarray:
    return _widths()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]


@F.pandas_udf(T.LongType())
def _display_width(texts: pd.Series) -> pd.Series:
    known = texts.notna()
    total = np.concatenate(([0], np.cumsum(code_point_widths("".join(texts[known])))))
    ends = np.cumsum(texts[known].str.len().to_numpy(np.int64))
    found = pd.Series(pd.NA, index=texts.index, dtype="Int64")
    found[known] = total[ends] - total[np.concatenate(([0], ends[:-1]))] if len(ends) else ends
    return found


def display_width(text: Column) -> Column:
    """Estimated width in hundredths of the font size: integers, so sums are exact. One table lookup a code point."""
    return _display_width(text)


def without_punctuation(text: Column) -> Column:
    """Without category P characters; white space becomes single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, punctuation_class(), ""), f"{space_class()}+", " "))


def compact(text: Column) -> Column:
    return F.regexp_replace(text, space_class(), "")


def repetition_loops(text: Column, shortest: int = 12, longest: int = 200, times: int = 4, span: int = 160) -> Column:
    """The longest stretch, of at least `span` characters without white space, in which a phrase repeats; null if none."""
    phrase = rf"(?s)((.{{{shortest},{longest}}}?)\2{{{times - 1},}})"
    found = F.filter(F.regexp_extract_all(compact(text), F.lit(phrase), F.lit(1)), lambda m: F.length(m) >= span)
    return F.reduce(found, F.lit(None).cast("string"), lambda best, m: F.when(best.isNull() | (F.length(m) > F.length(best)), m).otherwise(best))


def loop_phrase(loop: Column, shortest: int = 12, longest: int = 200) -> Column:
    """The phrase that a stretch of repetition_loops repeats."""
    return F.regexp_extract(loop, rf"(?s)^(.{{{shortest},{longest}}}?)\1+", 1)


def overlap_length(previous: Column, following: Column, longest: int = 80, shortest: int = 3) -> Column:
    """Characters without white space that end one text and begin the next; 0 if fewer than `shortest`."""
    left, right = compact(previous), compact(following)
    sizes = F.sequence(F.lit(longest), F.lit(shortest))
    fitting = F.filter(sizes, lambda n: (n <= F.length(left)) & (n <= F.length(right)) & (F.right(left, n) == F.left(right, n)))
    return F.coalesce(F.get(fitting, F.lit(0)), F.lit(0))


def without_overlap(previous: Column, following: Column) -> Column:
    """The following text without what it repeats of the previous one, its own spacing kept."""
    n = overlap_length(previous, following)
    # a pattern per row: so many characters with the white space before them
    pattern = F.concat(F.lit(rf"(?s)^(?:{space_class()}*[^{space_class()[1:-1]}]){{"), n.cast("string"), F.lit(rf"}}{space_class()}*"))
    return F.when(n > 0, F.regexp_replace(following, pattern, F.lit(""))).otherwise(following)


CJK = r"\x{3400}-\x{9fff}\x{3040}-\x{30ff}\x{ac00}-\x{d7af}"


def join_fragments(left: Column, right: Column) -> Column:
    """One text of two: a hyphen joins, CJK edges touch, anything else gets a space."""
    a = F.trim(F.regexp_replace(left, f"{space_class()}+", " "))
    b = F.trim(F.regexp_replace(right, f"{space_class()}+", " "))
    hyphen = a.endswith("-") & ~a.endswith("--")
    cjk = a.rlike(f"[{CJK}][，、；：—]*$") & b.rlike(f"^[{CJK}]")
    return F.when(a == "", b).when(b == "", a).when(hyphen, F.concat(a.substr(F.lit(1), F.length(a) - 1), b)).when(cjk, F.concat(a, b)).otherwise(F.concat_ws(" ", a, b))


def ends_sentence(text: Column) -> Column:
    return F.trim(text).rlike(r"""(?:[.!?。！？…]+|\.{3,})["'”’」』）)\]]*$""")


def without_markers(text: Column) -> Column:
    """Bracketed non-speech labels removed, lines trimmed, empty lines dropped."""
    labels = "|".join(r"\s+".join(map(re.escape, label.split(" "))) for label in NON_SPEECH_LABELS)
    plain = F.regexp_replace(text, rf"(?i)[\[［【]\s*(?:{labels})\s*[\]］】]", "")
    lines = F.transform(F.split(plain, r"\r\n|\r|\n"), lambda line: F.trim(F.regexp_replace(line, r"\s+", " ")))
    return F.array_join(F.filter(lines, lambda line: line != ""), "\n")


def sample_thirds(text: Column, limit: int) -> Column:
    """Texts over the limit as parts from head, centre and tail."""
    part = limit // 3
    centre = (F.floor(F.length(text) / 2) - part // 2 + 1).cast("int")
    parts = F.concat_ws("\n...\n", F.left(text, F.lit(part)), text.substr(centre, F.lit(part)), F.right(text, F.lit(part)))
    return F.when(F.length(text) <= limit, text).otherwise(F.left(parts, F.lit(limit)))


def utf16_units(text: Column) -> Column:
    return (F.octet_length(F.encode(text, "UTF-16LE")) / 2).cast("long")


def truncated_utf16(text: Column, units: int) -> Column:
    """At most so many UTF-16 units, without half of a surrogate pair."""
    cut = F.substring(F.encode(text, "UTF-16LE"), 1, 2 * units)
    # a high surrogate at the end (its second byte is D8 to DB) lost its partner
    high = F.hex(F.substring(cut, 2 * units, 1)).isin("D8", "D9", "DA", "DB")
    whole = F.when(high, F.substring(F.encode(text, "UTF-16LE"), 1, 2 * units - 2)).otherwise(cut)
    return F.when(utf16_units(text) <= units, text).otherwise(F.decode(whole, "UTF-16LE"))


def numbered_lines(text: Column) -> Column:
    """Lines that are not blank, as 'L1: ...'."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda line: F.trim(line)), lambda line: line != "")
    return F.array_join(F.transform(lines, lambda line, i: F.concat(F.lit("L"), (i + 1).cast("string"), F.lit(": "), line)), "\n")


def without_prompt_marks(text: Column) -> Column:
    """Angle brackets and bars in their full-width forms; newlines as spaces."""
    return F.translate(F.translate(text, "<>｜", "＜＞￤"), "\n", " ")


def is_music(label: Column) -> Column:
    return label.isin(*MUSIC_LABELS) | label.endswith(" music") | label.contains("(musical)")


def without_final_punctuation(text: Column) -> Column:
    """Without plain punctuation at the end; question marks, exclamations and ellipses stay."""
    plain = F.regexp_replace(text, r"[，、；：。,;:]+$", "")
    period = F.regexp_replace(plain, r"(?<!\.)\.$", "")
    return F.when(F.trim(period) == "", text).otherwise(period)


def canonical_hash(*columns: Column) -> Column:
    """SHA-256 over values in a fixed order, apart by NUL."""
    return F.sha2(F.concat_ws("\x00", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns)), 256)
