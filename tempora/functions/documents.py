"""Loose JSON, nested values and whole-text functions that no expression states: Arrow-batched."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.functions.text import code_point_widths

_FENCE = re.compile(r"^\s*```[\w-]*\s*\n?(.*?)\n?```\s*$", re.S)


def loose_records(text: str | None, key: str = "cues") -> list[Any] | None:
    """The records of a model's answer: an array, an object that holds one under `key`, or values in a row.

    Code fences are taken off, commas between values are skipped. None if it is no JSON.
    """
    if text is None:
        return None
    fenced = _FENCE.match(text)
    body = (fenced.group(1) if fenced else text).strip()
    decode, found, at = json.JSONDecoder().raw_decode, [], 0
    while at < len(body):
        try:
            value, at = decode(body, at)
        except ValueError:
            return None
        found.append(value)
        rest = re.compile(r"[\s,]*").match(body, at)
        at = rest.end() if rest else at
    if len(found) == 1 and isinstance(found[0], list):
        return found[0]
    if len(found) == 1 and isinstance(found[0], dict) and isinstance(found[0].get(key), list):
        return found[0][key]
    return found or None


@F.pandas_udf(T.ArrayType(T.StringType()))
def json_records(texts: pd.Series) -> pd.Series:
    """loose_records of each text, every record as JSON."""
    found = (loose_records(t) for t in texts)
    return pd.Series([None if r is None else [json.dumps(x, ensure_ascii=False) for x in r] for r in found], dtype=object)


def _scalar(value: Any) -> str:
    return "" if value is None else json.dumps(value) if isinstance(value, bool) else " ".join(str(value).split())


def flat_lines(value: Any) -> list[str]:
    """path:value lines of a nested value in its order, white space collapsed; a list of scalars is one line."""
    lines, todo = [], [("", value)]
    while todo:
        path, item = todo.pop()
        nested = isinstance(item, list) and any(isinstance(v, (dict, list)) for v in item)
        if isinstance(item, dict):
            inner = [(".".join(filter(None, (path, _scalar(k)))), v) for k, v in item.items()]
            todo += reversed(inner)
        elif nested:
            todo += reversed([(f"{path}[{i}]", v) for i, v in enumerate(item)])
        else:
            text = "｜".join(map(_scalar, item)) if isinstance(item, list) else _scalar(item)
            lines.append(f"{path}:{text}" if path else text)
    return lines


@F.pandas_udf(T.ArrayType(T.StringType()))
def json_lines(texts: pd.Series) -> pd.Series:
    return pd.Series([flat_lines(json.loads(t)) if t else [] for t in texts], dtype=object)


@F.pandas_udf(T.StringType())
def normalised(texts: pd.Series) -> pd.Series:
    """NFKC with single spaces."""
    return pd.Series([None if t is None else " ".join(unicodedata.normalize("NFKC", t).split()) for t in texts], dtype=object)


def _width(text: str) -> int:
    return int(code_point_widths(text).sum())


#: Marks after which a line may break (fixed values).
BREAK_MARKS = "，、；：。！？,;:.!?…"


def two_lines(text: str, limit: int) -> str | None:
    """The most even split into lines of at most `limit` hundredths; breaks after marks, then at spaces, are preferred."""
    blank = np.array([c.isspace() for c in text], bool)
    ink = np.flatnonzero(~blank)
    if len(ink) < 2:
        return None
    widths = np.concatenate(([0], np.cumsum(code_point_widths(text))))
    at = np.arange(1, len(text))
    # the left line ends after its last character that is no space, the right one begins at its first
    before, after = np.searchsorted(ink, at) - 1, np.searchsorted(ink, at)
    at, before, after = (x[(before >= 0) & (after < len(ink))] for x in (at, before, after))
    left, right = widths[ink[before] + 1], widths[-1] - widths[ink[after]]
    marks = np.array([c in BREAK_MARKS for c in text], bool)[ink[before]]
    rank = np.where(marks, 0, np.where(blank[at - 1] | blank[at], 1, 2))
    uneven = np.abs(left - right)
    order = np.lexsort((at, uneven, rank, uneven + 100 * rank))
    order = order[(left <= limit)[order] & (right <= limit)[order]]
    if not len(order):
        return None
    best = order[0]
    lines = text[: ink[before[best]] + 1], text[ink[after[best]] :]
    return "\n".join(re.sub(r"[，、；：。,;:]+$", "", line) or line for line in lines)


def wrapped(text: Column, limit: int) -> Column:
    """two_lines of texts wider than the limit, others as they are; null if none fits."""

    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or _width(t) <= limit else two_lines(t, limit) for t in texts], dtype=object)

    return run(text)


#: Keys of a source's metadata that are passed on (fixed values).
METADATA_KEYS = (
    "channel", "channel_id", "uploader", "uploader_id", "creator", "categories", "tags", "series", "season", "season_number", "episode", "episode_number", "playlist", "playlist_title", "artist", "track", "album", "language",
)


def kept_metadata(metadata: Column) -> Column:
    """The listed keys of a map of strings with a value that is not empty."""
    return F.map_filter(metadata, lambda k, v: k.isin(*METADATA_KEYS) & v.isNotNull() & ~v.isin("", "[]"))


def request_messages(messages: Column) -> tuple[Column, Column]:
    """Chat messages (role, content) as instructions (system ones, joined) and the other turns."""
    text = F.array_join(F.transform(F.filter(messages, lambda m: m["role"] == "system"), lambda m: m["content"]), "\n\n")
    return text, F.filter(messages, lambda m: m["role"] != "system")


def layout(df: DataFrame, width: str, height: str, base_font: int = 48, base_edge: int = 1080, least: int = 18, most: int = 96) -> DataFrame:
    """Font size and line capacity (hundredths of it) of a picture, by its shorter edge."""
    edge = F.least(width, height)
    font = F.greatest(F.lit(least), F.least(F.lit(most), F.round(edge * base_font / base_edge))).cast("int")
    margin = F.round(F.col(width) * F.when(F.col(height) > F.col(width), 0.06).otherwise(0.08)).cast("int")
    return df.withColumn("font", font).withColumn("margin", margin).withColumn("capacity", F.floor(100 * (F.col(width) - 2 * F.col("margin")) / F.col("font")).cast("long"))


def template_filled(template: str, known: Sequence[str], **values: str) -> str:
    """A template with every placeholder replaced; others than the known ones are errors."""
    names = set(re.findall(r"\{\{(\w+)\}\}", template))
    if names != set(known) or names != set(values):
        raise ValueError(f"placeholders {sorted(names)} differ from {sorted(known)}")
    return re.sub(r"\{\{(\w+)\}\}", lambda m: values[m.group(1)], template)
