"""Text kernels shared by the corpus operators: the text a reader of a page sees, words, and records."""

from __future__ import annotations

import html as _html
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from normspark.operators.records import latest
from normspark.session import table

_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|title)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_INLINE = re.compile(r"</?(?:a|abbr|b|bdi|bdo|big|cite|code|dfn|em|font|i|img|ins|del|kbd|mark|q|s|samp|small|span|strike|strong|sub|sup|tt|u|var|wbr)(?=[\s/>])[^>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>|<!doctype[^>]*>|<\?[^>]*>", re.I)
WORD = re.compile(r"[^\W_]+")


def visible(page: str | None) -> str:
    """The text a reader of ``page`` sees: scripts, styles and comments gone, inline tags joined, blocks on own lines."""
    if not page:
        return ""
    if "<" in page:
        page = _TAG.sub("\n", _INLINE.sub("", _HIDDEN.sub("", page)))
    return _html.unescape(page) if "&" in page else page


def body(text: str | None) -> str:
    """A unit's stored body: what follows its context line."""
    return "" if not text else text.partition("\n")[2]


def text_units(spark: SparkSession, sf_dir: str, only: Callable[[Column], Column] | None = None) -> DataFrame:
    """``key, text`` of each content unit, one row per unit_id (latest updated_at).

    ``only`` tells of a text whether it matters: others are null in the result, so that they need not be moved to find the
    latest row.
    """
    t = table(spark, sf_dir, "text_unit").filter("type = 'noi_dung'").select("unit_id", "updated_at", *_text("accumulated_text", only))
    return latest(t, "unit_id", "updated_at", F.col("tie")).select(F.col("unit_id").alias("key"), "text")


def contents(spark: SparkSession, sf_dir: str, only: Callable[[Column], Column] | None = None) -> DataFrame:
    """``key, text`` (html) of each content page, one row per id; ``only`` as for units."""
    t = table(spark, sf_dir, "content").select("id", "loaded_at", *_text("content_html", only))
    return latest(t, "id", "loaded_at", F.col("tie")).select(F.col("id").cast("string").alias("key"), "text")


def _text(column: str, only: Callable[[Column], Column] | None) -> list[Column]:
    c = F.col(column)
    return [F.xxhash64(c).alias("tie"), (c if only is None else F.when(only(c), c)).alias("text")]


def both(spark: SparkSession, sf_dir: str, only: Callable[[Column], Column] | None = None) -> DataFrame:
    """``source_table, key, text`` of the records of text_unit and content."""
    return (
        text_units(spark, sf_dir, only).select(F.lit("text_unit").alias("source_table"), "key", "text")
        .unionByName(contents(spark, sf_dir, only).select(F.lit("content").alias("source_table"), "key", "text"))
    )
