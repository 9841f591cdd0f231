"""Column expressions on legal text: normalising, splitting into lines, levels, citations, amendment phrases.

Everything is a JVM expression. ``(?U)`` makes white space, digits and word limits Unicode, ``(?iU)`` letters also.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from normspark import schemas as S


def strip(c: Column) -> Column:
    """Without white space of any kind around."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+$", "")


# What a marker of each level looks like, as patterns.
_ROMAN = r"[IVXLCDM\d]+"
_APPENDIX = r"(?:Phụ\s+lục|PHỤ\s+LỤC)"
LEVELS = (
    ("PhuLuc", rf"(?U)^\s*{_APPENDIX}\s*([Ss]ố\s+(?:[IVXLCDM]+|\d+)|[IVXLCDM]+|\d+|[A-ZĐ](?=\s|$))?"),
    ("Phan", rf"(?iU)^\s*Phần\s+(?:thứ\s+)?({_ROMAN})\b"),
    ("Chuong", rf"(?iU)^\s*Chương\s+({_ROMAN})\b"),
    ("Muc", r"(?iU)^\s*(Mục|Tiểu mục)\s+(\d+)"),
    ("Dieu", r"(?U)^\s*[Đđ]iều\s+(\d+[a-zđ]?)\s*[.:]?"),
    ("Khoan", r"(?U)^\s*(\d{1,2})\.\s+"),
    ("Diem", r"(?U)^\s*([a-zđ])\)\s+"),
)
LABEL = {"Phan": "Phần", "Chuong": "Chương", "Dieu": "Điều", "Khoan": "Khoản", "Diem": "Điểm"}
# Words before a marker that make it a citation.
_LEADER = r"(?:tại|theo|trong|của|nêu\s{1,9}tại|quy\s{1,9}định|căn\s{1,9}cứ|đề\s{1,9}cập|khoản\s{1,9}\d{1,9}(?:\s{1,9}[a-zđ]\))?)\s{0,99}"
# What begins a component within a line.
_BREAK = (
    rf"(?:(?-i:{_APPENDIX})\b|Phần\s+(?:thứ\s+)?{_ROMAN}\b|Chương\s+{_ROMAN}\b|Tiểu mục\s+\d+|(?<!Tiểu )Mục\s+\d+"
    r"|Điều\s+\d+[a-zđ]?\s*[.:]|(?<=\S)Điều\s+\d+)"
)


def normalised(md: Column) -> Column:
    """Odd spaces to plain ones, bold article markers to lines of their own, other emphasis to spaces."""
    t = F.replace(F.replace(md, F.lit("\u00a0"), F.lit(" ")), F.lit("\u200b"), F.lit(""))
    t = F.regexp_replace(t, r"(?iU)\*+\s*(Điều\s+\d+[a-zđ]?\s*\.?)\s*\*+", "\n$1")
    return F.regexp_replace(F.replace(F.replace(t, F.lit("**"), F.lit(" ")), F.lit("__"), F.lit(" ")), " {2,}", " ")


def split_at_headers(line: Column) -> Column:
    """The lines that one line is: broken before every marker within it, unless a citation leads up to the marker.

    A line that holds no such marker but begins with one is broken after it where a clause or a point follows. Blank
    pieces fall away. Lines without any of the markers' words are left alone; the look ahead comes first in the pattern, as
    it fails at once nearly everywhere.
    """
    within = F.regexp_replace(line, rf"(?iU)(?={_BREAK})(?<=.)(?<!{_LEADER})", "\n")
    # a lambda's variable stands for the first result, which would be worked out again at each use
    pieces = F.element_at(F.transform(F.array(within), lambda w: F.when(w != line, w).otherwise(F.regexp_replace(line, rf"(?iU)^({_BREAK})(?=\s*\d{{1,2}}\.\s+|(?-i:\s*[a-zđ]\)\s+))", "$1\n"))), 1)
    cut = F.filter(F.split(pieces, "\n"), lambda x: strip(x) != "")
    return F.when(line.rlike(r"(?iU)(?:Phụ\s+lục|Phần\s|Chương\s|Mục\s|Điều\s)"), cut).otherwise(F.filter(F.array(line), lambda x: strip(x) != ""))


def lines(md: Column) -> Column:
    """All lines of a document, split at headers, blank ones dropped."""
    return F.flatten(F.transform(F.split(normalised(md), r"\R|[\x1c-\x1e]"), split_at_headers))


def level(line: Column) -> Column:
    """The level whose marker begins the line, in fixed priority; null for body text."""
    return reduce(lambda c, p: c.when(line.rlike(p[1]), F.lit(p[0])), LEVELS[1:], F.when(line.rlike(LEVELS[0][1]), F.lit("PhuLuc")))


def by_level(lv: Column, f) -> Column:
    """``f(level, pattern)`` for the level of the row."""
    first, *rest = LEVELS
    return reduce(lambda c, p: c.when(lv == p[0], f(*p)), rest, F.when(lv == first[0], f(*first)))


def citation(line: Column, lv: Column) -> Column:
    """Keyword and number of a marker: the word as written for sections, the level's own label for others."""
    def one(name: str, pattern: str) -> Column:
        if name == "PhuLuc":
            n = strip(F.regexp_replace(F.regexp_extract(line, pattern, 1), r"(?U)^[Ss]ố\s+", ""))
            return F.when(n == "", F.lit("Phụ lục")).otherwise(F.concat(F.lit("Phụ lục "), n))
        if name == "Muc":
            return F.concat(F.regexp_extract(line, pattern, 1), F.lit(" "), F.regexp_extract(line, pattern, 2))
        return F.concat(F.lit(LABEL[name] + " "), F.regexp_extract(line, pattern, 1))

    return by_level(lv, one)


def title(line: Column, lv: Column) -> Column:
    """What follows the marker on its line, without punctuation around; null where nothing does."""
    rest = by_level(lv, lambda _, p: F.regexp_replace(line, p, ""))
    return F.nullif(F.regexp_replace(rest, r"^[ .:\-\t]+|[ .:\-\t]+$", ""), F.lit(""))


def article_number(c: Column) -> Column:
    """The number in an article's citation or line, null without one."""
    n = F.translate(F.regexp_extract(c, r"(?iU)Điều\s+(\d+)", 1), "０１２３４５６７８９", "0123456789")
    return F.nullif(n, F.lit("")).try_cast("int")


def letter_position(c: Column) -> Column:
    """Place of a point's letter in the alphabet of points, from 0; null for letters it lacks."""
    letter = F.lower(F.regexp_extract(c, r"(?iU)Điểm\s+([a-zđ])\b", 1))
    at = F.instr(F.lit(S.ALPHABET), letter)
    return F.when((letter != "") & (at > 0), at - 1)


# ---- amendments -----------------------------------------------------------------------------------------------------------

# How a place in a document is cited, and quoted words.
_PLACE = r"(?:Điểm\s+([a-zđ])\)?\s+)?(?:Khoản\s+(\d+[a-zđ]?)\s+)?Điều\s+(\d+[a-zđ]?)"
_QUOTED = r'"[^"]+"'
# The four phrases of an amendment, in order.
AMENDMENTS = (
    rf"(?iU)(?:Sửa đổi|Bổ sung)\s+{_PLACE}",
    rf"(?iU)Bãi bỏ\s+{_PLACE}",
    rf"(?iU)Thay thế cụm từ\s*{_QUOTED}\s*bằng cụm từ\s*{_QUOTED}\s+tại\s+{_PLACE}",
    rf"(?iU)Bỏ cụm từ\s*{_QUOTED}\s+tại\s+{_PLACE}",
)
# Words of amendment before an article.
PREFILTER = r"(?isU)(?:sửa đổi|bổ sung|bãi bỏ|thay thế|bỏ cụm).{0,300}Điều\s+\d"


def citation_path(*groups: Column) -> Column:
    """Point, clause and article, most specific first; missing ones left out, letters as written."""
    names = ("Điểm", "Khoản", "Điều")
    return F.concat_ws(" > ", *(F.when(g != "", F.concat(F.lit(n + " "), g)) for n, g in zip(names, groups)))


def amended(text: Column) -> Column:
    """The place that the first matching amendment phrase names; null without one."""
    return F.coalesce(*(F.when(text.rlike(p), citation_path(*(F.regexp_extract(text, p, i) for i in (1, 2, 3)))) for p in AMENDMENTS))


def may_amend(text: Column) -> Column:
    """An amending word with an article within 300 characters."""
    return text.rlike(PREFILTER)


def model_reply(reply: Column) -> Column:
    """The citation in a language model's reply; null where it says it doesn't know, or says something else."""
    got = strip(F.regexp_extract(reply, r'CITATION:\s*"?([^"\n]+)"?', 1))
    return F.when(F.upper(reply).contains("UNKNOWN") | (got == ""), None).otherwise(got)


def label(cit: Column, ttl: Column) -> Column:
    """A component's part of a context line: citation and title, the title cut to 120 characters."""
    t = strip(ttl)
    short = F.when(F.length(t) > S.LABEL_CUT, F.concat(F.substring(t, 1, S.LABEL_CUT), F.lit("…"))).otherwise(t)
    return F.when(F.coalesce(ttl, F.lit("")) == "", cit).otherwise(F.concat(cit, F.lit(" "), short))


# ---- units ---------------------------------------------------------------------------------------------------------------

HEADER = r"^\[([\s\S]*?)\](?=\n|$)"


def header(text: Column) -> Column:
    """The context of a unit, without brackets; null without one."""
    return F.when(text.rlike(HEADER), F.regexp_extract(text, HEADER, 1))


def body(text: Column) -> Column:
    """A unit's text after its context line."""
    return F.regexp_replace(F.regexp_replace(text, HEADER, ""), r"^\n+", "")


def format_class(text: Column) -> Column:
    h = header(text)
    return F.when(text.isNull(), "null_text").when(h.isNull(), "no_header").when(h.contains(">") | h.contains("→"), "ok").otherwise("header_no_separator")


def length_bucket(n: Column) -> Column:
    return F.when(n == 0, "0").when(n < 20, "<20").when(n < 100, "20-100").when(n < 1000, "100-1000").otherwise(">1000")


def prose_tables(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(r"(?m)^Bảng \["), F.lit(0)))


def has_pipe_table(text: Column) -> Column:
    """A row of cells and a separator row."""
    return text.rlike(r"(?m)^\s*\|.+\|") & text.rlike(r"(?m)^\s*\|[\s\-|:]+\|\s*$")


def text_score(text: Column) -> Column:
    """Quality of a component's text: its length, a thousandth of it for a table's text, 0 for none."""
    n = F.coalesce(F.length(text), F.lit(0)).cast("double")
    return F.when(F.coalesce(text.startswith("Bảng ["), F.lit(False)), n * 0.001).otherwise(n)
