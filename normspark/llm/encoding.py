"""Garbled text from a wrong encoding: latent chains per source and field, estimated by expectation-maximization.

A chain tells what happened to a text: encoded by one code and read by another, once or twice, or letters replaced by a
mark. Of each suspicious record the evidence for every chain is counted: how many letters the chain would explain that are
next to impossible in genuine text, and how many odd characters it leaves unexplained. Records of one pool (table and
field, or any source a caller names) share the unknown shares of the chains. Expectation gives each record a posterior over
the chains, maximization the shares of the pools; so what is weak evidence in one record counts more where the chain is
common. A record is garbled where the genuine chain has less than half, and is repaired by its most probable chain, unless
something was lost.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from normspark.llm.text import both
from normspark.llm.vietnamese import LETTERS, beyond, is_syllable
from normspark.operators.records import latest
from normspark.session import cut, release, table

# TCVN 5712 code points of the Vietnamese letters, as text in the order of the codes.
TCVN3 = dict(zip(
    [*range(0xA1, 0xAF), 0xB5, 0xB6, 0xB7, 0xB8, 0xB9, 0xBB, 0xBC, 0xBD, 0xBE, 0xC6, 0xC7, 0xC8, 0xC9, 0xCA, 0xCB, 0xCC, 0xCE, 0xCF, 0xD0, 0xD1, 0xD2, 0xD3, 0xD4, 0xD5, 0xD6, 0xD7, 0xD8, 0xDC, 0xDD, 0xDE, 0xDF, 0xE1, 0xE2, 0xE3, 0xE4, 0xE5, 0xE6, 0xE7, 0xE8, 0xE9, 0xEA, 0xEB, 0xEC, 0xED, 0xEE, 0xEF, *range(0xF1, 0xFF)],
    "ĂÂÊÔƠƯĐăâêôơưđàảãáạằẳẵắặầẩẫấậèẻẽéẹềểễếệìỉĩíịòỏõóọồổỗốộờởỡớợùủũúụừửữứựỳỷỹýỵ",
))
# VNI writes a mark as a character of its own after the letter.
VNI_MARKS = {"ø": "\u0300", "ù": "\u0301", "û": "\u0309", "õ": "\u0303", "ï": "\u0323", "â": "\u0302", "ê": "\u0306", "á": "\u0302\u0301", "à": "\u0302\u0300", "å": "\u0302\u0309", "ã": "\u0302\u0303", "ä": "\u0323\u0302", "é": "\u0306\u0301", "è": "\u0306\u0300", "ú": "\u0306\u0309", "ü": "\u0306\u0303", "ë": "\u0323\u0306"}
VNI_LETTERS = {"ñ": "đ", "ö": "ư", "ô": "ơ", "ò": "ị", "æ": "ỉ", "ó": "ĩ", "í": "í", "ì": "ì", "î": "ỵ"}

# capitals have marks of their own
VNI_MARKS |= {c.upper(): m for c, m in VNI_MARKS.items()}
VNI_LETTERS |= {c.upper(): d.upper() for c, d in VNI_LETTERS.items()}

#: Codes that UTF-8 bytes are read by.
READERS = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1251", "cp1258", "cp1250", "koi8-r", "cp866", "iso8859-15")
CHAINS = ("genuine", *(f"utf-8>{e}" for e in READERS), *(f"utf-8>{e}, twice" for e in ("cp1252", "latin-1", "mac_roman")), "tcvn3>latin-1", "vni>latin-1", "letters>?", "bytes>�")
#: Log odds that one explained unit gives a chain against genuine text, and that one odd character left over takes from it.
UTF8_UNIT, LEGACY_UNIT, MARK_UNIT, LOST_UNIT, LEFT_OVER = 4.0, 2.0, 1.5, 6.0, 0.02
#: A chain that explains nothing in a record is out of the question there.
NOTHING = -30.0
ROUNDS, SMOOTH = 6, 1.0


def _table(enc: str) -> dict[int, str]:
    out = {}
    for b in range(0x80, 0x100):
        try:
            out[b] = bytes([b]).decode(enc)
        except UnicodeDecodeError:
            out[b] = chr(b)
    return out


class Reader:
    """UTF-8 text read by another code: finds the sequences of such reading and puts them back."""

    def __init__(self, enc: str) -> None:
        t = _table(enc)
        self.back = {c: b for b, c in t.items()} | {chr(b): b for b in range(0x80, 0xA0)}
        cls = lambda bs: "[" + "".join(re.escape(c) for c, b in self.back.items() if b in bs) + "]"
        cont = cls(range(0x80, 0xC0))
        # the letters of Vietnamese and what else stands in such texts: Latin with marks, combining marks, punctuation
        self.unit = re.compile(f"{cls([0xC2, 0xC3, 0xC4, 0xC5, 0xC6])}{cont}|{cls([0xE1])}{cls([0xBA, 0xBB])}{cont}|{cls([0xE2])}{cls([0x80, 0x82, 0x84, 0x88, 0x89])}{cont}|{cls([0xCC, 0xCD])}{cont}")
        #: The first two of three, the third lost.
        self.cut = re.compile(f"{cls([0xE1])}{cls([0xBA, 0xBB])}(?!{cont})")

    def put_back(self, s: str) -> str:
        def one(m: re.Match) -> str:
            try:
                return bytes(self.back[c] for c in m.group()).decode("utf-8")
            except UnicodeDecodeError:
                return m.group()

        return self.unit.sub(one, s)


_READ = {e: Reader(e) for e in READERS}
_ODD = re.compile(rf"[^\x00-\x7f{LETTERS}]")
_LATIN1_TOKEN = re.compile(r"(?<!\w)[A-Za-z\xa1-\xff]*[\xa1-\xff][A-Za-z\xa1-\xff]*(?![\w\u200b-\u200d\u2060\ufeff\u0300-\u036f])")
_ASKED = re.compile(r"(?<![\w?/=&])(?=[^\s/=&?]*\?)[^\W\d_?]*\?+[^\W\d_]+(?:\?*[^\W\d_]*)*(?![\w/=&])")
_QUICK = re.compile(rf"[^\x00-\x7f{LETTERS}]|\?\w")
_ENTITY = re.compile(r"&(?:[A-Za-z]+\d{0,2}|#\d+|#[xX][0-9a-fA-F]+);")


def _tcvn(word: str) -> str:
    return "".join(TCVN3.get(ord(c), c) for c in word)


def _vni(word: str) -> str:
    import unicodedata

    out: list[str] = []
    for c in word:
        if c in VNI_MARKS and out and unicodedata.normalize("NFD", out[-1][-1])[0] in "aeouAEOUyY":
            out.append(VNI_MARKS[c])
        elif c in VNI_LETTERS:
            out.append(VNI_LETTERS[c])
        else:
            out.append(c)
    return unicodedata.normalize("NFC", "".join(out))


def _own(w: str) -> bool:
    """Whether a word reads as it stands: a syllable, without capitals inside; a soft hyphen may just be one."""
    w = w.replace("\u00ad", "")
    return (w.islower() or w.isupper() or w[1:].islower() or len(w) == 1) and is_syllable(w)


def _legacy(tokens: list[str], read) -> tuple[int, int]:
    n = covered = 0
    for w in tokens:
        if len(w) < 2 or not any(c.isascii() for c in w) or _own(w):
            continue
        got = read(w)
        if got != w and is_syllable(got):
            n += 1
            covered += sum(c not in LETTERS and not c.isascii() for c in w)
    return n, covered


def evidence(text: str) -> np.ndarray | None:
    """Log odds of each chain against genuine text; None where nothing is suspicious."""
    if not _QUICK.search(text):
        return None
    odd = len(_ODD.findall(text))
    out = np.full(len(CHAINS), NOTHING)
    out[0] = 0.0
    k = 1
    if odd:
        once: dict[str, str] = {}
        for e in READERS:
            units = _READ[e].unit.findall(text)
            if n := len(units) + len(_READ[e].cut.findall(text)):
                out[k] = n * UTF8_UNIT - LEFT_OVER * (odd - sum(len(_ODD.findall(u)) for u in units))
                if e in ("cp1252", "latin-1", "mac_roman"):
                    once[e] = _READ[e].put_back(text)
            k += 1
        for e in ("cp1252", "latin-1", "mac_roman"):
            if e in once and (again := len(_READ[e].unit.findall(once[e]))):
                out[k] = out[1 + READERS.index(e)] + again * UTF8_UNIT
            k += 1
        tokens = _LATIN1_TOKEN.findall(text)
        for read in (_tcvn, _vni):
            n, covered = _legacy(tokens, read)
            if n:
                out[k] = n * LEGACY_UNIT - LEFT_OVER * (odd - covered)
            k += 1
    else:
        k += len(READERS) + 5
    if "?" in text and (asked := sum("?" in m for m in _ASKED.findall(text))):
        out[k] = asked * MARK_UNIT - LEFT_OVER * odd
    if lost := text.count("\ufffd"):
        out[k + 1] = lost * LOST_UNIT - LEFT_OVER * odd
    return out if out[1:].max() > NOTHING else None


def repair(text: str, chain: str) -> str | None:
    """The original text by ``chain``; None where something was lost."""
    if "�" in text or chain in ("letters>?", "bytes>�"):
        return None
    if chain.startswith("utf-8>"):
        e, _, twice = chain.removeprefix("utf-8>").partition(", ")
        for _ in range(2 if twice else 1):
            if _READ[e].cut.search(text):
                return None
            text = _READ[e].put_back(text)
        return text
    read = _tcvn if chain.startswith("tcvn3") else _vni

    # such text has no letter beyond Latin-1, so a stretch of words without any, from the first to the last word that
    # cannot stand as it is, was garbled as a whole; a text that has none at all, from end to end
    parts = re.split(r"(\s+)", text)
    lone = [_LATIN1_TOKEN.search(w) is not None and not _own(m := _LATIN1_TOKEN.search(w).group()) and is_syllable(read(m)) for w in parts]
    beyond = [any(ord(c) > 0xFF for c in w) for w in parts]
    if not any(beyond):
        lone[0] = lone[-1] = True
    at = 0
    while at < len(parts):
        if not lone[at]:
            at += 1
            continue
        end, k = at, at
        while k < len(parts) and not beyond[k]:
            end = k if lone[k] else end
            k += 1
        for i in range(at, end + 1):
            parts[i] = _LATIN1_TOKEN.sub(lambda m: g if is_syllable(g := read(m.group())) else m.group(), parts[i])
        at = end + 1
    return "".join(parts)


def suspicious(c: Column) -> Column:
    """Whether a value can be garbled at all: a character outside plain Vietnamese text, a mark within a word, or an entity,
    which may stand for any character (but for those that markup itself needs)."""
    asked = c.contains("?") & c.rlike(r"\?\p{L}")
    entity = c.contains("&") & c.rlike(r"&(?!(?:amp|lt|gt|quot|apos|nbsp);)(?:[A-Za-z]|#)")
    return beyond(c, r"\x00-\x7f") | asked | entity


def _seen(text: str, is_html: bool) -> str:
    """The text with the characters beyond ASCII that its entities stand for; entities that markup needs stay."""
    def one(m: re.Match) -> str:
        c = html.unescape(m.group())
        return m.group() if c.isascii() else c

    return _ENTITY.sub(one, text) if is_html and "&" in text else text


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in batches:
        got = [(i, x) for i, (s, t) in enumerate(zip(p.source_table, p.text)) if t and (x := evidence(_seen(t, s == "content"))) is not None]
        if got:
            at = [i for i, _ in got]
            yield pd.DataFrame({"source_table": p.source_table.to_numpy()[at], "key": p.key.to_numpy()[at], "odds": [x.tolist() for _, x in got]})


def _start() -> list[float]:
    return [0.5] + [0.5 / (len(CHAINS) - 1)] * (len(CHAINS) - 1)


def _let(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.transform(F.array(value), f)[0]


def _posterior(odds: Column, share: Column) -> Column:
    part = lambda e: _let(F.aggregate(e, F.lit(0.0), lambda a, b: a + b), lambda all_: F.transform(e, lambda x: x / all_))
    z = F.zip_with(odds, share, lambda o, s: o + F.log(s))
    return _let(z, lambda z: _let(F.array_max(z), lambda most: _let(F.transform(z, lambda x: F.exp(x - most)), part)))


def _judged(measured: DataFrame, shares: DataFrame | None) -> DataFrame:
    """``measured`` with ``post``, the posterior of each chain."""
    start = F.array(*map(F.lit, _start()))
    m = measured.withColumn("share", start) if shares is None else measured.join(shares, "pool")
    return m.withColumn("post", _posterior(F.col("odds"), F.col("share"))).drop("share")


def shares(measured: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``pool, share``: the shares of the chains in each pool of ``pool, odds``, any number of either."""
    now: DataFrame | None = None
    for _ in range(rounds):
        n = _judged(measured.select("pool", "odds"), now).groupBy("pool").agg(F.count("*").alias("all"), *(F.sum(F.col("post")[i]).alias(f"n{i}") for i in range(len(CHAINS))))
        share = F.array(*((F.col(f"n{i}") + SMOOTH * s) / (F.col("all") + SMOOTH) for i, s in enumerate(_start())))
        before, now = now, cut(n.select("pool", share.alias("share")), "shares")
        if before is not None:
            release(before)
    return now


def garbled(records: DataFrame, pools: DataFrame | None = None) -> DataFrame:
    """``source_table, key, chain, confidence`` of the garbled records among ``source_table, key, text``.

    ``pools`` (source_table, key, pool) names the source and field whose records share their chains; without it, and for
    records it leaves out, the table does. Null and empty texts are genuine. Keys are taken as unique per table. Long texts
    are read whole. No garbled record, or an empty table, gives an empty result.
    """
    m = records.filter(suspicious(F.col("text"))).select("source_table", "key", "text").mapInPandas(_measure, "source_table string, key string, odds array<double>")
    if pools is None:
        m = cut(m.withColumn("pool", F.col("source_table")), "evidence")
    else:
        m = cut(cut(m, "evidence").join(pools, ["source_table", "key"], "left").withColumn("pool", F.coalesce("pool", "source_table")), "pooled")
    j = _judged(m, shares(m)).withColumn("others", F.slice("post", 2, len(CHAINS) - 1)).filter(F.col("post")[0] < 0.5)
    best = F.array_position("others", F.array_max("others"))
    return j.select("source_table", "key", F.element_at(F.array(*map(F.lit, CHAINS[1:])), best.cast("int")).alias("chain"), (1 - F.col("post")[0]).alias("confidence"))


def restored(records: DataFrame, pools: DataFrame | None = None) -> DataFrame:
    """``source_table, key, chain, confidence, original``: garbled records, with the original text where nothing was lost.

    Of a page, entities beyond ASCII come out as the characters they stand for.
    """
    g = garbled(records, pools)

    def fix(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            p["original"] = [repair(_seen(t, s == "content"), c) for s, t, c in zip(p.source_table, p.text, p.chain)]
            yield p.drop(columns="text")

    return g.join(records.filter(suspicious(F.col("text"))).select("source_table", "key", "text"), ["source_table", "key"]).mapInPandas(fix, "source_table string, key string, chain string, confidence double, original string")


def pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source_table, key, pool``: the source of each page and of each unit's norm, with the field."""
    m = table(spark, sf_dir, "metadata").select("id", "loaded_at", "nguon_thu_thap")
    m = latest(m, "id", "loaded_at", F.xxhash64("nguon_thu_thap")).select(F.col("id").cast("string").alias("norm_id"), F.col("nguon_thu_thap").alias("source"))
    c = table(spark, sf_dir, "component").select("comp_id", "norm_id", "updated_at")
    c = latest(c, "comp_id", "updated_at", F.xxhash64("norm_id")).join(m, "norm_id")
    u = c.select(F.lit("text_unit").alias("source_table"), F.concat("comp_id", F.lit("__tu")).alias("key"), "source")
    p = m.select(F.lit("content").alias("source_table"), F.col("norm_id").alias("key"), "source").unionByName(u)
    return p.select("source_table", "key", F.concat_ws(":", "source_table", "source").alias("pool"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of text_unit and pages of content with any garbled text."""
    return garbled(both(spark, sf_dir, suspicious), pools(spark, sf_dir)).select("source_table", F.col("key").alias("record_key"))


def p3_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Garbled records with their chain, its confidence and the original text (null where something was lost)."""
    return restored(cut(both(spark, sf_dir, suspicious).filter("text is not null"), "suspicious"), pools(spark, sf_dir)).withColumnRenamed("key", "record_key")


def garbled_units(units: DataFrame, pools: DataFrame | None = None) -> DataFrame:
    """Keys of the garbled ones among ``key, text`` of text units."""
    return garbled(units.select(F.lit("text_unit").alias("source_table"), "key", "text"), pools).select("key")
