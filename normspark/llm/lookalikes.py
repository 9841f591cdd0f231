"""Visually identical text in one consistent form: vocabulary tries under a weighted edit automaton.

The vocabulary is what the corpus itself spells plainly, counted over all texts. Each distinct token with unusual characters
is walked through a trie of it: ignorable characters are skipped and look-alikes of other scripts and widths followed as the
letters they look like, at no cost; letters that look alike in some fonts only have a weight, any other edit is ruled out. Of
the words reached, the cheapest and among these the commonest is the canonical spelling. Tokens that reach none (new words,
names, numbers) are normalised by table, to the same form letter by letter, but for the letters with a weight.

Tokens and the words they may reach are dealt out to tries by what the token reads as, so no trie holds the vocabulary, and
none is limited: words that no unusual token reads as are never moved.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from normspark.llm.encoding import garbled_units, pools
from normspark.llm.text import text_units
from normspark.llm.vietnamese import LETTER_CLASS, LETTERS, beyond
from normspark.operators.records import latest
from normspark.session import cut, table

# Letters of other scripts that look like Latin ones, in the order of the Latin letters beside them.
ALIKE = dict(zip("АВЕЅІЈКМНОРСТУХҮԌԚԜаеіјорсухѕһԁԛԝү", "ABESIJKMHOPCTYXYGQWaeijopcyxshdqwy"))
ALIKE |= dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳοϲνρι", "ABEZHIKMNOPTYXCjocvpi"))
ALIKE |= dict(zip("ÐƉðɖıɡɑᴏᴠ", "ĐĐđđigaov"))
#: Alike in some fonts only: each has a weight, and a known word has to vouch for it.
NEARLY = dict(zip("кмтвнгпαγκτυχω", "kmtbhrnaykvxxw")) | {"υ": "u", "τ": "t", "к": "k"}
IGNORED = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f"
SPACES = "\t\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000"
HYPHENS = "\u2010\u2011\ufe63\uff0d"

_IGNORED = re.compile(f"[{IGNORED}]")
_SPACE = re.compile(f"[{SPACES}]")
_HYPHEN = re.compile(f"[{HYPHENS}]")
# letters and digits of unusual width or kind: full width, Roman numerals as one sign, ligatures, mathematical alphabets
_KIND = re.compile("[０-９Ａ-Ｚａ-ｚⅠ-ↈﬀ-ﬆ\U0001d400-\U0001d7ff]")
_MARKED = re.compile("[^\u0300-\u036f][\u0300-\u036f]+")
_FOREIGN = re.compile("[" + "".join(ALIKE) + "".join(NEARLY) + "]")
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ʯḀ-ỿ]")
_TOKEN = re.compile(f"[\\w\u0300-\u036f{IGNORED}]+")
_ODD = re.compile(rf"[^\x20-\x7e\n\r{LETTERS}]")
_PLAIN_WORD = rf"[a-zA-Z{LETTER_CLASS}]+"
#: What an edit of the automaton costs.
FREE, WEIGHT = 0, 1


def trie(words: dict[str, int]) -> dict:
    """Nested by the characters of the decomposed words; under "" the count and the word."""
    root: dict = {}
    for w, n in words.items():
        node = root
        for c in unicodedata.normalize("NFD", w):
            node = node.setdefault(c, {})
        node[""] = (n, w)
    return root


def edits(c: str) -> list[tuple[str, int]]:
    """What the character may be read as, and the cost of each reading."""
    if _IGNORED.match(c):
        return [("", FREE)]
    out = [(c, FREE)]
    if c in ALIKE:
        out.append((unicodedata.normalize("NFD", ALIKE[c]), FREE))
    if c in NEARLY:
        out.append((NEARLY[c], WEIGHT))
    if _KIND.match(c):  # may stand for several letters
        out.append((unicodedata.normalize("NFKC", c), FREE))
    return out


def walk(token: str, root: dict) -> str | None:
    """The cheapest word of the trie that ``token`` spells, or None. Ties go to the commonest, then to the smaller word."""
    states: dict[int, tuple[int, dict]] = {id(root): (0, root)}
    for c in unicodedata.normalize("NFD", token):
        nxt: dict[int, tuple[int, dict]] = {}
        for cost, node in states.values():
            for reading, more in edits(c):
                to = node
                for x in reading:
                    to = to.get(x) if to else None
                if to is not None and (id(to) not in nxt or cost + more < nxt[id(to)][0]):
                    nxt[id(to)] = (cost + more, to)
        states = nxt
        if not states:
            return None
    ends = [(cost, -node[""][0], node[""][1]) for cost, node in states.values() if "" in node]
    return min(ends)[2] if ends else None


def reading(token: str) -> str:
    """The token with every look-alike, weighted ones too, as its Latin letter: words it may reach read so as they stand."""
    t = _KIND.sub(lambda m: unicodedata.normalize("NFKC", m.group()), _IGNORED.sub("", token))
    return unicodedata.normalize("NFC", "".join(ALIKE.get(c) or NEARLY.get(c) or c for c in unicodedata.normalize("NFD", t)))


def by_table(token: str) -> str:
    """``token`` letter by letter: nothing ignorable, ordinary kinds, composed, Latin letters in a Latin word."""
    t = _KIND.sub(lambda m: unicodedata.normalize("NFKC", m.group()), _IGNORED.sub("", token))
    if _LATIN.search(t):
        t = "".join(ALIKE.get(c, c) for c in t)
    return _MARKED.sub(lambda m: unicodedata.normalize("NFC", m.group()), t)


def spelled(token: str, root: dict) -> str:
    """The canonical spelling of an unusual token: a word of the trie, or by table. Words of another script stay."""
    plain = by_table(token)
    return (walk(token, root) if _LATIN.search(plain) else None) or plain


def spaced(text: str) -> str:
    """``text`` with ordinary spaces and hyphens."""
    return _HYPHEN.sub("-", _SPACE.sub(" ", text))


def consistent(text: str, spell: Callable[[str], str]) -> str:
    """``text`` in its consistent form, with ``spell`` for its unusual tokens. Superscripts, fractions, quotes, dashes and
    symbols stay."""
    if not _ODD.search(text):
        return text
    return _TOKEN.sub(lambda m: spell(m.group()) if _ODD.search(m.group()) else m.group(), spaced(text))


def odd(c: Column) -> Column:
    return beyond(c, r"\x20-\x7e\n\r")


_TOKENS = "source_table string, key string, token string"


def _unusual(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The distinct unusual tokens of each record, and an empty one where its spaces or hyphens are unusual."""
    for p in batches:
        rows = []
        for s, k, t in zip(p.source_table, p.key, p.text):
            plain = spaced(t)
            rows += [(s, k, w) for w in {w for w in _TOKEN.findall(plain) if _ODD.search(w)} | ({""} if plain != t else set())]
        yield pd.DataFrame(rows, columns=["source_table", "key", "token"])


def unusual(records: DataFrame) -> DataFrame:
    """``source_table, key, token`` of the records with unusual characters; a repeated record gives its tokens once."""
    r = records.filter(odd(F.col("text"))).select("source_table", "key", "text")
    return cut(r.mapInPandas(_unusual, _TOKENS).distinct(), "tokens")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n = pc.value_counts(pc.split_pattern_regex(b.column(0).drop_null(), r"[^\pL\pM\pN\p{Cf}]+").flatten())
        yield pa.RecordBatch.from_arrays([n.field("values"), n.field("counts")], ["word", "n"])


def vocabulary(texts: DataFrame, readings: DataFrame) -> DataFrame:
    """``word, n``: the plainly spelled words of ``text`` among ``readings`` (reading), with their number over all rows."""
    w = texts.select("text").mapInArrow(_counted, "word string, n long")
    w = w.join(readings.select(F.col("reading").alias("word")).distinct(), "word", "left_semi")
    return w.filter(F.col("word").rlike(f"^{_PLAIN_WORD}$")).groupBy("word").agg(F.sum("n").alias("n"))


def spellings(tokens: DataFrame, texts: DataFrame) -> DataFrame:
    """``token, form``: the canonical spelling of each distinct token of ``tokens``, by the words of ``texts``."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            yield p.assign(reading=[reading(t) for t in p.token])

    t = cut(tokens.select("token").distinct().mapInPandas(read, "token string, reading string"), "readings")
    v = vocabulary(texts, t)

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, root = {}, None  # the words of this part come first
        for p in batches:
            own = p[p.token.isna()]
            words |= dict(zip(own.reading, own.n.astype(int)))
            rest = p.token.dropna()
            if len(rest):
                root = trie(words) if root is None else root
                yield pd.DataFrame({"token": rest, "form": [spelled(w, root) for w in rest]})

    both = v.select(F.lit(None).cast("string").alias("token"), F.col("word").alias("reading"), "n").unionByName(t.withColumn("n", F.lit(0).cast("long")))
    dealt = both.repartition(F.col("reading")).sortWithinPartitions(F.col("token").asc_nulls_first())
    return dealt.mapInPandas(spell, "token string, form string")


def changed(records: DataFrame, texts: DataFrame) -> DataFrame:
    """``source_table, key`` of the records whose consistent form differs from the text.

    Null and empty texts are consistent. Long texts are read whole. Repeated records come out once.
    """
    t = unusual(records)
    s = spellings(t.filter("token <> ''"), texts).filter("token <> form")
    return t.join(s.select("token"), "token", "left_semi").select("source_table", "key").unionByName(t.filter("token = ''").select("source_table", "key")).distinct()


def forms(records: DataFrame, texts: DataFrame) -> DataFrame:
    """``source_table, key, form, changed`` of every record of unique ``source_table, key``, with ``text``.

    Plain texts pass without leaving the JVM, nulls stay null.
    """
    plain = F.coalesce(~odd(F.col("text")), F.lit(True))
    same = records.filter(plain).select("source_table", "key", F.col("text").alias("form"), F.lit(False).alias("changed"))
    rest = records.filter(~plain).select("source_table", "key", "text")
    t = unusual(rest)
    s = spellings(t.filter("token <> ''"), texts).filter("token <> form")
    own = t.join(s, "token").groupBy("source_table", "key").agg(F.collect_list(F.struct("token", "form")).alias("own"))  # as many as a text has

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            form = []
            for text, own in zip(p.text, p.own):
                known = {x["token"]: x["form"] for x in own} if own is not None else {}
                form.append(consistent(text, lambda w: known.get(w, w)))
            yield pd.DataFrame({"source_table": p.source_table, "key": p.key, "form": form, "changed": [a != b for a, b in zip(form, p.text)]})

    odd_ = rest.join(own, ["source_table", "key"], "left").select("source_table", "key", "text", "own")
    return same.unionByName(odd_.mapInPandas(run, "source_table string, key string, form string, changed boolean"))


def _other(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "component").select("comp_id", "updated_at", F.col("citation").alias("text"))
    c = latest(c, "comp_id", "updated_at", F.xxhash64("text")).select(F.lit("component").alias("source_table"), F.col("comp_id").alias("key"), "text")
    m = table(spark, sf_dir, "metadata").select("id", "loaded_at", F.col("title").alias("text"))
    m = latest(m, "id", "loaded_at", F.xxhash64("text")).select(F.lit("metadata").alias("source_table"), F.col("id").cast("string").alias("key"), "text")
    return c.unionByName(m)


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of the three fields, whatever version."""
    t = [table(spark, sf_dir, n).select(F.col(c).alias("text")) for n, c in (("text_unit", "accumulated_text"), ("component", "citation"), ("metadata", "title"))]
    return t[0].unionByName(t[1]).unionByName(t[2])


def p6_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consistent form of every value, and whether it differs from what is stored."""
    u = text_units(spark, sf_dir).select(F.lit("text_unit").alias("source_table"), "key", "text")
    f = forms(u.unionByName(_other(spark, sf_dir)), _texts(spark, sf_dir))
    return f.select("source_table", F.col("key").alias("record_key"), "form", "changed")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose text differs from its consistent form, garbled ones left out."""
    # what is neither garbled nor unusual needs no further look: the rest is small and is read twice
    u = cut(text_units(spark, sf_dir, lambda c: odd(c) | (c.contains("?") & c.rlike(r"\?\p{L}"))).filter("text is not null"), "unusual")
    g = garbled_units(u, pools(spark, sf_dir)).select(F.lit("text_unit").alias("source_table"), "key")
    n = changed(u.select(F.lit("text_unit").alias("source_table"), "key", "text").unionByName(_other(spark, sf_dir)), _texts(spark, sf_dir))
    return n.join(g, ["source_table", "key"], "left_anti").select("source_table", F.col("key").alias("record_key"))
