"""Encoding of a whole corpus with a public byte-level tokenizer, through a table of its distinct words.

Texts are split into words by the tokenizer's own pattern inside Spark; each distinct word is encoded once; ids join
back by word and are put in order by position. The ``HOT`` most frequent words go to every task, so their occurrences are
joined where they stand; only the other words of a text travel, each once a text, to the table and back. Decoding goes
through a join with the table of pieces.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from normspark.session import cut, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Words that go to every task, and their letters at most: some 50 MB in a task, whatever the corpus.
HOT, HOT_LETTERS = 1 << 18, 40
# The code points of white space in Unicode, and the splitting pattern that belongs to the vocabulary.
SPACE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def java_pattern() -> str:
    """The pattern with white space spelled out: Java's own \\s is narrower."""
    return PATTERN.replace(r"[^\s\p", rf"[^{SPACE}\p").replace(r"(?!\S)", rf"(?![^{SPACE}])").replace(r"\s+", rf"[{SPACE}]+")


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def words(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, words``: the words of each text in order, written out as they are read twice; none for null and empty."""
    pieces = F.regexp_extract_all(F.col(text), F.lit(java_pattern()), F.lit(0))
    return cut(docs.select("doc_id", F.coalesce(pieces, F.array().cast("array<string>")).alias("words")), "split")


def dictionary(w: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``word, ids, n, uses``: each distinct word encoded once. Written out, so that the planner knows its size."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoding(vocabulary)
        for p in batches:
            ids = [enc.encode_ordinary(x) for x in p.word]
            yield pd.DataFrame({"word": p.word, "ids": ids, "n": [len(x) for x in ids], "uses": p.uses})

    counted = w.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("uses"))
    return cut(counted.mapInPandas(encode, "word string, ids array<int>, n long, uses long"), "words")


class Pieces:
    """The ids of some words, one word after the other in one array."""

    def __init__(self, words: list[str], ids: list) -> None:
        self.at = {x: i for i, x in enumerate(words)}
        self.n = np.fromiter(map(len, ids), np.int64, len(ids))
        self.start = np.cumsum(self.n) - self.n
        self.flat = np.fromiter((y for x in ids for y in x), np.int32, int(self.n.sum()))


def hot_words(d: DataFrame, most: int = HOT) -> Broadcast:
    """The most used words of a dictionary, ready for the tasks: ``most`` words of up to HOT_LETTERS letters."""
    top = d.filter(F.length("word") <= HOT_LETTERS).orderBy(F.desc("uses"), "word").limit(most).select("word", "ids").toArrow()
    return d.sparkSession.sparkContext.broadcast(Pieces(top["word"].to_pylist(), top["ids"].to_pylist()))


def _gathered(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of each run of n."""
    return np.arange(int(n.sum())) + np.repeat(start - (np.cumsum(n) - n), n)


def _looked_up(batch: pa.RecordBatch, hot: Pieces) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Of a batch of texts: where each text's words end, its distinct words, which one each word is, and their numbers in
    ``hot`` (-1 for others)."""
    column = batch.column("words")
    words = column.flatten().dictionary_encode()
    at = np.fromiter((hot.at.get(x, -1) for x in words.dictionary.to_pylist()), np.int64, len(words.dictionary))
    return np.cumsum(column.value_lengths().to_numpy()), words.dictionary, words.indices.to_numpy().astype(np.int64), at


def _lists(values: np.ndarray, n: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)], pa.int32()), pa.array(values, kind))


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, hot: int = HOT) -> DataFrame:
    """``doc_id, ids``: the token ids of each text, an empty list for null and empty texts.

    doc_id has to be unique. Text that spells a special token is ordinary text. Long texts are encoded whole. A word that
    is not among the hot ones leaves a gap in its text; the text's distinct other words join the dictionary, and come back
    to fill the gaps.
    """
    w = words(docs)
    d = dictionary(w, vocabulary)
    held = hot_words(d, hot)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = held.value
            ends, distinct, which, at = _looked_up(batch, h)
            one = at[which]
            n = np.where(one < 0, 1, h.n[one]) if len(h.n) else np.ones(len(one), np.int64)
            known = one >= 0
            ids = np.full(int(n.sum()), -1, np.int32)
            place = _gathered((np.cumsum(n) - n)[known], n[known])
            ids[place] = h.flat[_gathered(h.start[one[known]], n[known])]
            size = np.diff(np.r_[0, np.r_[0, np.cumsum(n)][ends]])
            text = np.searchsorted(ends, np.flatnonzero(~known), "right")
            others = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(text, minlength=len(ends)))], pa.int32()), distinct.take(pa.array(which[~known])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(ids, size, pa.int32()), others], ["doc_id", "ids", "others"])

    doc = dict(w.dtypes)["doc_id"]
    got = w.mapInArrow(first, f"doc_id {doc}, ids array<int>, others array<string>")
    if d.count() <= hot and not d.filter(F.length("word") > HOT_LETTERS).limit(1).count():
        return got.select("doc_id", "ids")
    got = cut(got, "encoded")
    rest = got.filter(F.size("others") > 0)
    need = rest.select("doc_id", F.explode(F.array_distinct("others")).alias("word"))
    back = need.join(d.select("word", F.col("ids").alias("piece")), "word").groupBy("doc_id").agg(F.collect_list(F.struct("word", "piece")).alias("back"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ids, others, came in zip(batch.column("ids"), batch.column("others").to_pylist(), batch.column("back").to_pylist()):
                ids = ids.values.to_numpy()
                own = {x["word"]: np.array(x["piece"], np.int32) for x in came}
                parts = np.split(ids, np.flatnonzero(ids < 0))
                out.append(np.concatenate([parts[0], *(y for x, p in zip(others, parts[1:]) for y in (own[x], p[1:]))]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(np.concatenate(out) if out else np.empty(0, np.int32), np.array([len(x) for x in out], np.int64), pa.int32())], ["doc_id", "ids"])

    filled = rest.join(back, "doc_id").mapInArrow(fill, f"doc_id {doc}, ids array<int>")
    return got.filter(F.size("others") == 0).select("doc_id", "ids").unionByName(filled)


def sizes(docs: DataFrame, vocabulary: str = VOCABULARY, hot: int = HOT) -> DataFrame:
    """``doc_id, tokens``: the number of ids of each text, 0 for null and empty ones."""
    w = words(docs)
    d = dictionary(w, vocabulary)
    held = hot_words(d, hot)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = held.value
            ends, distinct, which, at = _looked_up(batch, h)
            one = at[which]
            n = np.where(one < 0, 0, h.n[one]) if len(h.n) else np.zeros(len(one), np.int64)
            tokens = np.diff(np.r_[0, np.r_[0, np.cumsum(n)][ends]])
            gaps = np.flatnonzero(one < 0)
            text = np.searchsorted(ends, gaps, "right")
            others = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(text, minlength=len(ends)))], pa.int32()), distinct.take(pa.array(which[gaps])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(tokens), others], ["doc_id", "tokens", "others"])

    got = cut(w.mapInArrow(count, f"doc_id {dict(w.dtypes)['doc_id']}, tokens long, others array<string>"), "sizes")
    need = got.filter(F.size("others") > 0).select("doc_id", F.explode("others").alias("word")).groupBy("doc_id", "word").count()
    rest = need.join(d.select("word", "n"), "word").select("doc_id", (F.col("n") * F.col("count")).alias("tokens"))
    return got.select("doc_id", "tokens").unionByName(rest).groupBy("doc_id").agg(F.sum("tokens").alias("tokens"))


def pieces(spark: SparkSession, vocabulary: str = VOCABULARY) -> DataFrame:
    """``id, piece`` (hex of the bytes): one row per id, read from the vocabulary (its size is fixed)."""
    with open(vocabulary, "rb") as f:
        rows = [(int(b), base64.b64decode(a).hex()) for a, b in map(bytes.split, f)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["id", "piece"]), "id int, piece string")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, text`` of ``doc_id, ids``: pieces join by id and are put together by position."""
    e = encoded.select("doc_id", F.posexplode_outer("ids").alias("pos", "id"))
    e = e.join(F.broadcast(pieces(encoded.sparkSession, vocabulary)), "id", "left")  # bounded by the vocabulary
    placed = F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "piece"))))
    return e.groupBy("doc_id").agg(F.decode(F.unhex(F.array_join(F.transform(placed, lambda x: x["piece"]), "")), "UTF-8").alias("text"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and ids of each document by byte_bpe_50k, without special tokens."""
    return encode(table(spark, sf_dir, "documents").select("doc_id", "text"))


def p8_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts after encoding and decoding: the same texts, null as empty."""
    return decode(p8_ids(spark, sf_dir))
