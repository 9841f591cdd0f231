"""Missing or wrong language labels by hierarchical discrimination.

A sentence is first given a language family by one-versus-rest linear support vector machines, then, within a family of
several close languages, a language by one-versus-one machines that vote. Features are hashed character n-grams. The
machines are trained here, on the labelled sample; Vietnamese goes in with and without diacritics. Sentences of a document
in the same language make a passage; passages long enough make a document mixed.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from normspark.session import spread, table

#: The close languages of each family.
FAMILIES = {"sinitic": ("zh",), "slavic": ("ru",), "vietic": ("vi",), "western": ("de", "en", "fr")}
LANGUAGES = tuple(x for f in FAMILIES.values() for x in f)
PAIRS = [(f, a, b) for f, ls in FAMILIES.items() for a, b in combinations(ls, 2)]
# Codes and names of the languages.
NAMES = {
    "vi": "vi vie vietnamese vietnamien vietnamesisch tiếng-việt tieng-viet việt",
    "en": "en eng english anglais englisch tiếng-anh",
    "fr": "fr fra fre french français francais französisch tiếng-pháp",
    "de": "de deu ger german allemand deutsch tiếng-đức",
    "ru": "ru rus russian russe russisch русский tiếng-nga",
    "zh": "zh zho chi cmn chinese chinois chinesisch mandarin 中文 汉语 漢語 tiếng-trung",
}
_CODE = {n.replace("-", " "): lang for lang, names in NAMES.items() for n in names.split()}
#: Letters that a passage needs to count in a mixture, and a text to be a case at all.
PASSAGE, PASSAGE_ZH, TEXT = 100, 60, 40
#: Sentences with fewer letters follow their neighbours.
SHORT = 18
BITS, GRAMS = 16, (1, 2, 3, 4)
#: Rows of the labelled sample used for training, per language: more than it has, and a bound for larger ones.
TRAIN_ROWS = 200
EPOCHS, LAMBDA = 30, 1e-4

_SENTENCE = re.compile(r"(?<=[.!?;。！？；])(?=\s|[一-鿿])|\n+|\s/\s|\s\|\s")
_BLANK = re.compile(r"[\W\d_]+")


def label_of(c: str | None) -> str | None:
    """The language that a label names, whatever the spelling, code, capitals or region; None for none of ours."""
    if not c:
        return None
    t = unicodedata.normalize("NFC", c).strip().lower()
    return _CODE.get(t) or _CODE.get(re.split(r"[-_]", t)[0])


def _letters(s: str) -> str:
    """Lower-case words with single spaces around them: what the n-grams see."""
    return " " + _BLANK.sub(" ", s.lower()).strip() + " "


def _hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts, and the text of each."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    hs, os_ = [], []
    h = np.zeros(len(flat), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        m = len(flat) - n + 1
        if m <= 0:
            break
        h = (h[:m] * np.uint64(0x9E3779B97F4A7C15) + flat[n - 1 :] + np.uint64(n)) * np.uint64(0xC2B2AE3D27D4EB4F)
        if n in GRAMS:
            ok = owner[:m] == owner[n - 1 :]
            hs.append(((h >> np.uint64(64 - BITS)).astype(np.int64))[ok])
            os_.append(owner[:m][ok])
    return (np.concatenate(hs), np.concatenate(os_)) if hs else (np.empty(0, np.int64), np.empty(0, np.int64))


def sums(texts: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text the sum of the weights of its n-grams (one column per machine), and the number of n-grams."""
    out, count = np.zeros((len(texts), weights.shape[1])), np.zeros(len(texts))
    lo = 0
    while lo < len(texts):  # some 200,000 characters at a time
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) < 200_000):
            size += len(texts[hi])
            hi += 1
        h, o = _hashes(texts[lo:hi])
        for k in range(weights.shape[1]):
            out[lo:hi, k] = np.bincount(o, weights[h, k], hi - lo)
        count[lo:hi] = np.bincount(o, minlength=hi - lo)
        lo = hi
    return out, count


def svms(h: np.ndarray, owner: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, lam: float = LAMBDA) -> np.ndarray:
    """Weights (a row per feature, a column per machine) of linear support vector machines without intercept.

    ``h`` lists the features of all texts, ``owner`` the text of each; ``y`` has a row per text and a column per machine:
    1 and -1 for its two sides, 0 for texts that are no concern of it. Dual coordinate descent on the squared hinge, one
    text at a time for all machines at once; texts stay sparse.
    """
    n, width = y.shape
    code, uses = np.unique(owner.astype(np.int64) << BITS | h, return_counts=True)
    text, feature = code >> BITS, code & ((1 << BITS) - 1)
    ends = np.searchsorted(text, np.arange(n + 1))
    value = uses / np.sqrt(np.maximum(np.bincount(text, uses, n), 1))[text]
    rows = [(feature[a:b], value[a:b]) for a, b in zip(ends, ends[1:])]
    soft = lam * np.maximum((y != 0).sum(axis=0), 1) / 2  # 1 / 2c
    rng = np.random.default_rng(7)
    w, alpha = np.zeros((1 << BITS, width)), np.zeros((n, width))
    square = np.array([v @ v for _, v in rows])
    for _ in range(epochs):
        for i in rng.permutation(n):
            at, v = rows[i]
            new = np.maximum(0, alpha[i] - (y[i] * (v @ w[at]) - 1 + alpha[i] * soft) / (square[i] + soft))
            step = (new - alpha[i]) * y[i]
            if step.any():
                w[at] += v[:, None] * step
                alpha[i] = np.where(y[i] != 0, new, 0)
    return w


@dataclass
class Model:
    #: One column per family, then one per pair of close languages.
    weights: np.ndarray
    #: Scale of the margins for confidences.
    scale: float

    def classify(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and confidence of each text (as made by ``_letters``)."""
        s, n = sums(texts, self.weights)
        s = s / np.sqrt(np.maximum(n, 1))[:, None]
        fam = list(FAMILIES)
        top = np.argsort(-s[:, : len(fam)], axis=1)
        out, conf = [], np.empty(len(texts))
        for i in range(len(texts)):
            f = fam[top[i, 0]]
            margin = s[i, top[i, 0]] - s[i, top[i, 1]]
            votes = {lang: 0.0 for lang in FAMILIES[f]}
            for k, (pf, a, b) in enumerate(PAIRS):
                if pf == f:
                    m = s[i, len(fam) + k]
                    votes[a if m > 0 else b] += 1 + 1e-6 * abs(m)
            best = max(votes, key=lambda v: (votes[v], v))
            for k, (pf, a, b) in enumerate(PAIRS):
                if pf == f and best in (a, b):
                    margin = min(margin, abs(s[i, len(fam) + k]))
            out.append(best)
            conf[i] = 1 / (1 + np.exp(-self.scale * margin))
        return out, conf


def plain(s: str) -> str:
    """Vietnamese as typed without diacritics."""
    return "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c)).replace("đ", "d").replace("Đ", "D")


def train(rows: list[tuple[str, str]]) -> Model:
    """The machines from ``(lang, text)`` of clean texts."""
    data: list[tuple[str, str]] = []
    for lang, text in rows:
        if lang not in LANGUAGES or not text:
            continue
        for t in [text, *_SENTENCE.split(text)]:
            for v in {t, plain(t)} if lang == "vi" else {t}:
                if len(x := _letters(v)) > SHORT // 2:
                    data.append((lang, x))
    texts = [t for _, t in data]
    langs = np.array([a for a, _ in data])
    sides = [np.where(np.isin(langs, ls), 1, -1) for ls in FAMILIES.values()]
    sides += [(langs == a).astype(int) - (langs == b) for _, a, b in PAIRS]
    weights = svms(*_hashes(texts), np.array(sides, float).T)
    model = Model(weights, 1.0)
    s, n = sums(texts, weights)
    own = np.array([[langs[i] in ls for ls in FAMILIES.values()] for i in range(len(langs))])
    fam = s[:, : len(FAMILIES)] / np.sqrt(np.maximum(n, 1))[:, None]
    margin = np.where(own, fam, -np.inf).max(axis=1) - np.where(own, -np.inf, fam).max(axis=1)
    model.scale = float(4 / max(1e-9, np.median(margin)))  # the median training margin counts as 98 % sure
    return model


def fitted(spark: SparkSession, sf_dir: str, keep=None) -> Model:
    """The machines trained on lang_sample: the first TRAIN_ROWS rows of each of our languages go to the driver."""
    s = table(spark, sf_dir, "lang_sample").filter("text is not null").filter(F.col("lang").isin(*LANGUAGES)).select("lang", "sample_no", "text")
    first = Window.partitionBy("lang").orderBy("sample_no", "text")
    rows = s.withColumn("row", F.row_number().over(first)).filter(F.col("row") <= TRAIN_ROWS).orderBy("lang", "row").collect()
    return train([(r["lang"], r["text"]) for r in rows if keep is None or keep(r["sample_no"])])


def passages(text: str, model: Model) -> list[tuple[int, int, str, float, int]]:
    """Start, end, language, confidence and letters of the passages of a text: runs of sentences in one language."""
    return _passages([text], model)[0]


def _passages(texts: list[str], model: Model) -> list[list[tuple[int, int, str, float, int]]]:
    spans: list[list[tuple[int, int]]] = []
    sents: list[str] = []
    for t in texts:
        at, own = 0, []
        for m in _SENTENCE.finditer(t):
            if m.start() > at:
                own.append((at, m.start()))
            at = m.end()
        if at < len(t):
            own.append((at, len(t)))
        spans.append(own)
        sents += [_letters(t[a:b]) for a, b in own]
    langs, conf = model.classify(sents) if sents else ([], np.empty(0))
    out, k = [], 0
    for own in spans:
        n = [len(x) - x.count(" ") for x in sents[k : k + len(own)]]
        lang: list[str | None] = [langs[k + i] if n[i] >= SHORT or (langs[k + i] == "zh" and n[i] >= 6) else None for i in range(len(own))]
        if own and all(x is None for x in lang):  # nothing but short sentences: they decide together
            one, c = model.classify([" ".join(sents[k : k + len(own)])])
            lang, cs = [one[0]] * len(own), [float(c[0])] * len(own)
        else:
            cs = [float(x) for x in conf[k : k + len(own)]]
        for i in range(1, len(own)):
            lang[i] = lang[i] or lang[i - 1]
        for i in range(len(own) - 2, -1, -1):
            lang[i] = lang[i] or lang[i + 1]
        # a sentence unlike both its neighbours, of less than half a passage and doubtful, is one of theirs
        for i in range(1, len(own) - 1):
            if lang[i] != lang[i - 1] == lang[i + 1] and n[i] < PASSAGE // 2 and cs[i] < 0.9 and lang[i] not in ("zh", "ru"):
                lang[i] = lang[i - 1]
        got: list[list] = []
        for i, (a, b) in enumerate(own):
            if got and got[-1][2] == lang[i]:
                g = got[-1]
                g[3] = (g[3] * g[4] + cs[i] * n[i]) / max(1, g[4] + n[i])
                g[1], g[4] = b, g[4] + n[i]
            else:
                got.append([a, b, lang[i], cs[i], n[i]])
        out.append([tuple(g) for g in got])
        k += len(own)
    return out


def judged(parts: list[tuple[int, int, str, float, int]]) -> tuple[list[str], float] | None:
    """The languages of a text (one, or those of its mixture) and the confidence; None below TEXT letters."""
    total = sum(p[4] for p in parts)
    if total < TEXT:
        return None
    mixed = sorted({p[2] for p in parts if p[4] >= (PASSAGE_ZH if p[2] == "zh" else PASSAGE)})
    if len(mixed) < 2:
        by: dict[str, int] = {}
        for p in parts:
            by[p[2]] = by.get(p[2], 0) + p[4]
        mixed = [max(by, key=lambda x: (by[x], x))]
    w = [(p[3], p[4]) for p in parts if p[2] in mixed]
    return mixed, sum(c * n for c, n in w) / max(1, sum(n for _, n in w))


def _each(docs: DataFrame, model: Model, rows, schema: str) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed: 2 ** BITS rows of weights

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            for lo in range(0, len(p), 500):
                q = p.iloc[lo : lo + 500]
                got = _passages([t if t else "" for t in q.text], held.value)
                out = [r for d, lab, parts in zip(q.doc_id, q.lang, got) for r in rows(d, lab, parts)]
                yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    return spread(docs.select("doc_id", "text", "lang")).mapInPandas(run, schema)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of one language with a missing or wrong label, and every language of mixed documents."""
    def rows(doc, lab, parts):
        j = judged(parts)
        if j and (len(j[0]) > 1 or label_of(lab) != j[0][0]):
            yield from ((doc, x) for x in j[0])

    return _each(table(spark, sf_dir, "documents"), fitted(spark, sf_dir), rows, "doc_id long, lang string")


def p10_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its languages (comma-separated), confidence and what its label names; null below 40 letters."""
    def rows(doc, lab, parts):
        j = judged(parts)
        yield doc, ",".join(j[0]) if j else None, float(j[1]) if j else None, label_of(lab)

    return _each(table(spark, sf_dir, "documents"), fitted(spark, sf_dir), rows, "doc_id long, languages string, confidence double, label string")


def p10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages of mixed documents: start and end in characters, language, confidence, letters."""
    def rows(doc, lab, parts):
        j = judged(parts)
        if j and len(j[0]) > 1:
            yield from ((doc, i, a, b, lang, float(c), n) for i, (a, b, lang, c, n) in enumerate(parts))

    return _each(table(spark, sf_dir, "documents"), fitted(spark, sf_dir), rows, "doc_id long, passage long, start long, end long, lang string, confidence double, letters long")
