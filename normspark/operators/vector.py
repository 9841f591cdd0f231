"""Exact nearest units by cosine, retrieval with context, and the embedding job with resume."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from normspark.functions import text as X


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null where one is null, of another length, or zero."""
    n = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (n > 0), _dot(a, b) / n)


def top_k(units: DataFrame, query: list[float], k: int, key: str = "unit_id", first: Column | None = None, then: Column | None = None) -> DataFrame:
    """The k units nearest to ``query`` with their ``score``: by score, then key.

    ``first`` filters before the choice of k, ``then`` after it (and may leave fewer than k). NaN scores count as none. Each
    task keeps its own k best; only those are compared.
    """
    q = F.array(*(F.lit(float(x)) for x in query))
    u = units if first is None else units.filter(first)
    s = u.withColumn("score", cosine(F.col("embedding"), q)).filter("score is not null and not isnan(score)")
    t = s.orderBy(F.desc("score"), key).limit(k)
    return t if then is None else t.filter(then)


def retrieve(units: DataFrame, components: DataFrame, norms: DataFrame, embed: Callable[[str], list[float]] | None, question: str, k: int = 5) -> DataFrame | None:
    """``text, score, norm_title, citation`` of the units nearest to a question; None where nothing can embed it."""
    if embed is None:
        return None
    t = top_k(units, embed(question), k, then=F.col("type") != "cache_action").withColumn("comp_id", F.regexp_replace("unit_id", r"__tu(?:__p\d+)?$", ""))
    t = t.join(components.select("comp_id", "norm_id", "citation"), "comp_id").join(norms.select("norm_id", F.col("title").alias("norm_title")), "norm_id")
    return t.select(F.col("accumulated_text").alias("text"), "score", "norm_title", "citation").orderBy(F.desc("score"))


def pending(units: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Units still to embed: content units without a vector and with text, not among those done."""
    u = units.filter(F.col("type") != "cache_action").filter(F.col("embedding").isNull() & (X.strip(F.col("accumulated_text")) != ""))
    return u if done is None else u.join(done.select("unit_id").distinct(), "unit_id", "left_anti")


def unembeddable(units: DataFrame, error: str = "empty text") -> DataFrame:
    """Content units without text, with the error that says so."""
    return units.filter((F.col("type") != "cache_action") & F.col("embedding").isNull() & (F.coalesce(X.strip(F.col("accumulated_text")), F.lit("")) == "")).withColumn("error_log", F.lit(error))


def hashed_embedding(text: str, dim: int = 64) -> list[float]:
    """A deterministic stand-in for a provider: no network, the same text the same vector."""
    import numpy as np
    import xxhash

    v = np.random.default_rng(xxhash.xxh64_intdigest(text)).standard_normal(dim)
    return (v / np.linalg.norm(v)).astype("float32").tolist()


def embedded(units: DataFrame, provider: Callable[[list[str]], list[list[float]]] | None = None, batch: int = 250) -> DataFrame:
    """``unit_id, embedding, error_log``: vectors of ``units`` in requests of at most ``batch`` texts; a failed request says why."""
    call = provider or (lambda texts: [hashed_embedding(t) for t in texts])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            for lo in range(0, len(p), batch):
                q = p.iloc[lo : lo + batch]
                try:
                    yield pd.DataFrame({"unit_id": q.unit_id, "embedding": call(list(q.accumulated_text)), "error_log": None})
                except Exception as e:
                    yield pd.DataFrame({"unit_id": q.unit_id, "embedding": None, "error_log": f"{type(e).__name__}: {e}"[:500]})

    return units.select("unit_id", "accumulated_text").mapInPandas(run, "unit_id string, embedding array<float>, error_log string")


def with_embeddings(units: DataFrame, new: DataFrame) -> DataFrame:
    """Units with new vectors where there are some; vectors of unknown units are ignored, old ones kept otherwise."""
    n = new.select("unit_id", F.col("embedding").alias("_e"), F.col("error_log").alias("_l"))
    u = units.join(n, "unit_id", "left")
    return u.withColumn("embedding", F.coalesce("_e", "embedding")).withColumn("error_log", F.when(F.col("_e").isNotNull(), None).otherwise(F.coalesce("_l", "error_log"))).drop("_e", "_l")


def retried(units: DataFrame, errors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Units to embed again after errors, and ids of errors that belong to no unit."""
    e = errors.select("unit_id").distinct()
    return units.join(e, "unit_id", "left_semi"), e.join(units.select("unit_id"), "unit_id", "left_anti")
