"""Readers and writers: shards with growing schemas, keyword lists, JSON lines, upserts into keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from normspark.session import drop_path

CONFIGS = ("metadata", "content", "relationships")


def read_shards(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """All part files of a folder as one table; columns that some lack are null there."""
    r = spark.read.option("mergeSchema", "true")
    return (r.option("pathGlobFilter", f"{prefix}*.parquet") if prefix else r).parquet(path)


def ingest(df: DataFrame, path: str, force: bool = False) -> None:
    """Write a table; one that is there already stays unless ``force``."""
    df.write.mode("overwrite" if force else "ignore").parquet(path)


def download(spark: SparkSession, source: str, folder: str, names: tuple[str, ...] = CONFIGS, force: bool = False) -> dict[str, str]:
    """Fetch the shards of each table from ``source`` (a folder of folders, on any file system) into one table each.

    Gives the path of each table. Those that are there already stay unless ``force``.
    """
    out = {n: f"{folder}/{n}.parquet" for n in names}
    for n, path in out.items():
        if force or not exists(spark, path):
            ingest(read_shards(spark, f"{source}/{n}"), path, force)
    return out


def local_table(spark: SparkSession, source: str, folder: str, name: str) -> DataFrame:
    """One raw table, fetched first if it isn't there."""
    return spark.read.parquet(download(spark, source, folder, (name,))[name])


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def load_local(spark: SparkSession, folder: str, names: tuple[str, ...] = CONFIGS) -> dict[str, DataFrame]:
    """The raw tables of a folder; FileNotFoundError names those that are missing."""
    if missing := [n for n in names if not exists(spark, f"{folder}/{n}.parquet")]:
        raise FileNotFoundError(f"no {', '.join(missing)} in {folder}")
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}


def keywords(spark: SparkSession, path: str) -> list[str]:
    """The words of a keyword file: one a line, lower case, blank lines and # comments skipped. ValueError without any."""
    t = spark.read.text(path).select(F.lower(F.regexp_replace("value", r"(?U)^\s+|\s+$", "")).alias("k"))
    words = [r["k"] for r in t.filter("k <> '' and not startswith(k, '#')").collect()]
    if not words:
        raise ValueError(f"no keyword in {path}")
    return words


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True) -> DataFrame:
    """JSON lines of a fixed schema; a missing file is an empty table. Malformed lines fail, or are dropped if not strict."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def write_keyed(df: DataFrame, key: str, path: str) -> None:
    """One JSON document: an object with a member per row of ``df``, named by its key as a string.

    For a chosen few documents: the whole is one line of text, put together in one task.
    """
    e = F.struct(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*(c for c in df.columns if c != key)), {"ignoreNullFields": "false"}).alias("value"))
    member = lambda x: F.concat(F.to_json(F.array(x["key"])).substr(F.lit(2), F.length(F.to_json(F.array(x["key"]))) - 2), F.lit(": "), x["value"])
    doc = df.filter(F.col(key).isNotNull()).agg(F.array_sort(F.collect_list(e)).alias("all"))
    doc.select(F.concat(F.lit("{"), F.array_join(F.transform("all", member), ",\n"), F.lit("}")).alias("value")).write.mode("overwrite").text(path)


def jsonl_counts(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """``kind, rows`` of the JSON lines of a file by one of their members; lines that aren't JSON objects count as malformed."""
    if not exists(spark, path):
        return spark.createDataFrame([], "kind string, rows long")
    line = F.try_parse_json("value")
    ok = F.coalesce(F.schema_of_variant(line).startswith("OBJECT"), F.lit(False))
    t = spark.read.text(path).filter(F.trim("value") != "")
    named = F.coalesce(F.try_variant_get(line, f"$.{kind}", "string"), F.lit("none"))
    return t.groupBy(F.when(ok, named).otherwise("malformed").alias("kind")).agg(F.count("*").alias("rows"))


def write_all(tables: dict[str, DataFrame], folder: str) -> None:
    """Several tables of one run."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def lookup(df: DataFrame, key: str, values: list) -> DataFrame:
    """Rows with one of a few given keys: the filter reaches the file scan."""
    return df.filter(F.col(key).isin(*values))


def prefer(spark: SparkSession, first: str, second: str) -> DataFrame:
    """The first of two tables that is there."""
    return spark.read.parquet(first if exists(spark, first) else second)


def upserted(old: DataFrame | None, new: DataFrame, keys: list[str], at: Column | None = None) -> DataFrame:
    """One row per key: a new one replaces an old one; of several new ones the latest ``at`` stays (any one without it)."""
    n = new.withColumn("_new", F.lit(1))
    both = n if old is None else n.unionByName(old.withColumn("_new", F.lit(0)), allowMissingColumns=True)
    order = [F.col("_new").desc(), *([at.desc_nulls_last()] if at is not None else []), F.xxhash64(*sorted(c for c in new.columns if c not in keys)) if len(new.columns) > len(keys) else F.lit(0)]
    return both.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_r = 1").drop("_r", "_new")


def violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are null or occur more than once: empty where the key is one."""
    k = F.lit(False)
    for c in keys:
        k = k | F.col(c).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(k | (F.col("n") > 1))


def wipe(spark: SparkSession, folder: str) -> None:
    drop_path(spark, folder)
