"""References to records that do not exist: a Bloom filter proves most orphans, an exact join settles the rest.

A filter over all keys that ever arrived is built in Spark and goes to every task as a table of at most ``MAX_BITS`` bits,
whatever the number of keys. A reference it rejects is an orphan for
certain and needs no join. The others are joined with the live intervals of their key and kept where none holds the time
of the reference. A filter that is full lets more references through to the join, and changes no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from normspark.session import cut, table

HASHES, BITS_PER_KEY, MAX_BITS = 4, 16, 1 << 25


def spelled_integer(c: Column) -> Column:
    """The integer a value spells, as a string without leading zeros; null where it spells none.

    Spaces around, a sign, leading zeros and a trailing ``.0`` are ways to write it.
    """
    t = F.regexp_extract(c, r"^[\s\x{a0}]*([+-]?\d+)(?:\.0*)?[\s\x{a0}]*$", 1)
    sign = F.when(t.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    digits = F.regexp_replace(F.regexp_replace(t, r"^[+-]", ""), r"^0+(?=\d)", "")
    return F.when(F.coalesce(t, F.lit("")) == "", None).otherwise(F.when(digits == "0", digits).otherwise(F.concat(sign, digits)))


def trimmed(c: Column) -> Column:
    """Without white space around; null where nothing is left."""
    t = F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    return F.when(t == "", None).otherwise(t)


class Bloom:
    """Membership with false positives only: a table of 64-bit words, one of them for each key, ``HASHES`` bits in it.

    The words are made and merged in Spark (``bit_or``) and go to the tasks as a broadcast table of at most
    ``MAX_BITS / 64`` rows; they never pass through the driver's own memory or the plan.
    """

    def __init__(self, keys: DataFrame, key: str = "key", max_bits: int = MAX_BITS) -> None:
        h = keys.select(F.col(key).alias("k")).filter("k is not null").distinct()
        self.words = min(max_bits, 1 << max(12, (h.count() * BITS_PER_KEY - 1).bit_length())) // 64
        self.table = h.select(self._word(F.col("k")).alias("_word"), self._mask(F.col("k")).alias("m")).groupBy("_word").agg(F.bit_or("m").alias("_bits"))

    def _word(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.words).cast("long"))

    def _mask(self, key: Column) -> Column:
        # six bits of a second hash for each position
        h = F.xxhash64(key, F.lit(1))
        one, at = F.lit(1).cast("long"), lambda i: F.call_function("shiftrightunsigned", h, F.lit(6 * i)).bitwiseAND(F.lit(63).cast("long"))
        bits = [F.call_function("shiftleft", one, at(i).cast("int")) for i in range(HASHES)]
        out = bits[0]
        for x in bits[1:]:
            out = out.bitwiseOR(x)
        return out

    def tested(self, df: DataFrame, key: str) -> DataFrame:
        """``df`` with ``_may``: false where ``key`` is certainly not among the keys."""
        d = df.select(F.struct("*").alias("row"), self._word(F.col(key)).alias("_word"), self._mask(F.col(key)).alias("_mask"))
        d = d.join(F.broadcast(self.table), "_word", "left")
        return d.select("row.*", F.coalesce(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False)).alias("_may"))


def live_intervals(events: DataFrame) -> DataFrame:
    """``key, since, until``: when each key is live, from ``key, at, arrived``; until is null while it stays so.

    Only changes of state make rows, so a key that arrives a million times is one interval. Of events at the same moment
    a deletion counts as the later. Events without key or time are none.
    """
    w = Window.partitionBy("key").orderBy("at", F.col("arrived").desc())
    e = events.filter("key is not null and at is not null").distinct()
    e = e.withColumn("was", F.lag("arrived").over(w)).filter(F.coalesce(F.col("was") != F.col("arrived"), F.col("arrived")))
    e = e.withColumn("until", F.lead("at").over(w))
    return e.filter("arrived").select("key", F.col("at").alias("since"), "until")


def orphans(refs: DataFrame, events: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``refs`` (with ``key`` and ``at``) whose key is not live at their time.

    Rows with a null key are no references. A reference without a time is an orphan: nothing can be shown to be live then.
    Repeated references come out as often as they go in; other columns pass through. A hot key is one row (or few) on the
    interval side, so the join can be split on the side of the references.
    """
    r = refs.filter("key is not null").select(F.struct("*").alias("all"), F.col("key").alias("k"), F.col("at").alias("t"))
    t = Bloom(events.filter("arrived"), max_bits=max_bits).tested(r, "k")
    live = (F.col("k") == F.col("key")) & (F.col("t") >= F.col("since")) & (F.col("until").isNull() | (F.col("t") < F.col("until")))
    return t.filter("not _may").unionByName(t.filter("_may").join(live_intervals(events), live, "left_anti")).select("all.*")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "metadata").select(F.concat(F.lit("m:"), F.col("id").cast("string")).alias("key"), F.col("loaded_at").alias("at"), F.lit(True).alias("arrived"))
    c = table(spark, sf_dir, "component").select(F.concat(F.lit("c:"), trimmed(F.col("comp_id"))).alias("key"), F.col("updated_at").alias("at"), F.lit(True).alias("arrived"))
    key = F.when(F.col("table_name") == "metadata", F.concat(F.lit("m:"), spelled_integer(F.col("record_key")))).when(F.col("table_name") == "component", F.concat(F.lit("c:"), trimmed(F.col("record_key"))))
    d = table(spark, sf_dir, "deleted_records").select(key.alias("key"), F.col("deleted_at").alias("at"), F.lit(False).alias("arrived"))
    return m.unionByName(c).unionByName(d)


def _refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "relationships").select("row_id", "doc_id", "other_doc_id", "loaded_at")
    r = r.select("row_id", F.col("loaded_at").alias("at"), F.explode(F.array(*(F.struct(F.lit(f).alias("ref_field"), F.col(f).alias("v")) for f in ("doc_id", "other_doc_id")))).alias("x"))
    r = r.select(F.lit("relationships").alias("ref_table"), F.col("x.ref_field"), "row_id", "at", F.concat(F.lit("m:"), spelled_integer(F.col("x.v"))).alias("key"))
    a = table(spark, sf_dir, "apply_to").select(F.lit("apply_to").alias("ref_table"), F.lit("comp_id").alias("ref_field"), "row_id", F.col("loaded_at").alias("at"), F.concat(F.lit("c:"), trimmed(F.col("comp_id"))).alias("key"))
    return r.unionByName(a)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reference whose target is not live at the row's loaded_at: table, field, row and month."""
    o = orphans(_refs(spark, sf_dir), cut(_events(spark, sf_dir), "events"))
    return o.select("ref_table", "ref_field", "row_id", F.date_format("at", "yyyy-MM").alias("period"))


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan references counted per table, field and month."""
    return p5_found(spark, sf_dir).groupBy("ref_table", "ref_field", "period").agg(F.count("*").alias("orphans"))
