"""A stored index of substrings: posting lists of trigrams, added to by batch and searched by a term's rarest grams.

Below the index's folder:

    postings/batch=B/bucket=K   (gram, id), sorted by gram; a gram's bucket is a hash of it
    counts/batch=B/bucket=K     (gram, n), how many ids of the batch have the gram
    values/batch=B              (id, value), sorted by id

A search reads the counts of the term's grams, then the postings of the few rarest of them, then the values of the ids that
these share; every read has conditions that reach the scan: folders by bucket, row groups by gram or id. A batch
that is sent again replaces itself. A hot gram's postings are dealt over files by id.
"""

from __future__ import annotations

import posixpath

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .search import trigrams

#: A power of two, so that signed and unsigned hashes have the same remainder.
BUCKETS = 16
#: Ids that a search sends as conditions; more are joined.
MAX_KEYS = 2000


def _bucket(gram: Column | str) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def add_batch(values: DataFrame, path: str, batch: int, parts: int | None = None) -> None:
    """Index the values (id, value) as the batch of that number; rows with a null id or value are left out."""
    spark = values.sparkSession
    rows = values.select("id", "value").where("id is not null and value is not null").distinct()
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = lambda table: posixpath.join(path, table, f"batch={batch}")
    rows.repartitionByRange(n, "id").sortWithinPartitions("id").write.mode("overwrite").parquet(at("values"))
    stored = spark.read.schema(rows.schema).parquet(at("values"))
    posted = trigrams(stored).withColumn("bucket", _bucket("gram"))
    posted.repartitionByRange(n, "bucket", "gram", "id").sortWithinPartitions("bucket", "gram", "id").write.mode("overwrite").partitionBy("bucket").parquet(at("postings"))
    counts = spark.read.schema(posted.schema).parquet(at("postings")).groupBy("bucket", "gram").agg(F.count(F.lit(1)).alias("n"))
    counts.repartition("bucket").sortWithinPartitions("bucket", "gram").write.mode("overwrite").partitionBy("bucket").parquet(at("counts"))


def _read(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, batch int" + (", bucket int" if table != "values" else "")).parquet(posixpath.join(path, table))


def rarest(spark: SparkSession, path: str, term: str, k: int = 3) -> list[str] | None:
    """The k rarest trigrams of a term of three characters or more by the counts of all batches; None if one is in no value."""
    grams = sorted({term[i : i + 3] for i in range(len(term) - 2)})
    counts = _of(_read(spark, path, "counts", "gram string, n bigint"), grams)
    found = {r.gram: r.n for r in counts.groupBy("gram").agg(F.sum("n").alias("n")).collect()}  # a row a gram of the term
    return sorted(grams, key=lambda g: (found[g], g))[:k] if len(found) == len(grams) else None


def _of(table: DataFrame, grams: list[str]) -> DataFrame:
    """Rows of some grams: conditions on folders and on row groups."""
    # the hash that Spark's xxhash64 gives, so that no job is needed for it
    buckets = sorted({xxhash.xxh64_intdigest(g.encode(), 42) % BUCKETS for g in grams})
    return table.where(F.col("bucket").isin(buckets) & F.col("gram").isin(grams))


def candidates(spark: SparkSession, path: str, grams: list[str], id_type: str = "bigint") -> DataFrame:
    """(id) posted under all the grams."""
    posted = _of(_read(spark, path, "postings", f"gram string, id {id_type}"), grams).select("gram", "id")
    if len(grams) == 1:
        return posted.select("id").distinct()
    return posted.groupBy("id").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(grams)).select("id")


def search(spark: SparkSession, path: str, term: str, k: int = 3, id_type: str = "bigint") -> DataFrame:
    """(id, value, batch) of the indexed values that hold the term, once for each batch that has them.

    Terms under three characters have no gram: all values are read. Whatever the grams let through is checked again.
    """
    values = _read(spark, path, "values", f"id {id_type}, value string")
    if len(term) < 3:
        return values.where(F.col("value").contains(term))
    grams = rarest(spark, path, term, k)
    if grams is None:
        return values.where("false")
    found = candidates(spark, path, grams, id_type)
    few = [r.id for r in found.limit(MAX_KEYS + 1).collect()]
    rows = values.where(F.col("id").isin(few)) if len(few) <= MAX_KEYS else values.join(found, "id", "left_semi").select("id", "value", "batch")
    return rows.where(F.col("value").contains(term))
