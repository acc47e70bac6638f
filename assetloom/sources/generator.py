"""Synthetic graphs of any size, from row numbers and a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = ("alpha", "bravo", "cloud", "delta", "echo", "forum", "games", "hotel", "india", "jazz", "kiosk", "lemon", "media", "news", "ocean", "paper", "query", "radio", "store", "tango")
ZONES = ("com", "net", "org", "io", "fr", "de")
BLOCK = 10_000


def _pick(words: tuple[str, ...], seed: int, salt: int) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (F.pmod(F.xxhash64("id", F.lit(seed), F.lit(salt)), F.lit(len(words))) + 1).cast("int"))


def generate(spark: SparkSession, hosts: int, addresses: int, links: int, terms: tuple[str, ...] = ("youtube", "google"), hot_share: float = 0.02, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(node, link): host names, of which a share holds hot terms in blocks of neighbouring ids, IPv4 addresses, and links in both directions."""
    ids = spark.range(1, hosts + 1)
    block = (F.col("id") / BLOCK).cast("bigint")
    every = max(1, round(1 / hot_share))
    hot = F.pmod(block, F.lit(every)) == 0 if hosts >= BLOCK * every else F.pmod("id", F.lit(every)) == 0
    term = F.element_at(F.array(*[F.lit(t) for t in terms]), (F.pmod(block, F.lit(len(terms))) + 1).cast("int"))
    name = F.concat(F.when(hot, term).otherwise(_pick(WORDS, seed, 1)), F.lit("-"), F.col("id").cast("string"), F.lit("."), _pick(WORDS, seed, 2), F.lit("."), _pick(ZONES, seed, 3))
    null = F.lit(None).cast("int")
    zero = F.lit(0).cast("bigint")
    fqdn = ids.select(F.lit("fqdn").alias("node_type"), name.alias("value"), "id", null.alias("rank"), zero.alias("version"), zero.alias("ingest_seq"))
    octet = lambda k: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(10 + k)), F.lit(254)) + 1
    ip = spark.range(1, addresses + 1).select(F.lit("ip").alias("node_type"), F.concat_ws(".", *[octet(k).cast("string") for k in range(4)]).alias("value"), "id", null.alias("rank"), zero.alias("version"), zero.alias("ingest_seq"))
    ends = spark.range(links).select((F.pmod(F.xxhash64("id", F.lit(seed), F.lit(20)), F.lit(hosts)) + 1).alias("a"), (F.pmod(F.xxhash64("id", F.lit(seed), F.lit(21)), F.lit(addresses)) + 1).alias("b"))
    one = ends.select(F.lit("fqdn").alias("type_1"), F.col("a").alias("id_1"), F.lit("ip").alias("type_2"), F.col("b").alias("id_2"))
    both = one.unionAll(ends.select(F.lit("ip"), "b", F.lit("fqdn"), "a"))
    return fqdn.unionAll(ip), both.select("*", F.lit(0).alias("id_source"), F.lit(0).alias("detection_date"), zero.alias("version"), zero.alias("ingest_seq"))
