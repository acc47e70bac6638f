"""Domain records: values by shape, their links, and what is rejected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import classify


def normalize_domains(domains: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, rejects) of (record_id, cn, dns array, ip) rows.

    kept is (record_id, field, pos, type, value) of hosts and addresses, dns values once a record; a host in
    the ip field is invalid. rejects counts (field, reason, n). Empty values are in neither.
    """
    cell = lambda field, pos, raw: F.struct(F.lit(field).alias("field"), pos.alias("pos"), raw.alias("raw"))
    dns = F.transform(F.coalesce("dns", F.array().cast("array<string>")), lambda x, i: cell("dns", i.cast("int"), x))
    rows = domains.select("record_id", F.explode(F.concat(F.array(cell("ip", F.lit(0), F.col("ip")), cell("cn", F.lit(0), F.col("cn"))), dns)).alias("x"))
    rows = rows.select("record_id", "x.field", "x.pos", classify(F.col("x.raw")).alias("k")).select("record_id", "field", "pos", "k.kind", "k.value")
    rows = rows.withColumn("kind", F.when((F.col("field") == "ip") & (F.col("kind") == "fqdn"), "x_invalid").otherwise(F.col("kind"))).where("kind <> ''")
    rows = rows.groupBy("record_id", "field", "kind", "value").agg(F.min("pos").alias("pos"))
    kept = rows.where("kind in ('fqdn', 'ip')").select("record_id", "field", "pos", F.col("kind").alias("type"), "value")
    rejects = rows.where("kind not in ('fqdn', 'ip')").groupBy("field", F.col("kind").alias("reason")).agg(F.count("value").alias("n"))
    return kept, rejects


def domain_values(kept: DataFrame) -> DataFrame:
    """(node_type, value) of all values, each once: what an import of domain records needs ids for."""
    return kept.select(F.col("type").alias("node_type"), "value").distinct()


def domain_links(kept: DataFrame) -> DataFrame:
    """(type_1, value_1, type_2, value_2) of each record's cn with its dns values and its ip, without links to itself."""
    cn = kept.where("field = 'cn'").select("record_id", F.col("type").alias("type_1"), F.col("value").alias("value_1"))
    other = kept.where("field <> 'cn'").select("record_id", F.col("type").alias("type_2"), F.col("value").alias("value_2"))
    return cn.join(other, "record_id").where("type_1 <> type_2 or value_1 <> value_2").drop("record_id")
