"""Platform statistics from sketches: distinct counters that are stored by batch, merged, and counted exactly only near a bound.

A sketch keeps the smallest hashes of what it saw, 2^size at most. While it saw no more than half as many values it holds all of
them, so its count is exact; beyond, its relative standard error is 2^(-size/2), and six of them on either side are taken as bounds.
An ancestor whose decision is the same at both bounds is settled; the others are counted exactly, from their own rows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import domains
from .domains import Params
from .stable import stable

#: What is counted: the counters of domains.platform_stats that are numbers of distinct values.
DISTINCT = ("nb_tenants", "nb_brand", "nb_brand_plugins", "nb_plugins_other")
SIGMAS = 6


def sketches(anc: DataFrame, generic: DataFrame, params: Params = Params(), size: int = 12) -> DataFrame:
    """(anchor, nb_classified, nb_classified_other and a sketch for each of DISTINCT) of a batch of domains.ancestors' rows.

    Rows of an ancestor are aggregated before they are shuffled, so one that holds a third of all hosts sends a sketch a task.
    A host may be in one batch only, and generic has to be the same for all batches that will be merged. An ancestor without a
    value for a counter has null there.
    """
    rows = domains.usable_brand_plugins(anc, generic)
    other = F.array_except("own", "plugins")
    tenant = F.col("tenant")
    values = {
        "nb_tenants": F.when(~domains.tech(tenant, params), F.array(tenant)),
        "nb_brand": F.when(F.size("usable") > 0, F.array(tenant)),
        "nb_brand_plugins": F.col("usable").cast("array<string>"),
        "nb_plugins_other": other.cast("array<string>"),
    }

    def said(name: str) -> Column:
        return F.transform(F.coalesce(values[name], F.array().cast("array<string>")), lambda v: F.struct(F.lit(name).alias("kind"), F.concat(F.lit("="), v).alias("value")))  # sketches pass over empty texts

    none = F.struct(F.lit("").alias("kind"), F.lit(None).cast("string").alias("value"))
    exploded = rows.select("anchor", (F.size("own") > 0).alias("_own"), (F.size(other) > 0).alias("_other"), F.explode(F.concat(F.array(none), *[said(name) for name in DISTINCT])).alias("v"))
    of = lambda name: F.when(F.col("v.kind") == name, F.col("v.value"))
    row = F.col("v.kind") == ""
    return exploded.groupBy("anchor").agg(
        F.count_if(row & F.col("_own")).alias("nb_classified"),
        F.count_if(row & F.col("_other")).alias("nb_classified_other"),
        *[F.theta_sketch_agg(of(name), size).alias(name) for name in DISTINCT],
    )


def merged(stored: DataFrame, size: int = 12) -> DataFrame:
    """One row an ancestor of rows of sketches, from any number of batches."""
    return stored.groupBy("anchor").agg(F.sum("nb_classified").alias("nb_classified"), F.sum("nb_classified_other").alias("nb_classified_other"), *[F.theta_union_agg(name, size).alias(name) for name in DISTINCT])


def estimates(sketched: DataFrame, size: int = 12) -> DataFrame:
    """sketched with counts for sketches, and low and high, structs of all counters at their bounds."""
    rows = sketched.withColumns({name: F.coalesce(F.theta_sketch_estimate(name), F.lit(0).cast("bigint")) for name in DISTINCT})
    share = SIGMAS / 2 ** (size / 2)

    def bound(name: str, side: int) -> Column:
        count = F.col(name)
        off = F.when(count < 2 ** (size - 1), 0.0).otherwise(share)
        return (count / (1 - side * off) if side > 0 else count / (1 + off)).alias(name)

    exact = [F.col(c).cast("double").alias(c) for c in ("nb_classified", "nb_classified_other")]
    return rows.withColumn("low", F.struct(*exact, *[bound(n, -1) for n in DISTINCT])).withColumn("high", F.struct(*exact, *[bound(n, 1) for n in DISTINCT]))


def _criteria(more: str, less: str, params: Params) -> Column:
    """Whether an ancestor is a platform if what speaks for it counts as in the struct more, and what speaks against as in less."""
    of = lambda side, name: F.col(f"{side}.{name}")
    own = (of(more, "nb_plugins_other") >= params.platform_plugins) & (F.try_divide(of(more, "nb_plugins_other"), of(less, "nb_classified_other")) >= params.platform_diversity)
    brand = (of(more, "nb_brand_plugins") >= params.platform_plugins) & (F.try_divide(of(more, "nb_brand_plugins"), of(less, "nb_brand")) >= params.platform_diversity)
    ratio = F.try_divide(of(more, "nb_brand"), of(less, "nb_tenants")) >= params.platform_ratio
    return F.coalesce(own, F.lit(False)) | F.coalesce(brand & ratio, F.lit(False))


def decisions(sketched: DataFrame, anc: DataFrame, generic: DataFrame, params: Params = Params(), size: int = 12) -> DataFrame:
    """(anchor, is_platform, settled) of merged sketches; rows of anc are read again only for ancestors that bounds leave open."""
    rows = estimates(sketched, size).select("anchor", _criteria("high", "low", params).alias("may"), _criteria("low", "high", params).alias("must"))
    rows = stable(rows)  # a row an ancestor
    settled = rows.where(F.col("may") == F.col("must")).select("anchor", F.col("must").alias("is_platform"), F.lit(True).alias("settled"))
    left = rows.where(F.col("may") != F.col("must")).select("anchor")
    found = domains.platforms(domains.platform_stats(anc.join(left, "anchor", "left_semi"), generic, params), params)
    return settled.unionByName(left.join(found.withColumn("is_platform", F.lit(True)), "anchor", "left").select("anchor", F.coalesce("is_platform", F.lit(False)).alias("is_platform"), F.lit(False).alias("settled")))
