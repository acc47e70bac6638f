"""Ids of values: those known, and dense new ones after the largest."""

from __future__ import annotations

import json
import threading
import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .stable import stable


def number(values: DataFrame, start: DataFrame) -> DataFrame:
    """(node_type, value, id): ids from start's base + 1 on within each node_type, in order of value.

    start is (node_type, base). The order comes from a range partitioning: each range is numbered by itself and
    shifted by the sizes of the ranges before, so no task sees all values of a type.
    """
    n = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = values.select("node_type", "value").repartitionByRange(n, "node_type", "value").withColumn("_part", F.spark_partition_id())
    dealt = stable(dealt)
    sizes = dealt.groupBy("node_type", "_part").agg(F.count("value").alias("_n"))
    before = Window.partitionBy("node_type").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = Window.partitionBy("node_type", "_part").orderBy("value")
    placed = dealt.withColumn("_row", F.row_number().over(own)).join(shifts, ["node_type", "_part"]).join(start, "node_type", "left")
    return placed.select("node_type", "value", (F.coalesce("base", F.lit(0)) + F.col("_shift") + F.col("_row")).cast("bigint").alias("id"))


def resolve(values: DataFrame, node: DataFrame) -> DataFrame:
    """(node_type, value, id): the smallest id of each value, null if it has none. Only nodes of these values are grouped."""
    wanted = stable(values.select("node_type", "value").where("value is not null and value <> ''").distinct())  # its size is known then
    known = node.select("node_type", "value", "id").join(wanted, ["node_type", "value"], "left_semi").groupBy("node_type", "value").agg(F.min("id").alias("id"))
    return wanted.join(known, ["node_type", "value"], "left")


_one_at_a_time = threading.Lock()


def claim(spark: SparkSession, folder: str, base: dict[str, int], wanted: dict[str, int], tries: int = 100) -> dict[str, int]:
    """Reserve so many ids of each type; the id before the first one of each.

    Claims are numbered files of the folder, each with the last id given out so far of every type. A claim counts once its
    file has been created, which the store lets one writer do; who comes second takes the next number. Ids follow
    the largest of base (those in use) and of the claims. A load that fails after its claim leaves a gap.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    with _one_at_a_time:  # local stores look before they create, so threads of one driver take turns
        store.mkdirs(path(folder))
        for _ in range(tries):
            names = sorted(f.getPath().getName() for f in store.listStatus(path(folder)))
            given = {}
            if names:
                stream = store.open(path(folder, names[-1]))
                text = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
                stream.close()
                if not text.endswith("}"):  # another writer is at it
                    time.sleep(0.1)
                    continue
                given = json.loads(text)
            before = {t: max(base.get(t, 0), given.get(t, 0)) for t in wanted}
            try:
                out = store.create(path(folder, f"{int(names[-1]) + 1 if names else 1:012d}"), False)
            except Py4JJavaError as error:
                if store.exists(path(folder, f"{int(names[-1]) + 1 if names else 1:012d}")):
                    continue
                raise error
            out.write(json.dumps(given | {t: before[t] + n for t, n in wanted.items()}).encode())
            out.close()
            return before
    raise RuntimeError(f"no claim of ids in {folder} after {tries} tries")


def resolve_or_create(values: DataFrame, node: DataFrame, now: int, ingest_seq: int = 0, claims: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(node_map, new_nodes): an id for each distinct (node_type, value), and rows to append for the new ones.

    Without claims there may be one writer at a time. claims names a folder that all writers of the table share: each
    reserves its ids there before it writes, so loads that run at once give out different ones. A value that two of them
    create has two ids then, of which merging keeps the smallest.
    """
    found = stable(resolve(values, node))
    fresh = found.where("id is null")
    base = node.groupBy("node_type").agg(F.max("id").alias("base"))
    if claims is not None:
        wanted = {r.node_type: r["count"] for r in fresh.groupBy("node_type").count().collect()}  # a row a type
        before = claim(node.sparkSession, claims, {r.node_type: r.base for r in base.collect()}, wanted) if wanted else {}
        base = node.sparkSession.createDataFrame(sorted(before.items()), "node_type string, base bigint")
    new = stable(number(fresh, base))
    node_map = found.where("id is not null").unionByName(new)
    rows = new.select("node_type", "value", "id", F.lit(None).cast("int").alias("rank"), F.lit(now).cast("bigint").alias("version"), F.lit(ingest_seq).cast("bigint").alias("ingest_seq"))
    return node_map, rows
