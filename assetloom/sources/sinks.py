"""Writers: appended batches, replaced results, and exports."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITIONS = {"node": ["node_type"], "link": ["type_1"], "property": ["node_type"], "rank": ["yyyymm"]}
SORTED = {"node": ["value"], "link": ["id_1"], "property": ["id_node"], "rank": ["id_node"]}


def append(df: DataFrame, path: str, table: str, ranged: bool = False) -> None:
    """Add a batch, in partitions by type or month, sorted so that row groups can be skipped; reversed host names go along for suffix searches.

    ranged says that the rows lie in ranges of these columns already, so they aren't moved again.
    """
    if table == "rank":
        df = df.withColumn("yyyymm", F.date_format(F.timestamp_seconds("creation_date"), "yyyyMM"))
    if table == "node":
        df = df.withColumn("rev_value", F.when(F.col("node_type") == "fqdn", F.reverse("value")))
    placed = df if ranged else df.repartitionByRange(*PARTITIONS[table], *SORTED[table])
    placed.sortWithinPartitions(*PARTITIONS[table], *SORTED[table]).write.mode("append").partitionBy(*PARTITIONS[table]).parquet(path)


def replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header, first_seen as a timestamp."""
    if "first_seen" in df.columns:
        df = df.withColumn("first_seen", F.timestamp_seconds("first_seen"))
    df.write.mode("overwrite").option("header", True).csv(path)


def export_sample(df: DataFrame, path: str) -> None:
    """Semicolon CSV of a sample for review."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("sep", ";").csv(path)


def drop_months(spark: SparkSession, path: str, before: str) -> list[str]:
    """Delete the rank partitions (yyyymm) of months before the given one, and say which; no other file is touched.

    A month goes only as a whole, so reads still leave out expired weeks (ranks.purge).
    """
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = top.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [f.getPath() for f in store.listStatus(top) if f.isDirectory()] if store.exists(top) else []
    old = sorted(f.getName().split("=")[1] for f in folders if f.getName().startswith("yyyymm=") and f.getName().split("=")[1] < before)
    for month in old:
        store.delete(spark._jvm.org.apache.hadoop.fs.Path(top, f"yyyymm={month}"), True)
    return old


class BatchFolders:
    """Tables of which each numbered batch has a folder: a batch that is run again replaces what it wrote before.

    schemas gives the columns of each table; reads add the number as the column batch.
    """

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, str]) -> None:
        self._spark, self._root, self._schemas = spark, root, schemas

    def put(self, table: str, rows: DataFrame, number: int) -> None:
        names = self._spark.createDataFrame([], self._schemas[table]).columns
        rows.select(*names).write.mode("overwrite").parquet(posixpath.join(self._root, table, f"batch={number}"))

    def read(self, table: str, before: int | None = None) -> DataFrame:
        """All rows, or those of the batches before one: a condition on folders."""
        schema = f"{self._schemas[table]}, batch bigint"
        top = self._spark._jvm.org.apache.hadoop.fs.Path(posixpath.join(self._root, table))
        if not top.getFileSystem(self._spark._jsc.hadoopConfiguration()).exists(top):
            return self._spark.createDataFrame([], schema)
        rows = self._spark.read.schema(schema).parquet(top.toString())
        return rows if before is None else rows.where(F.col("batch") < before)
