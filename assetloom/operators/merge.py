"""Merge on read: the current row of each key, column by column.

Batches are appended with a growing ingest_seq. Smallest ids and detection dates and largest versions don't
depend on order; ranks and payloads are the last non-null ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .stable import stable

KEYS = {
    "node": ("node_type", "value"),
    "link": ("type_1", "id_1", "type_2", "id_2", "id_source"),
    "property": ("node_type", "id_node", "id_source"),
    "rank": ("node_type", "id_node", "id_source", "creation_date"),
}


def last(column: str, *order: str) -> Column:
    """The last non-null value by ingest_seq; ties go by the order columns and then the value."""
    return F.max_by(F.when(F.col(column).isNotNull(), F.col(column)), F.when(F.col(column).isNotNull(), F.struct("ingest_seq", *order, column)))


def last_int(column: str) -> Column:
    """The last non-null 32-bit integer by ingest_seq, the largest of a tie.

    Both are packed into one number, so that the aggregation needs no sort.
    """
    packed = F.col("ingest_seq").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(18,0)") + (F.col(column).cast("bigint") + (1 << 31)).cast("decimal(18,0)")
    top = F.max(packed)
    return (F.pmod(top, F.lit(1 << 32).cast("decimal(18,0)")).cast("bigint") - (1 << 31)).cast("int")


def current(df: DataFrame, table: str) -> DataFrame:
    """One row a key of node, link, property or rank."""
    merged = {
        "node": [F.min("id").alias("id"), last_int("rank").alias("rank"), F.max("version").alias("version"), F.max("ingest_seq").alias("ingest_seq")],
        "link": [F.min("detection_date").alias("detection_date"), F.max("version").alias("version"), F.max("ingest_seq").alias("ingest_seq")],
        "property": [last("payload", "version").alias("payload"), F.max("version").alias("version"), F.min("detection_date").alias("detection_date"), F.max("ingest_seq").alias("ingest_seq")],
        "rank": [last_int("rank").alias("rank"), F.max("ingest_seq").alias("ingest_seq")],
    }
    return df.groupBy(*KEYS[table]).agg(*merged[table])


def compact(df: DataFrame, table: str, nodes: DataFrame | None = None) -> DataFrame:
    """The current rows to rewrite a table with. Given all node rows, links that cite a discarded id get the value's smallest one."""
    if table != "link" or nodes is None:
        return current(df, table)
    ids = nodes.select("node_type", "value", F.col("id").alias("old")).distinct()
    kept = nodes.groupBy("node_type", "value").agg(F.min("id").alias("new"))
    remap = ids.join(kept, ["node_type", "value"]).where("old <> new").groupBy("node_type", "old").agg(F.min("new").alias("new"))
    for end in ("1", "2"):
        own = remap.select(F.col("node_type").alias(f"type_{end}"), F.col("old").alias(f"id_{end}"), F.col("new").alias("_new"))
        df = df.join(own, [f"type_{end}", f"id_{end}"], "left").withColumn(f"id_{end}", F.coalesce("_new", f"id_{end}")).drop("_new")
    return current(df, table)


#: The column by whose folders a stored table is compacted.
FOLDERS = {"node": "node_type", "link": "type_1", "property": "node_type", "rank": "yyyymm"}


def compact_changed(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    """Rewrite only those folders of a stored table that got rows since they were compacted; (folder, rows_before, rows_after, compacted_to) of these.

    schema is the stored one, with the folder column. Beside the table, `<path>-compacted` says for each folder up to which
    ingest_seq it was compacted; batches that come later have larger ones. A folder's rows are merged into a table of the
    shared folder first and then replace it, so a failure before the mark leaves rows that merge to the same, and the next
    run does that folder again. No batch may be appended to a folder while it is replaced.
    """
    folder, marks_path = FOLDERS[table], path.rstrip("/") + "-compacted"
    top = spark._jvm.org.apache.hadoop.fs.Path(marks_path)
    schema_of_marks = "folder string, compacted_to bigint, run bigint"
    has_marks = top.getFileSystem(spark._jsc.hadoopConfiguration()).exists(top)
    marks = spark.read.schema(schema_of_marks).parquet(marks_path) if has_marks else spark.createDataFrame([], schema_of_marks)
    last = {r.folder: r.m for r in marks.groupBy("folder").agg(F.max("compacted_to").alias("m")).collect()}  # a row a folder
    rows = spark.read.schema(schema).parquet(path).withColumn(folder, F.col(folder).cast("string"))
    seen = rows.groupBy(folder).agg(F.max("ingest_seq").alias("top"), F.count(F.lit(1)).alias("n")).collect()
    changed = sorted((r[folder], r.n, r.top) for r in seen if r.top > last.get(r[folder], -1))
    report = spark.createDataFrame(changed, "folder string, rows_before bigint, compacted_to bigint")
    if not changed:
        return report.select("folder", "rows_before", F.lit(None).cast("bigint").alias("rows_after"), "compacted_to")
    merged = current(rows.where(F.col(folder).isin([c[0] for c in changed])), table)
    extra = [c for c in rows.columns if c not in merged.columns]
    if table == "rank":
        merged = merged.withColumn("yyyymm", F.date_format(F.timestamp_seconds("creation_date"), "yyyyMM"))
    if "rev_value" in extra:
        merged = merged.withColumn("rev_value", F.when(F.col("node_type") == "fqdn", F.reverse("value")))
    merged = stable(merged.select(*rows.columns))
    sort = next(c for c in KEYS[table] if c != folder)
    out = merged.repartitionByRange(folder, sort).sortWithinPartitions(folder, sort)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(folder).parquet(path)
    report.select("folder", "compacted_to", F.lit(len(last)).cast("bigint").alias("run")).coalesce(1).write.mode("append").parquet(marks_path)
    after = merged.groupBy(F.col(folder).alias("folder")).agg(F.count(F.lit(1)).alias("rows_after"))
    return stable(report.join(after, "folder").select("folder", "rows_before", "rows_after", "compacted_to"))
