"""Readers of untrusted files: staged tables, domain records, rankings, verdicts and lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import is_integer, reversed_labels
from ..operators.stable import stable

STAGED = {
    "node": "id string, value string, type string, creation_date string, rank string",
    "link": "value_1 string, value_2 string, type_1 string, type_2 string, id_source string, creation_date string, update_date string",
    "property": "id_node string, type string, id_source string, payload string, version string, detection_date string",
    "domain": "cn string, dns array<string>, ip string",
}
_BAD = "_corrupt_record"


def kind_of(name: str) -> str | None:
    """Kind of a file by its name: property, then node, then link or edge, then JSON; None for others."""
    own = name.rsplit("/", 1)[-1].lower()
    for kind, marks in (("property", ("propert",)), ("node", ("node",)), ("link", ("link", "edge"))):
        if any(m in own for m in marks) and ".csv" in own:
            return kind
    return "domain" if own.endswith((".json", ".json.gz")) else None


def route(paths: list[str]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for path in sorted(paths):
        if kind := kind_of(path):
            out.setdefault(kind, []).append(path)
    return out


def read_records(spark: SparkSession, paths: str | list[str], max_lines: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """(records, endless): whole records of CSV files whose cells may hold line breaks, headers left out.

    A line begins a record if an even number of quotes stands before it in its file, quotes behind a backslash not
    counted. Splits of a file are read at once: each says how many quotes and how many beginnings it has, for either
    state at its start; one row a split then tells each split its state, and the record that is open there. Only
    records of several lines are put together by a shuffle. A quote that is never closed would make one record of the rest
    of its file: lines of a record of more than max_lines are endless, one by one. Empty lines between records are skipped.
    """
    scan = spark.read.option("lineSep", "\n").text(paths)
    lines = scan.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    quotes = F.length(F.regexp_replace(F.regexp_replace("line", r"\\.", ""), '[^"]', ""))
    split = Window.partitionBy("file", "split").orderBy("at")
    before = F.coalesce(F.sum("quotes").over(split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    upto = split.rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("quotes", quotes % 2).withColumn("odd", before % 2)
    lines = stable(lines.withColumn("even_begins", F.sum(1 - F.col("odd")).over(upto)).withColumn("odd_begins", F.sum("odd").over(upto)))

    splits = lines.groupBy("file", "split").agg(F.sum("quotes").alias("quotes"), F.max("even_begins").alias("even_begins"), F.max("odd_begins").alias("odd_begins"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("open", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    splits = splits.withColumn("begins", F.when(F.col("open") == 0, F.col("even_begins")).otherwise(F.col("odd_begins")))
    begun = F.when(F.col("begins") > 0, F.struct("split", F.col("begins").alias("record")))
    splits = splits.select("file", "split", "open", F.last(begun, ignorenulls=True).over(earlier).alias("left"))

    own = F.when(F.col("open") == 0, F.col("even_begins")).otherwise(F.col("odd_begins"))
    lines = lines.join(splits, ["file", "split"]).withColumn("own", own)
    lines = lines.withColumn("record", F.when(F.col("own") > 0, F.struct("split", F.col("own").alias("record"))).otherwise(F.col("left")))
    whole = ((F.col("open") + F.col("odd")) % 2 == 0) & (F.col("quotes") == 0)
    lines = lines.where((F.col("record.split") > 0) | (F.col("record.record") > 1))  # without headers
    several = lines.where(~whole)
    sizes = several.groupBy("file", "record").agg(F.count(F.lit(1)).alias("n"))
    long = sizes.where(F.col("n") > max_lines).select("file", "record")
    endless = several.join(long, ["file", "record"], "left_semi").select("line")
    parts = several.join(long, ["file", "record"], "left_anti").groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("split", "at", "line"))).alias("parts"))
    joined = parts.select(F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("record"))
    records = lines.where(whole).select(F.col("line").alias("record")).unionByName(joined).select(F.regexp_replace("record", "\r$", "").alias("record"))
    return records.where("record <> ''"), endless


def read_staged(spark: SparkSession, paths: str | list[str], kind: str, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): rows of staged CSV or JSON-lines files as text; rejected holds the raw lines.

    Files are parsed once into a table in the shared folder, which both results read. With multi_line, cells of
    CSV files may hold line breaks; splits of a file are still read at once (see read_records).
    """
    schema = f"{STAGED[kind]}, {_BAD} string"
    options = {"sep": ";", "quote": '"', "escape": "\\", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    if kind == "domain":
        rows = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD).json(paths)
    elif multi_line:
        records, endless = read_records(spark, paths)
        parsed = records.select(F.from_csv("record", schema, options).alias("cells")).select("cells.*")
        nothing = [F.lit(None).cast("string").alias(c) for c in parsed.columns if c != _BAD]
        rows = parsed.unionByName(endless.select(*nothing, F.col("line").alias(_BAD)))
    else:
        rows = spark.read.schema(schema).options(**options).option("header", True).option("enforceSchema", True).csv(paths)
    rows = stable(rows)
    return rows.where(F.col(_BAD).isNull()).drop(_BAD), rows.where(F.col(_BAD).isNotNull()).select(F.col(_BAD).alias("line"))


def tolerated(good: DataFrame, rejected: DataFrame, max_rows: int = 1000, max_share: float = 0.001) -> int:
    """How many rows were rejected; ValueError if they are more than both limits allow."""
    n, bad = good.count(), rejected.count()
    if bad > max_rows and bad > max_share * (n + bad):
        raise ValueError(f"{bad} of {n + bad} rows are malformed")
    return bad


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """(value, rank) of a ranking with two columns in either order, comma or semicolon, with or without header, gzip or not.

    The first line with a numeric cell says which column is the rank. Other lines are skipped.
    """
    lines = spark.read.text(path).select(F.regexp_replace("value", "^﻿", "").alias("line"))
    cells = F.split("line", "[,;]", 2)
    first, second = F.trim(F.get(cells, F.lit(0)), F.lit(' "')), F.trim(F.get(cells, F.lit(1)), F.lit(' "'))
    rows = lines.select(first.alias("a"), second.alias("b")).where("b is not null")
    probe = rows.where(is_integer(F.col("a")) | is_integer(F.col("b"))).head(1)
    rank, value = ("b", "a") if probe and not probe[0].a.lstrip("-").isdigit() else ("a", "b")
    return rows.select(F.col(value).alias("value"), F.col(rank).try_cast("int").alias("rank")).where("rank is not null and value <> ''")


def read_web_graph_ranks(spark: SparkSession, path: str) -> DataFrame:
    """(value, rank) of a tab-separated web-graph ranking: position first, reversed host name fifth; # lines and short ones are skipped."""
    cells = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).select(cells.alias("c")).where(F.size("c") >= 5)
    cell = lambda i: F.get("c", F.lit(i))
    return rows.select(reversed_labels(cell(4)).alias("value"), cell(0).try_cast("int").alias("rank")).where("rank is not null")


def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    from ..operators.explain import clean_verdicts

    return clean_verdicts(spark.read.option("sep", ";").option("header", True).csv(path))


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """(name): distinct names of a list with one a line and # comments."""
    name = F.trim(F.regexp_replace("value", "#.*$", ""))
    return spark.read.text(path).select(name.alias("name")).where("name <> ''").distinct().orderBy("name")


def read_suffix_list(spark: SparkSession, path: str) -> DataFrame:
    """(suffix): rules of a public-suffix list, up to the first white space of a line; // lines and blank ones are skipped."""
    rule = F.regexp_extract("value", r"^\s*(\S+)", 1)
    return spark.read.text(path).where(~F.trim("value").startswith("//")).select(F.lower(rule).alias("suffix")).where("suffix <> ''").distinct()
