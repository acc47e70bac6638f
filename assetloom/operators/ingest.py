"""From staged text rows to typed rows: nodes, properties, links, and incremental batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import int32, or_zero, seconds, uuid
from ..schema import LINK, NODE, PROPERTY, conform, known_type
from .ids import resolve_or_create
from .stable import stable


def distribute_nodes(staged: DataFrame, now: int, ingest_seq: int = 0) -> DataFrame:
    """Typed node rows of known types with a value; an unreadable id or rank is 0 or null, an absent date is now."""
    rank = or_zero(F.col("rank"), "int")
    return conform(
        staged.select(
            F.lower("type").alias("node_type"), "value", or_zero(F.col("id")).alias("id"), F.when(rank != 0, rank).alias("rank"),
            F.coalesce(seconds(F.col("creation_date")), F.lit(now)).alias("version"), F.lit(ingest_seq).alias("ingest_seq"),
        ).where(known_type("node_type") & (F.col("value") != "")),
        NODE,
    )


def unknown_types(staged: DataFrame, *columns: str) -> DataFrame:
    """(type, n) of types that are ignored."""
    types = staged.select(F.explode(F.array(*[F.lower(c) for c in columns])).alias("type"))
    return types.where(~known_type("type")).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def distribute_properties(staged: DataFrame, now: int, ingest_seq: int = 0) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): typed property rows, and counts (reason, n) of rows without numeric id or of unknown type."""
    typed = staged.select(
        F.lower("type").alias("node_type"), or_zero(F.col("id_node")).alias("id_node"), or_zero(F.col("id_source"), "int").alias("id_source"), "payload",
        F.coalesce(seconds(F.col("version")), F.lit(now)).alias("version"), F.coalesce(seconds(F.col("detection_date")), seconds(F.col("version")), F.lit(now)).alias("detection_date"),
        F.lit(ingest_seq).alias("ingest_seq"),
    )
    reason = F.when(~known_type("node_type"), "unknown_type").when(F.col("id_node") == 0, "bad_id")
    judged = typed.withColumn("detection_date", int32(F.col("detection_date"))).withColumn("reason", reason)
    return conform(judged.where("reason is null"), PROPERTY), judged.where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


_REVERSE = {"type_1": "type_2", "id_1": "id_2", "type_2": "type_1", "id_2": "id_1"}


def reverse(links: DataFrame) -> DataFrame:
    """Each link the other way round, in the same columns."""
    return links.select(*[F.col(_REVERSE.get(c, c)).alias(c) for c in links.columns])


def both_ways(links: DataFrame) -> DataFrame:
    """Each link and its reverse, from one pass over the links."""
    ways = [F.struct(*[F.col(c) for c in links.columns]), F.struct(*[F.col(_REVERSE.get(c, c)).alias(c) for c in links.columns])]
    return links.select(F.explode(F.array(*ways)).alias("_way")).select("_way.*")


def resolve_links(staged: DataFrame, node_map: DataFrame, now: int, ingest_seq: int = 0) -> tuple[DataFrame, DataFrame]:
    """(link_rows, report): staged links by value as links by id in both directions, and counts staged, resolved, unresolved, self_links.

    Both ends' values must be in node_map; a link to itself, by value or by id, is dropped.
    """
    date = lambda c: seconds(F.col(c)) if c in staged.columns else F.lit(None).cast("bigint")
    rows = staged.select(
        F.lower("type_1").alias("type_1"), "value_1", F.lower("type_2").alias("type_2"), "value_2", or_zero(F.col("id_source"), "int").alias("id_source"),
        F.coalesce(date("creation_date"), date("update_date"), F.lit(now)).alias("detection_date"), F.coalesce(date("update_date"), F.lit(now)).alias("version"),
    )
    return _resolved(rows, node_map, ingest_seq)


def _resolved(rows: DataFrame, node_map: DataFrame, ingest_seq: int) -> tuple[DataFrame, DataFrame]:
    """As resolve_links, of rows whose types, sources and dates are read already."""
    first = node_map.select(F.col("node_type").alias("type_1"), F.col("value").alias("value_1"), F.col("id").alias("id_1"))
    second = node_map.select(F.col("node_type").alias("type_2"), F.col("value").alias("value_2"), F.col("id").alias("id_2"))
    found = rows.join(first, ["type_1", "value_1"], "left").join(second, ["type_2", "value_2"], "left")
    own = (F.col("type_1") == F.col("type_2")) & ((F.col("value_1") == F.col("value_2")) | (F.col("id_1") == F.col("id_2")))
    both = F.col("id_1").isNotNull() & F.col("id_2").isNotNull()
    own = F.coalesce(own, F.lit(False))
    links = found.where(both & ~own).withColumn("ingest_seq", F.lit(ingest_seq)).withColumn("detection_date", int32(F.col("detection_date")))
    report = found.agg(F.count(F.lit(1)).alias("staged"), F.count_if(both & ~own).alias("resolved"), F.count_if(~both & ~own).alias("unresolved"), F.count_if(own).alias("self_links"))
    return conform(both_ways(links.select("type_1", "id_1", "type_2", "id_2", "id_source", "detection_date", "version", "ingest_seq")), LINK), report


def sources(df: DataFrame, source: DataFrame) -> DataFrame:
    """df with id_source, the smallest of its source_uuid; null if the uuid is absent or unknown.

    Few sources have most rows, so the sources are stored first: their size is known then, and rows needn't meet by source.
    """
    known = stable(source.select(uuid(F.col("uuid")).alias("_uuid"), "id_source").groupBy("_uuid").agg(F.min("id_source").alias("id_source")))
    return df.withColumn("_uuid", uuid(F.col("source_uuid"))).join(known, "_uuid", "left").drop("_uuid")


def payload_text(properties: DataFrame) -> DataFrame:
    """properties with its payload as text: objects, maps and lists are written as JSON, null stays null."""
    kind = properties.schema["payload"].dataType.typeName()
    if kind in ("struct", "map", "array", "variant"):
        return properties.withColumn("payload", F.to_json("payload"))
    return properties.withColumn("payload", F.col("payload").cast("string"))


def _unread(text: Column, read: Column) -> Column:
    """Whether a date text says something that can't be read."""
    return F.coalesce((F.trim(text) != "") & read.isNull(), F.lit(False))


def _read(rows: DataFrame, *dates: str) -> DataFrame:
    """rows with their date texts as Unix seconds and unread, whether any of them can't be read; written once, so that no later step reads dates again."""
    rows = rows.select("*", *[seconds(F.col(d)).alias(f"_{d}") for d in dates])
    rows = rows.withColumn("unread", F.array_contains(F.array(*[_unread(F.col(d), F.col(f"_{d}")) for d in dates]), True))
    return stable(rows.drop(*dates).withColumnsRenamed({f"_{d}": d for d in dates}))


def upsert_batch(links: DataFrame, properties: DataFrame, source: DataFrame, node: DataFrame, now: int, ingest_seq: int = 0) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(link_rows, property_rows, new_nodes, rejects) of a batch of records by value.

    links: value_1, value_2, type_1, type_2, source_uuid, detection_date, update_date. properties: value, type,
    source_uuid, payload, version, detection_date, pos (place in the batch). Rows of unknown sources or types,
    empty values, null payloads and links to themselves are counted in rejects (kind, reason, n); so are, as
    unread_date, rows that stay although a date of theirs can't be read and counts as absent. Properties
    of one node and source become one: last payload, largest version, smallest detection. A payload is text, or
    an object that is written as JSON.
    """
    properties = payload_text(properties)
    joined = sources(links, source)
    same = (F.lower("type_1") == F.lower("type_2")) & (F.trim("value_1") == F.trim("value_2"))
    blank = (F.coalesce(F.trim("value_1"), F.lit("")) == "") | (F.coalesce(F.trim("value_2"), F.lit("")) == "")
    reason = F.when(F.col("id_source").isNull(), "unknown_source").when(~(known_type(F.lower("type_1")) & known_type(F.lower("type_2"))), "unknown_type").when(blank, "empty_value").when(same, "self_link")
    link_rows = _read(joined.withColumn("reason", reason), "detection_date", "update_date")
    joined = sources(properties, source)
    reason = F.when(F.col("id_source").isNull(), "unknown_source").when(~known_type(F.lower("type")), "unknown_type").when(F.coalesce(F.trim("value"), F.lit("")) == "", "empty_value").when(F.col("payload").isNull(), "no_payload")
    property_rows = _read(joined.withColumn("reason", reason), "version", "detection_date")
    said = lambda rows, kind: rows.select(F.lit(kind).alias("kind"), F.coalesce("reason", F.when(F.col("unread"), "unread_date")).alias("reason"))
    rejects = said(link_rows, "link").unionByName(said(property_rows, "property"))
    rejects = rejects.where("reason is not null").groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n"))
    good = link_rows.where("reason is null").select(F.lower("type_1").alias("type_1"), F.trim("value_1").alias("value_1"), F.lower("type_2").alias("type_2"), F.trim("value_2").alias("value_2"), "id_source", F.coalesce("detection_date", "update_date", F.lit(now)).alias("detection_date"), F.coalesce("update_date", F.lit(now)).alias("version"))
    kept = property_rows.where("reason is null").select(F.lower("type").alias("node_type"), F.trim("value").alias("value"), "id_source", "payload", "pos", F.coalesce("version", F.lit(now)).alias("version"), F.coalesce("detection_date", "version", F.lit(now)).alias("detection_date"))
    values = good.select(F.explode(F.array(F.struct(F.col("type_1").alias("node_type"), F.col("value_1").alias("value")), F.struct(F.col("type_2").alias("node_type"), F.col("value_2").alias("value")))).alias("v")).select("v.*").union(kept.select("node_type", "value"))
    node_map, new_nodes = resolve_or_create(values, node, now, ingest_seq)
    rows, _ = _resolved(good, node_map, ingest_seq)
    merged = kept.groupBy("node_type", "value", "id_source").agg(F.max_by("payload", F.struct("pos", "version", "payload")).alias("payload"), F.max("version").alias("version"), int32(F.min("detection_date")).alias("detection_date"))
    properties_out = merged.join(node_map, ["node_type", "value"]).withColumnRenamed("id", "id_node").withColumn("ingest_seq", F.lit(ingest_seq))
    return rows, conform(properties_out, PROPERTY), new_nodes, rejects


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, type, n) of each table's rows by its first type column."""
    parts = []
    for name, df in tables.items():
        kind = next((c for c in ("node_type", "type_1") if c in df.columns), None)
        parts.append(df.groupBy((F.col(kind) if kind else F.lit("")).alias("type")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "type", "n"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
