"""Incremental loads from a stream of link and property records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import payload_text, upsert_batch
from ..operators.stable import stable
from ..schema import LINK, NODE, PROPERTY
from ..sources.sinks import BatchFolders

LINK_RECORD = "value_1 string, value_2 string, type_1 string, type_2 string, source_uuid string, detection_date string, update_date string"
PROPERTY_RECORD = "value string, type string, source_uuid string, payload string, version string, detection_date string, pos bigint"
#: Tables that stream_into writes.
TABLES = {"node": NODE, "link": LINK, "property": PROPERTY, "reject": "kind string, reason string, n bigint"}
_LINK = ("value_1", "value_2", "type_1", "type_2", "source_uuid", "detection_date", "update_date")
_PROPERTY = ("value", "type", "source_uuid", "payload", "version", "detection_date", "pos")


def _tagged(links: DataFrame, properties: DataFrame) -> DataFrame:
    rows = links.select(F.lit("link").alias("_kind"), *_LINK)
    if properties.isStreaming:
        rows = rows.unionByName(payload_text(properties).select(F.lit("property").alias("_kind"), *_PROPERTY), allowMissingColumns=True)
    return rows


def _upserted(batch: DataFrame, properties: DataFrame, source: DataFrame, node: DataFrame, now: int, number: int) -> dict[str, DataFrame]:
    """What a batch adds to each table, computed once."""
    batch = stable(batch) if properties.isStreaming else batch
    own = batch.where("_kind = 'property'").select(*_PROPERTY) if properties.isStreaming else properties
    rows, props, new, rejects = upsert_batch(batch.where("_kind = 'link'").select(*_LINK), own, source, node, now, number)
    return {"node": stable(new), "link": stable(rows), "property": stable(props), "reject": rejects}


def stream_upsert(links: DataFrame, properties: DataFrame, source: DataFrame, tables: Callable[[], DataFrame], sink: Callable[[str, DataFrame], None], now: Callable[[], int], checkpoint: str) -> StreamingQuery:
    """Start a query over streams of link and property records; each batch is upserted with its number as ingest_seq.

    Both streams are one query, so a batch holds what came of either, each record once. properties may be a
    static table too, which then goes along with every batch. tables() reads the present node rows; sink(table,
    rows) appends node, link and property rows and, as table "reject", the counts of what was left out. A batch that
    is run again appends rows that merge to the same, since all merge rules are idempotent, so no watermark is needed.
    """

    def run(batch: DataFrame, number: int) -> None:
        for name, rows in _upserted(batch, properties, source, tables(), now(), number).items():
            sink(name, rows)

    return _tagged(links, properties).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_into(links: DataFrame, properties: DataFrame, source: DataFrame, store: BatchFolders, now: Callable[[int], int], checkpoint: str, node: DataFrame | None = None, **trigger) -> StreamingQuery:
    """As stream_upsert, into folders by batch (with the tables of TABLES), so that a batch that is run again leaves every table as if it had run once.

    A batch sees the nodes of `node` and of the batches before it, never its own of an earlier try: ids come out the
    same, and its folder holds all that it creates. now is asked by batch number, for the same reason. trigger is what
    writeStream.trigger takes; availableNow by default.
    """

    def run(batch: DataFrame, number: int) -> None:
        known = store.read("node", before=number).drop("batch")
        known = known if node is None else known.unionByName(node)
        for name, rows in _upserted(batch, properties, source, known, now(number), number).items():
            store.put(name, rows, number)

    return _tagged(links, properties).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
