"""Schemas of the stored tables and the closed list of node types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Node types, those with a rank, and pivot types in order.
NODE_TYPES = ("application", "capture", "fqdn", "ip", "plugin", "organization_name", "organization_id", "phone", "social_id")
RANKED = ("fqdn", "ip")
PIVOTS = ("ip", "application", "capture", "fqdn")
INT32_MAX = 2**31 - 1

NODE = "node_type string, value string, id bigint, rank int, version bigint, ingest_seq bigint"
LINK = "type_1 string, id_1 bigint, type_2 string, id_2 bigint, id_source int, detection_date int, version bigint, ingest_seq bigint"
PROPERTY = "node_type string, id_node bigint, id_source int, payload string, version bigint, detection_date int, ingest_seq bigint"
RANK = "node_type string, id_node bigint, id_source int, creation_date int, rank int, ingest_seq bigint"
SOURCE = "uuid string, id_source int"


def known_type(column: Column | str) -> Column:
    """Whether a node type is one of the closed list (false for null)."""
    return F.coalesce(F.col(column).isin(*NODE_TYPES) if isinstance(column, str) else column.isin(*NODE_TYPES), F.lit(False))


def conform(df: DataFrame, schema: str) -> DataFrame:
    """The columns of a schema in order, cast; missing ones are null."""
    fields = [f.strip().split(" ") for f in schema.split(",")]
    return df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in fields])
