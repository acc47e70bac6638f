"""Weekly ranks: loading, history, retention and distribution."""

from __future__ import annotations

import datetime
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import classify, retained, search_value, uuid
from ..schema import NODE, RANK, RANKED, conform
from .ids import resolve_or_create
from .merge import current


def week_of(day: datetime.date) -> datetime.date:
    """The Saturday of a day's week of Sunday to Saturday."""
    return day + datetime.timedelta(days=(5 - day.weekday()) % 7)


def normalize_ranks(ranks: DataFrame, node_type: str = "fqdn") -> DataFrame:
    """(value, rank): the best positive rank of each valid value. Unroutable addresses are valid here."""
    kind = classify(F.col("value"), routable_only=False)
    rows = ranks.select(kind.alias("k"), "rank").where("rank > 0").select("k.kind", "k.value", "rank")
    return rows.where(F.col("kind") == node_type).groupBy("value").agg(F.min("rank").cast("int").alias("rank"))


def load_ranks(ranks: DataFrame, source_uuid: str, week: datetime.date, node: DataFrame, source: DataFrame, now: int, today: datetime.date, node_type: str = "fqdn", ingest_seq: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rank_rows, node_rows, report) of (value, rank) rows of one source and week.

    node_rows hold new nodes and, for every value, its id with the new current rank. report counts raw, valid,
    created and unresolved. ValueError for a type without ranks, an unknown source or an expired week.
    """
    if node_type not in RANKED:
        raise ValueError(f"no ranks for type {node_type}")
    ids = source.where(uuid(F.col("uuid")) == source_uuid.strip().lower()).agg(F.min("id_source")).first()[0]
    if ids is None:
        raise ValueError(f"unknown source {source_uuid}")
    saturday = week_of(week)
    if saturday + datetime.timedelta(days=730) <= today:
        raise ValueError(f"the week of {saturday} has expired")
    at = int(datetime.datetime(saturday.year, saturday.month, saturday.day, tzinfo=datetime.UTC).timestamp())
    valid = normalize_ranks(ranks, node_type)
    own = node.where(F.col("node_type") == node_type)
    node_map, new = resolve_or_create(valid.select(F.lit(node_type).alias("node_type"), "value"), own, now, ingest_seq)
    placed = valid.join(node_map, "value", "left")
    found = placed.where("id is not null")
    rank_rows = conform(found.select(F.lit(node_type).alias("node_type"), F.col("id").alias("id_node"), F.lit(ids).alias("id_source"), F.lit(at).alias("creation_date"), "rank", F.lit(ingest_seq).alias("ingest_seq")), RANK)
    current_rows = found.select("node_type", "value", "id", "rank", F.lit(now).alias("version"), F.lit(ingest_seq + 1).alias("ingest_seq"))
    report = ranks.agg(F.count(F.lit(1)).alias("raw")).crossJoin(placed.agg(F.count(F.lit(1)).alias("valid"), F.count_if(F.col("id").isNull()).alias("unresolved"))).crossJoin(new.agg(F.count(F.lit(1)).alias("created")))
    return rank_rows, conform(new, NODE).unionByName(conform(current_rows, NODE)), report


def load_web_graph(spark: SparkSession, path: str, source_uuid: str, week: datetime.date, node: DataFrame, source: DataFrame, now: int, today: datetime.date, ingest_seq: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rank_rows, node_rows, report) of a web-graph ranking file, from its lines to ranks of hosts."""
    from ..sources.files import read_web_graph_ranks

    return load_ranks(read_web_graph_ranks(spark, path), source_uuid, week, node, source, now, today, "fqdn", ingest_seq)


def rank_history(rank: DataFrame, node: DataFrame, node_type: str, value: str, today: Column, id_source: int | None = None) -> DataFrame:
    """(id_source, week, rank) of a node over the last two years, by source and week; of a repeated week the last one."""
    ids = node.where((F.col("node_type") == node_type) & (F.col("value") == search_value(node_type, value))).groupBy("node_type").agg(F.min("id").alias("id_node"))
    rows = current(rank.join(ids, ["node_type", "id_node"], "left_semi"), "rank")
    rows = rows if id_source is None else rows.where(F.col("id_source") == id_source)
    week = F.to_date(F.timestamp_seconds("creation_date"))
    return rows.select("id_source", week.alias("week"), "rank").where(F.col("week") > F.add_months(today, -24)).orderBy("id_source", "week")


def purge(rank: DataFrame, today: Column) -> DataFrame:
    """The ranks that are still kept."""
    return rank.where(retained(F.to_date(F.timestamp_seconds("creation_date")), today))


def order_statistics(df: DataFrame, places: dict[str, list[int]], scope: str = "scope", column: str = "rank") -> dict[tuple[str, int], int]:
    """The numbers (below 2^31) at the given places, from 0, of each scope's sorted column; exact, without a sort.

    Three rounds of counts by 11, 10 and 10 bits each narrow every place to one bucket, so a round brings some
    thousand counts to the driver, whatever the rows.
    """
    want = {(s, k): (0, k) for s, own in places.items() for k in own}  # prefix found so far, and the place within it
    for shift in (20, 10, 0):
        cell = F.shiftright(F.col(column), shift)
        rows = df.where(F.col(column).isNotNull())
        if shift < 20:
            known = sorted({prefix for prefix, _ in want.values()})
            rows = rows.where(F.shiftright(F.col(column), shift + 10).isin(known)) if known else rows.where("false")
        counts: dict[tuple[str, int], list[tuple[int, int]]] = {}
        for r in rows.groupBy(F.col(scope).alias("s"), cell.alias("b")).agg(F.count(F.lit(1)).alias("n")).orderBy("s", "b").collect():
            counts.setdefault((r.s, r.b >> 10 if shift < 20 else 0), []).append((r.b, r.n))
        for key, (prefix, place) in want.items():
            for bucket, n in counts[(key[0], prefix)]:
                if place < n:
                    break
                place -= n
            want[key] = (bucket, place)
    return {key: value for key, (value, _) in want.items()}


def rank_distribution(node: DataFrame, term: str, shares: tuple[float, ...] = (0.001, 0.01, 0.5)) -> DataFrame:
    """(scope, n, unknown, best, q...) of ranks, of all rows and of those whose value holds the term; quantiles lie between neighbours in proportion."""
    columns = [F.count(F.lit(1)).alias("n"), F.count_if(F.col("rank").isNull()).alias("unknown"), F.min("rank").alias("best")]
    scopes = F.when(F.col("value").contains(term), F.array(F.lit("all"), F.lit("matching"))).otherwise(F.array(F.lit("all")))
    rows = node.select(F.explode(scopes).alias("scope"), "rank")
    found = {r.scope: r for r in rows.groupBy("scope").agg(*columns).collect()}
    at = {s: [(r.n - r.unknown - 1) * p for p in shares] if r.n > r.unknown else [] for s, r in found.items()}
    exact = order_statistics(rows, {s: sorted({k for x in own for k in (math.floor(x), math.ceil(x))}) for s, own in at.items()})
    out = []
    for scope in ("all", "matching"):
        r = found.get(scope)
        between = [exact[scope, math.floor(x)] + (exact[scope, math.ceil(x)] - exact[scope, math.floor(x)]) * (x - math.floor(x)) for x in at.get(scope, [])]
        out.append((scope, r.n if r else 0, r.unknown if r else 0, r.best if r else None, *([float(x) for x in between] or [None] * len(shares))))
    return node.sparkSession.createDataFrame(out, "scope string, n bigint, unknown bigint, best int, " + ", ".join(f"q{i} double" for i in range(len(shares))))
