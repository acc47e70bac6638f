"""Searches over nodes and links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import like_pattern, search_value


def matching(node: DataFrame, node_type: str, term: str) -> DataFrame:
    return node.where((F.col("node_type") == node_type) & F.col("value").contains(search_value(node_type, term)))


def search(node: DataFrame, node_type: str, term: str, order: str = "id", limit: int = 100) -> DataFrame:
    """(id, value, rank) of values that hold a term, by id, or by rank with unknown ranks last."""
    by = [F.col("rank").asc_nulls_last(), F.col("id")] if order == "rank" else [F.col("id"), F.col("value")]
    return matching(node, node_type, term).select("id", "value", "rank").orderBy(*by).limit(limit)


def neighbours_of_matches(node: DataFrame, link: DataFrame, term: str, from_type: str = "fqdn", to_type: str = "ip") -> DataFrame:
    """(id, value) of nodes of to_type that a node of from_type with the term in its value links to, by value."""
    hosts = matching(node, from_type, term).select(F.col("id").alias("id_1"))
    ends = link.where((F.col("type_1") == from_type) & (F.col("type_2") == to_type)).join(hosts, "id_1", "left_semi").select(F.col("id_2").alias("id"))
    return node.where(F.col("node_type") == to_type).join(ends, "id", "left_semi").select("id", "value").distinct().orderBy("value")


def by_prefix(node: DataFrame, node_type: str, prefix: str) -> DataFrame:
    return node.where((F.col("node_type") == node_type) & F.col("value").startswith(prefix)).select("id", "value")


def by_suffix(node: DataFrame, node_type: str, suffix: str) -> DataFrame:
    """Values that end in suffix; a stored rev_value column lets the scan prune."""
    if "rev_value" in node.columns:
        return node.where((F.col("node_type") == node_type) & F.col("rev_value").startswith(suffix[::-1])).select("id", "value")
    return node.where((F.col("node_type") == node_type) & F.col("value").endswith(suffix)).select("id", "value")


def at_keys(df: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of df whose columns are among keys' ones."""
    return df.join(keys.select(*columns), columns, "left_semi")


def without_plugins(link: DataFrame, banned: DataFrame) -> DataFrame:
    """Links that don't lead to a banned plugin (banned: id)."""
    return link.join(banned.select(F.lit("plugin").alias("type_2"), F.col("id").alias("id_2")), ["type_2", "id_2"], "left_anti").select(*link.columns)


def find_roots(node: DataFrame, link: DataFrame, node_type: str, pattern: str, k: int = 10, banned: DataFrame | None = None, cap: int | None = None) -> DataFrame:
    """(id, value, rank, n, total, linked) of the k first values like a pattern in which only % is a wildcard.

    Linked nodes come first, then small ranks, many links, and the value. total and linked count all matches.
    With a cap, only so many matches, the first by value, are looked at, and a total of cap means "at least".
    ValueError if the pattern has under three other characters.
    """
    pattern = search_value(node_type, pattern)
    if len(pattern.replace("%", "")) < 3:
        raise ValueError("a pattern needs three characters beside %")
    rows = node.where((F.col("node_type") == node_type) & F.col("value").like(like_pattern(pattern)))
    if banned is not None and node_type == "plugin":
        rows = rows.join(banned.select("id"), "id", "left_anti").select(*node.columns)
    first = rows if cap is None else rows.orderBy("value").limit(cap)
    m = first.groupBy("value").agg(F.min("id").alias("id"), F.max_by(F.when(F.col("rank").isNotNull(), F.col("rank")), F.when(F.col("rank").isNotNull(), F.col("ingest_seq"))).alias("rank"))
    links = link.where(F.col("type_1") == node_type)
    links = without_plugins(links, banned) if banned is not None else links
    n = links.join(m.select(F.col("id").alias("id_1")), "id_1", "left_semi").groupBy(F.col("id_1").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    found = m.join(n, "id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    totals = found.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("n") > 0).alias("linked"))
    top = found.orderBy((F.col("n") > 0).desc(), F.col("rank").asc_nulls_last(), F.desc("n"), "value").limit(k)
    return top.crossJoin(totals).select("id", "value", "rank", "n", "total", "linked")


def properties_of(property_: DataFrame, node_type: str, id_node: int) -> DataFrame:
    return property_.where((F.col("node_type") == node_type) & (F.col("id_node") == id_node))


def from_source(df: DataFrame, id_source: int) -> DataFrame:
    return df.where(F.col("id_source") == id_source)


def trigrams(values: DataFrame) -> DataFrame:
    """(gram, id) postings of (id, value): each distinct three characters of a value."""
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("value") - 2), lambda i: F.substring(F.col("value"), i, F.lit(3))))
    return values.where(F.length("value") >= 3).select("id", F.explode(grams).alias("gram"))


def trigram_search(values: DataFrame, postings: DataFrame, term: str) -> DataFrame:
    """(id, value) that hold the term: those posted under all its trigrams, checked again."""
    grams = sorted({term[i : i + 3] for i in range(len(term) - 2)})
    if not grams:
        return values.where(F.col("value").contains(term)).select("id", "value")
    found = postings.where(F.col("gram").isin(grams)).groupBy("id").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(grams))
    return values.join(found, "id", "left_semi").where(F.col("value").contains(term)).select("id", "value")
