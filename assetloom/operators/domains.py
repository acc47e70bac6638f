"""Registrable domains, nearest classified ancestors, tenants, brands and platforms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import reversed_labels
from .stable import stable

# Labels that name neither a tenant nor a brand.
TECH_LABELS = (
    "www", "www1", "www2", "www3", "m", "mobile", "mail", "webmail", "smtp", "imap", "pop", "pop3", "mx", "ns", "ns1", "ns2", "ns3", "dns", "api", "app", "apps",
    "cdn", "static", "img", "images", "media", "assets", "files", "download", "admin", "login", "auth", "sso", "id", "account", "accounts", "my", "dev", "test",
    "staging", "stage", "preprod", "prod", "beta", "demo", "sandbox", "support", "help", "status", "blog", "shop", "store", "docs", "portal", "secure", "vpn",
    "remote", "ftp", "autodiscover", "autoconfig", "cpanel", "webdisk", "whm", "default", "web", "en", "fr", "de", "es", "it", "nl", "us", "eu", "uk",
)

#: Some public suffixes of two labels; pass the full public list for real data.
SUFFIXES = ("co.uk", "org.uk", "gov.uk", "ac.uk", "com.au", "net.au", "org.au", "co.jp", "or.jp", "co.nz", "com.br", "com.cn", "co.in", "co.za", "com.mx", "com.tr", "gouv.fr", "asso.fr")


@dataclass(frozen=True)
class Params:
    weights: dict[str, int] = field(default_factory=lambda: {"tenant": 1, "fqdn": 2, "application": 2, "capture": 2, "ip": 1})
    min_score: int = 2
    min_votes: int = 3
    min_purity: float = 0.9
    guard_purity: float = 0.5
    max_degree: int = 1000
    platform_plugins: int = 10
    platform_diversity: float = 0.5
    platform_ratio: float = 0.05
    generic_domains: int = 20
    max_age_days: int = 365
    tech_labels: tuple[str, ...] = TECH_LABELS


@dataclass(frozen=True)
class SuffixRules:
    """Public-suffix rules by depth, the number of labels that are compared: (tail, public, exact).

    public is the number of labels of the suffix that a rule makes, exact says that it is an exception.
    """

    by_depth: dict[int, DataFrame]


def _parsed(rules: DataFrame) -> DataFrame:
    """(depth, tail, public, exact) of rules (suffix) as public lists write them: `a.b`, `*.b` for any label, `!c.b` for an exception to that."""
    own = F.lower(F.trim("suffix"))
    exact, wild = own.startswith("!"), own.startswith("*.")
    tail = F.when(exact, F.substring(own, 2, 1 << 20)).when(wild, F.substring(own, 3, 1 << 20)).otherwise(own)
    rows = rules.where(own.isNotNull() & (own != "")).select(tail.alias("tail"), exact.alias("exact"), wild.alias("wild"))
    depth = F.size(F.split("tail", r"\."))
    public = F.when(F.col("exact"), depth - 1).when(F.col("wild"), depth + 1).otherwise(depth)
    rows = rows.select(depth.alias("depth"), "tail", public.alias("public"), "exact")
    best = rows.groupBy("depth", "tail").agg(F.max(F.struct("exact", "public")).alias("r"))
    return best.select("depth", "tail", "r.public", "r.exact")


def rules_of(rules: DataFrame) -> SuffixRules:
    """Rules of a table (suffix); the depths that they have are looked up once. Give international names in the form that hosts have."""
    parsed = stable(_parsed(rules))
    depths = [r.depth for r in parsed.select("depth").distinct().orderBy("depth").collect()]  # a row a depth
    return SuffixRules({d: parsed.where(F.col("depth") == d).select("tail", "public", "exact") for d in depths})


def suffix_rules(spark: SparkSession, suffixes: tuple[str, ...] = SUFFIXES) -> SuffixRules:
    """Rules of a list that the program holds."""
    best: dict[int, dict[str, tuple[bool, int]]] = {}
    for rule in suffixes:
        exact, wild = rule.startswith("!"), rule.startswith("*.")
        tail = rule.removeprefix("!").removeprefix("*.").lower()
        depth = tail.count(".") + 1
        own = best.setdefault(depth, {})
        own[tail] = max(own.get(tail, (False, 0)), (exact, depth - 1 if exact else depth + wild))
    schema = pa.schema([("tail", pa.string()), ("public", pa.int32()), ("exact", pa.bool_())])
    table = lambda rows: spark.createDataFrame(pa.table([pa.array(c) for c in zip(*[(t, p, e) for t, (e, p) in sorted(rows.items())], strict=True)], schema=schema))
    return SuffixRules({d: table(rows) for d, rows in sorted(best.items())})


def _tail(column: Column, n: int) -> Column:
    return F.substring_index(column, ".", -n)


def registrable_domain(df: DataFrame, column: str, rules: SuffixRules | DataFrame, into: str = "reg") -> DataFrame:
    """df with the registrable domain of a host column: its public suffix and one label more, or the host if it has none more.

    The suffix is that of an exception, if one matches; else of the longest rule, where * stands for one label; else the
    last label. Each depth of rules is one equi join with the host's last labels.
    """
    rules = rules if isinstance(rules, SuffixRules) else rules_of(rules)
    out, public = df, [F.lit(1)]
    exception = F.lit(None).cast("int")
    for depth, own in rules.by_depth.items():
        key, n, exact = f"_tail{depth}", f"_public{depth}", f"_exact{depth}"
        out = out.withColumn(key, _tail(F.col(column), depth)).join(own.toDF(key, n, exact), key, "left").drop(key)
        public.append(F.coalesce(F.when(~F.col(exact), F.col(n)), F.lit(1)))
        exception = F.coalesce(F.when(F.col(exact), F.col(n)), exception)
    labels = F.coalesce(exception, F.greatest(*public, F.lit(1))) + 1
    value = F.col(column)
    reg = _tail(value, 2)
    for n in range(3, max(rules.by_depth, default=1) + 3):
        reg = F.when(labels == n, _tail(value, n)).otherwise(reg)
    return out.withColumn(into, reg).drop(*[f"{c}{d}" for d in rules.by_depth for c in ("_public", "_exact")])


def tech(column: Column, params: Params) -> Column:
    return column.isin(*params.tech_labels)


def classified_values(fqdn: DataFrame, classified: DataFrame) -> DataFrame:
    """(value, plugins): hosts with plugins."""
    return fqdn.select("value", F.col("id").alias("id_fqdn")).join(classified, "id_fqdn").groupBy("value").agg(F.array_sort(F.collect_set("id_plugin")).alias("plugins"))


def brands(values: DataFrame, suffix_rule: SuffixRules | DataFrame, params: Params = Params()) -> DataFrame:
    """(brand, plugins, domain) of classified registrable domains or their www, by first label."""
    rows = registrable_domain(values, "value", suffix_rule).where((F.col("value") == F.col("reg")) | (F.col("value") == F.concat(F.lit("www."), "reg")))
    rows = rows.select(F.split_part("reg", F.lit("."), F.lit(1)).alias("brand"), "reg", F.explode("plugins").alias("p")).where((F.length("brand") >= 3) & ~tech(F.col("brand"), params))
    return rows.groupBy("brand").agg(F.array_sort(F.collect_set("p")).alias("plugins"), F.min("reg").alias("domain"))


def tree_key(column: Column | str) -> Column:
    """Labels from the last one on, such that a name's key is followed by those of all names under it and by no other before them."""
    return F.translate(reversed_labels(F.col(column) if isinstance(column, str) else column), ".", "!")  # ! comes before all that hosts have


_ANCHORS = "array<struct<key: string, plugins: array<bigint>>>"


def _open_ancestors(rows: DataFrame) -> DataFrame:
    """rows (id_fqdn, value, key, plugins), in order of the key within each partition, with part and open: classified names of the partition over or at a row's name.

    One pass with a stack of open ancestors: a classified name closes those that it isn't under, and is pushed. All rows up to the next
    classified name have the same stack, so it is taken by index. Some of it may not be over a row; none that is lacks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, stack = TaskContext.get().partitionId(), []
        kind = pa.list_(pa.struct([("key", pa.string()), ("plugins", pa.list_(pa.int64()))]))
        for batch in batches:
            keys, plugins = batch.column("key"), batch.column("plugins")
            own = np.flatnonzero(pc.is_valid(plugins).to_numpy(zero_copy_only=False))
            states = [list(stack)]
            for key, of in zip(keys.take(pa.array(own)).to_pylist(), plugins.take(pa.array(own)).to_pylist(), strict=True):
                while stack and stack[-1]["key"] != key and not key.startswith(stack[-1]["key"] + "!"):
                    stack.pop()
                if not stack or stack[-1]["key"] != key:
                    stack.append({"key": key, "plugins": of})
                states.append(list(stack))
            at = np.zeros(len(batch), np.int64)
            at[own] = 1
            taken = pa.array(states, kind).take(pa.array(np.cumsum(at)))
            yield pa.RecordBatch.from_arrays([batch.column("id_fqdn"), batch.column("value"), keys, pa.array(np.full(len(batch), part, np.int64)), taken], ["id_fqdn", "value", "key", "part", "open"])

    return rows.select("id_fqdn", "value", "key", "plugins").mapInArrow(run, f"id_fqdn bigint, value string, key string, part bigint, open {_ANCHORS}")


def _over(stack: Column) -> Column:
    """Those of the stack that are over the row's name."""
    return F.filter(stack, lambda a: F.col("key").startswith(F.concat(a["key"], F.lit("!"))))


def nearest_ancestors(fqdn: DataFrame, values: DataFrame, suffix_rule: SuffixRules | DataFrame, parts: int | None = None) -> DataFrame:
    """(id_fqdn, value, anchor, plugins): the longest classified parent that isn't shorter than the registrable domain.

    Hosts are sorted by their labels from the last one on, in ranges, which is the one shuffle of them; a parent then
    comes before all that is under it. What is open where a range begins are the classified names over or at its first one,
    found by one small join. So hosts under one popular parent need not meet, and no row is copied for each of its parents.
    """
    spark = fqdn.sparkSession
    hosts = fqdn.where(F.regexp_count("value", F.lit(r"\.")) >= 2).select(F.col("id").alias("id_fqdn"), "value", F.lit(None).cast("array<bigint>").alias("plugins"))
    rows = hosts.unionByName(values.where(F.col("value").contains(".")).select(F.lit(None).cast("bigint").alias("id_fqdn"), "value", "plugins"))
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a classified name that is a host too comes twice: as a host and, first, as a parent
    ordered = rows.withColumn("key", tree_key("value")).withColumn("_host", F.col("plugins").isNull()).repartitionByRange(n, "key", "_host").sortWithinPartitions("key", "_host")
    found = _open_ancestors(ordered)
    found = stable(found.select("id_fqdn", "value", "key", "part", F.try_element_at(_over(F.col("open")), F.lit(-1)).alias("a")))
    first = found.groupBy("part").agg(F.min("key").alias("key"))  # a row a range
    labels = F.split("key", "!")
    over = first.select("part", F.explode(F.transform(F.sequence(F.lit(2), F.size(labels)), lambda i: F.array_join(F.slice(labels, 1, i), "!"))).alias("parent"))
    known = values.select(tree_key("value").alias("parent"), "plugins").join(F.broadcast(over), "parent")
    before = known.groupBy("part").agg(F.array_sort(F.collect_list(F.struct(F.col("parent").alias("key"), "plugins"))).alias("before"))
    best = F.coalesce("a", F.try_element_at(_over(F.col("before")), F.lit(-1)))
    rows = found.where("id_fqdn is not null").join(F.broadcast(before), "part", "left").withColumn("a", best).where("a is not null")
    rows = rows.select("id_fqdn", "value", reversed_labels(F.translate("a.key", "!", ".")).alias("anchor"), F.col("a.plugins").alias("plugins"))
    reg = registrable_domain(rows, "value", suffix_rule)
    return reg.where(F.octet_length("anchor") >= F.octet_length("reg")).select("id_fqdn", "value", "anchor", "plugins")


def own_plugins(classified: DataFrame) -> DataFrame:
    return classified.groupBy("id_fqdn").agg(F.array_sort(F.collect_set("id_plugin")).alias("own"))


def ancestors(fqdn: DataFrame, classified: DataFrame, suffix_rule: SuffixRules | DataFrame, params: Params = Params()) -> DataFrame:
    """(id_fqdn, value, anchor, plugins, own, tenant, brand, brand_plugins) of hosts under a classified one.

    tenant is the label before the ancestor; brand the tenant or what stands before its first hyphen, if that
    is a brand; brand_plugins are the brand's without the ancestor's.
    """
    values = classified_values(fqdn, classified)
    brand = brands(values, suffix_rule, params)
    rows = nearest_ancestors(fqdn, values, suffix_rule).join(own_plugins(classified), "id_fqdn", "left")
    front = F.expr("substring(value, 1, length(value) - length(anchor) - 1)")
    none = F.array().cast("array<bigint>")
    rows = rows.withColumn("own", F.coalesce("own", none)).withColumn("tenant", F.substring_index(front, ".", -1))
    rows = rows.withColumn("head", F.substring_index("tenant", "-", 1))
    whole = brand.select(F.col("brand").alias("tenant"), F.col("plugins").alias("_b1"))
    part = brand.select(F.col("brand").alias("head"), F.col("plugins").alias("_b2"))
    rows = rows.join(whole, "tenant", "left").join(part, "head", "left")
    no_head = tech(F.col("tenant"), params) | (F.col("head") == F.col("tenant")) | (F.length("head") < 3) | tech(F.col("head"), params)
    b1 = F.when(~tech(F.col("tenant"), params), F.col("_b1"))
    b2 = F.when(~no_head, F.col("_b2"))
    name = F.when(b1.isNotNull(), F.col("tenant")).when(b2.isNotNull(), F.col("head")).otherwise("")
    return rows.select("id_fqdn", "value", "anchor", "plugins", "own", "tenant", name.alias("brand"), F.array_except(F.coalesce(b1, b2, none), "plugins").alias("brand_plugins"))


def generic_names(anc: DataFrame, suffix_rule: SuffixRules | DataFrame, params: Params = Params()) -> DataFrame:
    """(brand) of tenants found under many registrable domains."""
    rows = registrable_domain(anc.where("brand <> ''").select("brand", "anchor"), "anchor", suffix_rule)
    return rows.groupBy("brand").agg(F.count_distinct("reg").alias("n")).where(F.col("n") >= params.generic_domains).select("brand")


def usable_brand_plugins(anc: DataFrame, generic: DataFrame) -> DataFrame:
    """anc with generic (boolean) and usable, its brand plugins unless the name is generic."""
    rows = anc.join(generic.select("brand", F.lit(True).alias("generic")), "brand", "left").withColumn("generic", F.coalesce("generic", F.lit(False)))
    return rows.withColumn("usable", F.when(F.col("generic"), F.array().cast("array<bigint>")).otherwise(F.col("brand_plugins")))


def platform_stats(anc: DataFrame, generic: DataFrame, params: Params = Params()) -> DataFrame:
    """Counters of each ancestor: tenants, brands, their plugins, classified hosts, and those of other plugins. All exact."""
    rows = usable_brand_plugins(anc, generic)
    other = F.array_except("own", "plugins")
    counts = rows.groupBy("anchor").agg(
        F.min("plugins").alias("plugins"),
        F.count_distinct(F.when(~tech(F.col("tenant"), params), F.col("tenant"))).alias("nb_tenants"),
        F.count_distinct(F.when(F.size("usable") > 0, F.col("tenant"))).alias("nb_brand"),
        F.count_if(F.size("own") > 0).alias("nb_classified"),
        F.count_if(F.size(other) > 0).alias("nb_classified_other"),
    )
    brand = rows.select("anchor", F.explode("usable").alias("p")).groupBy("anchor").agg(F.count_distinct("p").alias("nb_brand_plugins"))
    others = rows.select("anchor", F.explode(other).alias("p")).groupBy("anchor").agg(F.count_distinct("p").alias("nb_plugins_other"))
    out = counts.join(brand, "anchor", "left").join(others, "anchor", "left").na.fill(0, ["nb_brand_plugins", "nb_plugins_other"])
    return out.select("anchor", "plugins", "nb_tenants", "nb_brand", "nb_brand_plugins", "nb_classified", "nb_classified_other", "nb_plugins_other")


def platforms(stats: DataFrame, params: Params = Params()) -> DataFrame:
    """(anchor) of ancestors whose tenants are diverse, by their own plugins or by their brands' ones."""
    own = (F.col("nb_plugins_other") >= params.platform_plugins) & (F.try_divide("nb_plugins_other", "nb_classified_other") >= params.platform_diversity)
    brand = (F.col("nb_brand_plugins") >= params.platform_plugins) & (F.try_divide("nb_brand_plugins", "nb_brand") >= params.platform_diversity) & (F.try_divide("nb_brand", "nb_tenants") >= params.platform_ratio)
    return stats.where(own | brand).select("anchor")
