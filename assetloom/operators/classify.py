"""Classification candidates from ancestors, tenants and shared pivots."""

from __future__ import annotations

import datetime
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import slice_of
from ..schema import PIVOTS
from . import domains
from .domains import Params
from .stable import stable


def classified_pairs(link: DataFrame, holdout_percent: float = 0, hidden: bool = False) -> DataFrame:
    """(id_fqdn, id_plugin) of hosts linked to plugins; hidden gives those that a holdout by hash puts aside."""
    rows = link.where("type_1 = 'plugin' and type_2 = 'fqdn'").select(F.col("id_2").alias("id_fqdn"), F.col("id_1").alias("id_plugin")).distinct()
    if not holdout_percent and not hidden:
        return rows
    aside = slice_of(F.col("id_fqdn"), 10_000) < round(holdout_percent * 100)
    return rows.where(aside if hidden else ~aside)


def pivot_votes(link: DataFrame, classified: DataFrame) -> DataFrame:
    """(pivot_type, id_pivot, id_plugin, n): classified hosts linked to a pivot, by plugin."""
    rows = link.where((F.col("type_1") == "fqdn") & F.col("type_2").isin(*PIVOTS)).select(F.col("type_2").alias("pivot_type"), F.col("id_2").alias("id_pivot"), F.col("id_1").alias("id_fqdn"))
    return rows.join(classified, "id_fqdn").groupBy("pivot_type", "id_pivot", "id_plugin").agg(F.count_distinct("id_fqdn").alias("n"))


def direct_pivots(link: DataFrame, classified: DataFrame) -> DataFrame:
    """(pivot_type, id_pivot, id_plugin) of pivots linked to plugins themselves, and of all classified hosts."""
    others = [p for p in PIVOTS if p != "fqdn"]
    rows = link.where((F.col("type_1") == "plugin") & F.col("type_2").isin(*others)).select(F.col("type_2").alias("pivot_type"), F.col("id_2").alias("id_pivot"), F.col("id_1").alias("id_plugin"))
    return rows.distinct().unionByName(classified.select(F.lit("fqdn").alias("pivot_type"), F.col("id_fqdn").alias("id_pivot"), "id_plugin"))


def pivot_degrees(link: DataFrame, pivots: DataFrame) -> DataFrame:
    """(pivot_type, id_pivot, degree): hosts linked to each of the pivots."""
    rows = link.where("type_2 = 'fqdn'").select(F.col("type_1").alias("pivot_type"), F.col("id_1").alias("id_pivot"), "id_2")
    found = rows.join(pivots.select("pivot_type", "id_pivot").distinct(), ["pivot_type", "id_pivot"], "left_semi")
    return found.groupBy("pivot_type", "id_pivot").agg(F.count_distinct("id_2").alias("degree"))


def _ballots(link: DataFrame, classified: DataFrame, params: Params) -> tuple[DataFrame, DataFrame]:
    """(bounded, ballots): hosts counted for each pivot within max_degree, and (pivot, voters by plugin as a map) of those.

    A hub's links are in no join: its count alone says that it is one.
    """
    ends = link.where((F.col("type_2") == "fqdn") & F.col("type_1").isin(*PIVOTS)).select(F.struct(F.col("type_1").alias("kind"), F.col("id_1").alias("id")).alias("pivot"), F.col("id_2").alias("id_fqdn")).distinct()
    bounded = stable(ends.groupBy("pivot").agg(F.count("id_fqdn").alias("degree")).where(F.col("degree") <= params.max_degree))
    cast = ends.join(bounded.select("pivot"), "pivot", "left_semi").join(classified, "id_fqdn").groupBy("pivot", "id_plugin").agg(F.count("id_fqdn").alias("n"))
    return bounded, cast.groupBy("pivot").agg(F.map_from_entries(F.collect_list(F.struct("id_plugin", "n"))).alias("votes"))


def pivot_labels(link: DataFrame, classified: DataFrame, params: Params = Params()) -> DataFrame:
    """(pivot_type, id_pivot, id_plugin, direct, n, total, degree) of pivots that speak for a plugin.

    A pivot is one row with its voters by plugin and the plugins linked to it, which its degree bounds. A plugin is
    named by enough voters, or by its own link however few they are; total adds up all voters of the pivot.
    """
    bounded, ballots = _ballots(link, classified, params)
    linked = direct_pivots(link, classified).groupBy(F.struct(F.col("pivot_type").alias("kind"), F.col("id_pivot").alias("id")).alias("pivot")).agg(F.collect_set("id_plugin").alias("linked"))
    none = F.array().cast("array<bigint>")
    rows = bounded.join(ballots, "pivot", "left").join(linked, "pivot", "left").withColumn("linked", F.coalesce("linked", none))
    count = lambda p: F.coalesce(F.try_element_at("votes", p), F.lit(0).cast("bigint"))
    enough = F.map_keys(F.map_filter("votes", lambda _, n: n >= params.min_votes))
    named = rows.withColumn("total", F.coalesce(F.aggregate(F.map_values("votes"), F.lit(0).cast("bigint"), lambda a, n: a + n), F.lit(0))).select("*", F.explode(F.array_union("linked", F.coalesce(enough, none))).alias("id_plugin"))
    return named.select(F.col("pivot.kind").alias("pivot_type"), F.col("pivot.id").alias("id_pivot"), "id_plugin", F.array_contains("linked", F.col("id_plugin")).alias("direct"), count(F.col("id_plugin")).alias("n"), "total", "degree")


def _voting(params: Params, direct: Column, n: Column, rest: Column) -> Column:
    purity = F.when(rest == 0, 1.0).otherwise(F.try_divide(n, rest))
    return (direct & ((rest == 0) | (purity >= params.guard_purity))) | ((n >= params.min_votes) & (purity >= params.min_purity))


def _possible(labels: DataFrame, own: DataFrame, params: Params) -> DataFrame:
    """Labels that speak for some host: total less the plugins of the host that has most is the smallest rest, and a smaller rest never takes a vote away."""
    most = own.agg(F.coalesce(F.max(F.size("own")), F.lit(0)).alias("most"))
    rest = F.greatest(F.col("total") - F.col("most"), F.lit(0))
    return labels.crossJoin(F.broadcast(most)).where(_voting(params, F.col("direct"), F.col("n"), rest)).drop("most")  # one row


def pivot_signals(link: DataFrame, labels: DataFrame, classified: DataFrame, params: Params = Params()) -> DataFrame:
    """(id_fqdn, id_plugin, signal, nb_pivots): plugins that a host's pivots speak for, without its own vote and its own plugins.

    A pivot is one row with its labels, so a link is never copied for each of them: what a host's own plugins leave of the
    labels is found within the row, and only votes that count become rows.
    """
    own = domains.own_plugins(classified)
    label = F.struct("id_plugin", "direct", "n", "total")
    speaking = stable(_possible(labels, own, params).groupBy("pivot_type", "id_pivot").agg(F.collect_list(label).alias("labels")))
    near = link.where((F.col("type_2") == "fqdn") & F.col("type_1").isin(*PIVOTS)).select(F.col("type_1").alias("pivot_type"), F.col("id_1").alias("id_pivot"), F.col("id_2").alias("id_fqdn"))
    near = near.join(speaking.select("pivot_type", "id_pivot"), ["pivot_type", "id_pivot"], "left_semi").distinct()
    rows = near.join(own, "id_fqdn", "left").join(speaking, ["pivot_type", "id_pivot"]).withColumn("own", F.coalesce("own", F.array().cast("array<bigint>")))
    rest = lambda x: F.greatest(x["total"] - F.size("own"), F.lit(0))
    votes = F.filter("labels", lambda x: ~F.array_contains("own", x["id_plugin"]) & _voting(params, x["direct"], x["n"], rest(x)))
    kept = rows.select("id_fqdn", "pivot_type", "id_pivot", F.explode(F.transform(votes, lambda x: x["id_plugin"])).alias("id_plugin"))
    return kept.groupBy("id_fqdn", "id_plugin", F.col("pivot_type").alias("signal")).agg(F.count_distinct("id_pivot").alias("nb_pivots"))


def tenant_signals(anc: DataFrame, generic: DataFrame, platform: DataFrame) -> DataFrame:
    """(id_fqdn, id_plugin, signal, fqdn, anchor, nb_pivots) of tenants of platforms whose name is a brand."""
    rows = domains.usable_brand_plugins(anc, generic).join(platform, "anchor", "left_semi")
    return rows.select("id_fqdn", F.explode(F.array_except("usable", "own")).alias("id_plugin"), F.lit("tenant").alias("signal"), F.col("value").alias("fqdn"), "anchor", F.lit(0).cast("bigint").alias("nb_pivots"))


def not_inherited(signals: DataFrame, anc: DataFrame) -> DataFrame:
    """Signals for plugins that the host's ancestor doesn't have already."""
    return signals.join(anc.select("id_fqdn", F.explode("plugins").alias("id_plugin")), ["id_fqdn", "id_plugin"], "left_anti")


def candidates(signals: DataFrame, classified: DataFrame, params: Params = Params()) -> DataFrame:
    """(id_fqdn, id_plugin, fqdn, status, score, signals, anchor, nb_pivots): the one best plugin of a host, if its score suffices.

    One row of proposals a host: the leader is the largest by score, and stays if the sorted scores show no equal second one.
    """
    kinds = [*params.weights, "tenant"]
    flags = [F.bool_or(F.col("signal") == k).alias(f"has_{k}") for k in dict.fromkeys(kinds)]
    others = F.array_sort(F.array_distinct(F.collect_list("signal")))
    said = signals.groupBy("id_fqdn", "id_plugin").agg(others.alias("signals"), *flags, F.max("fqdn").alias("fqdn"), F.max("anchor").alias("anchor"), F.sum("nb_pivots").alias("nb_pivots"))
    score = sum((F.when(F.col(f"has_{k}"), w).otherwise(0) for k, w in params.weights.items()), F.lit(0))
    proposal = F.struct(score.alias("score"), "id_plugin", "signals", "has_tenant", "fqdn", "anchor", "nb_pivots")
    hosts = said.select("id_fqdn", proposal.alias("p")).where(F.col("p.score") >= params.min_score).groupBy("id_fqdn").agg(F.max("p").alias("leader"), F.sort_array(F.collect_list("p.score"), asc=False).alias("scores"))
    clear = hosts.where((F.size("scores") == 1) | (F.get("scores", F.lit(0)) > F.get("scores", F.lit(1))))
    known = classified.select("id_fqdn", F.lit(True).alias("known")).distinct()
    rows = clear.select("id_fqdn", "leader.*").join(known, "id_fqdn", "left")
    with_own = F.when(F.col("has_tenant"), "complement").otherwise("conflit")
    return rows.select("id_fqdn", "id_plugin", "fqdn", F.when(F.col("known"), with_own).otherwise("non_classe").alias("status"), "score", "signals", "anchor", "nb_pivots")


def dated(cand: DataFrame, link: DataFrame, property_: DataFrame, rank: DataFrame | None, now: datetime.datetime, params: Params = Params()) -> DataFrame:
    """Candidates with first (first property's Unix seconds) and keep: whether an unclassified host is young enough, or at least known."""
    first = property_.where("node_type = 'fqdn'").groupBy(F.col("id_node").alias("id_fqdn")).agg(F.min("detection_date").alias("first"))
    known = link.where("type_1 = 'fqdn'").select(F.col("id_1").alias("id_fqdn"))
    if rank is not None:
        known = known.union(rank.where("node_type = 'fqdn'").select("id_node"))
    rows = cand.join(first, "id_fqdn", "left")
    # one row a host before anything is shuffled; a semi join would be pushed below that, among all links
    seen = known.distinct().withColumn("seen", F.lit(True))
    oldest = int((now - datetime.timedelta(days=params.max_age_days)).timestamp())
    known_ = (F.col("nb_pivots") > 0) | F.coalesce("seen", F.lit(False))
    keep = (F.col("status") != "non_classe") | F.when(F.col("first").isNotNull(), F.col("first") >= oldest).otherwise(known_)
    return rows.join(seen, "id_fqdn", "left").withColumn("keep", keep).drop("seen")


@dataclass(frozen=True)
class Steps:
    """The tables between links and results, each computed once, when it is first asked for.

    Tenants and platforms come from names and classified hosts alone, so what is asked of them reads no pivot's links.
    """

    node: DataFrame
    link: DataFrame
    suffix_rule: domains.SuffixRules | DataFrame
    params: Params = Params()
    holdout_percent: float = 0

    @cached_property
    def fqdn(self) -> DataFrame:
        return self.node.where("node_type = 'fqdn'")

    @cached_property
    def classified(self) -> DataFrame:
        return stable(classified_pairs(self.link, self.holdout_percent))

    @cached_property
    def anc(self) -> DataFrame:
        return stable(domains.ancestors(self.fqdn, self.classified, self.suffix_rule, self.params))

    @cached_property
    def generic(self) -> DataFrame:
        return domains.generic_names(self.anc, self.suffix_rule, self.params)

    @cached_property
    def stats(self) -> DataFrame:
        return stable(domains.platform_stats(self.anc, self.generic, self.params))

    @cached_property
    def platform(self) -> DataFrame:
        return domains.platforms(self.stats, self.params)

    @cached_property
    def tenant(self) -> DataFrame:
        return tenant_signals(self.anc, self.generic, self.platform)

    @cached_property
    def labels(self) -> DataFrame:
        return stable(pivot_labels(self.link, self.classified, self.params))

    @cached_property
    def signals(self) -> DataFrame:
        pivot = not_inherited(pivot_signals(self.link, self.labels, self.classified, self.params), self.anc)
        blank = pivot.withColumns({"fqdn": F.lit(None).cast("string"), "anchor": F.lit(None).cast("string")})
        return stable(self.tenant.unionByName(blank))

    @cached_property
    def cand(self) -> DataFrame:
        return candidates(self.signals, self.classified, self.params)

    @cached_property
    def plugin(self) -> DataFrame:
        """(id_plugin, plugin): names of plugins."""
        return self.node.where("node_type = 'plugin'").groupBy(F.col("id").alias("id_plugin")).agg(F.min("value").alias("plugin"))


def steps(node: DataFrame, link: DataFrame, suffix_rule: domains.SuffixRules | DataFrame, params: Params = Params(), holdout_percent: float = 0) -> Steps:
    return Steps(node, link, suffix_rule, params, holdout_percent)


def find_misclassified(node: DataFrame, link: DataFrame, property_: DataFrame, suffix_rule: domains.SuffixRules | DataFrame, now: datetime.datetime, rank: DataFrame | None = None, params: Params = Params()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(candidate, tenant, platform) result tables.

    Fixed values: the result columns premiere_detection, nom_generique, plugins_proposes, domaine_marque and
    plugins_lies have the names that users' queries on these tables already use.
    """
    s = steps(node, link, suffix_rule, params)
    at = F.lit(now).cast("timestamp")
    tables = candidate_table(s, property_, now, rank), tenant_table(s), platform_table(s, s.plugin)
    return tuple(t.withColumn("computed_at", at) for t in tables)


def candidate_table(s: Steps, property_: DataFrame, now: datetime.datetime, rank: DataFrame | None = None) -> DataFrame:
    """Candidates to keep, by name."""
    names = s.fqdn.groupBy(F.col("id").alias("id_fqdn")).agg(F.min("value").alias("_name"))
    rows = dated(s.cand, s.link, property_, rank, now, s.params).where("keep").join(s.plugin, "id_plugin", "left").join(names, "id_fqdn", "left")
    return rows.select("id_fqdn", F.coalesce("fqdn", "_name").alias("fqdn"), "id_plugin", "plugin", "status", "score", "signals", F.coalesce("anchor", F.lit("")).alias("anchor"), "nb_pivots", F.timestamp_seconds("first").alias("premiere_detection"))


def tenant_table(s: Steps) -> DataFrame:
    return tenants(s, s.plugin, domains.brands(domains.classified_values(s.fqdn, s.classified), s.suffix_rule, s.params), s.params)


def named(rows: DataFrame, column: str, plugin: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, column) with an array of plugin ids as sorted names."""
    spread = rows.select(*keys, F.explode(column).alias("id_plugin")).join(plugin, "id_plugin")
    return spread.groupBy(*keys).agg(F.array_sort(F.collect_set("plugin")).alias(column))


def tenants(s: Steps, plugin: DataFrame, brand: DataFrame, params: Params = Params()) -> DataFrame:
    """Tenants of platforms but technical labels, with proposed and linked plugins by name."""
    rows = domains.usable_brand_plugins(s.anc, s.generic).join(s.platform, "anchor", "left_semi").where(~domains.tech(F.col("tenant"), params))
    rows = rows.withColumn("proposed", F.array_except("usable", "own"))
    none = F.array().cast("array<string>")
    proposed, linked = named(rows, "proposed", plugin, ["id_fqdn"]), named(rows, "own", plugin, ["id_fqdn"])
    out = rows.select("id_fqdn", F.col("value").alias("fqdn"), F.col("anchor").alias("platform"), "tenant", "brand", F.col("generic").alias("nom_generique"))
    out = out.join(proposed, "id_fqdn", "left").join(linked, "id_fqdn", "left").join(brand.select("brand", "domain"), "brand", "left")
    return out.select("id_fqdn", "fqdn", "platform", "tenant", "nom_generique", F.coalesce("proposed", none).alias("plugins_proposes"), F.coalesce("domain", F.lit("")).alias("domaine_marque"), F.coalesce("own", none).alias("plugins_lies"))


def platform_table(s: Steps, plugin: DataFrame) -> DataFrame:
    rows = s.stats.join(s.platform, "anchor", "left_semi")
    return rows.drop("plugins").join(named(rows, "plugins", plugin, ["anchor"]), "anchor", "left").withColumnRenamed("anchor", "platform")


def evaluate(node: DataFrame, link: DataFrame, suffix_rule: domains.SuffixRules | DataFrame, percent: float, params: Params = Params()) -> DataFrame:
    """(signal, found, recall, proposed, precision) on hosts that a holdout hides.

    found counts hidden pairs that come back: in all, inherited from an ancestor that is no platform, as
    candidates, and by each signal.
    """
    s = steps(node, link, suffix_rule, params, percent)
    pairs = stable(classified_pairs(link, percent, hidden=True))
    hosts = pairs.select("id_fqdn").distinct()
    inherited = s.anc.join(hosts, "id_fqdn", "left_semi").join(s.platform, "anchor", "left_anti").select("id_fqdn", F.explode("plugins").alias("id_plugin")).distinct()
    cand = stable(s.cand.select("id_fqdn", "id_plugin").join(hosts, "id_fqdn", "left_semi"))
    keys = ["id_fqdn", "id_plugin"]
    flagged = pairs.join(inherited.withColumn("i", F.lit(True)), keys, "left").join(cand.withColumn("c", F.lit(True)), keys, "left")
    one = flagged.agg(F.count_if(F.coalesce("i", "c").isNotNull()).alias("a"), F.count_if(F.col("i").isNotNull()).alias("b"))
    zero = F.lit(0).cast("bigint")
    rows = one.select(F.explode(F.array(F.struct(F.lit("total").alias("signal"), F.col("a").alias("found"), zero.alias("proposed")), F.struct(F.lit("inherited").alias("signal"), F.col("b").alias("found"), zero.alias("proposed")))).alias("x")).select("x.*")
    true = pairs.withColumn("t", F.lit(True))
    counts = [F.count_if(F.col("t").isNotNull()).alias("found"), F.count(F.lit(1)).alias("proposed")]
    by_cand = cand.join(true, keys, "left").groupBy(F.lit("candidates").alias("signal")).agg(*counts)
    by_signal = s.signals.join(hosts, "id_fqdn", "left_semi").join(true, keys, "left").groupBy("signal").agg(*counts)
    out = rows.unionByName(by_cand).unionByName(by_signal).crossJoin(pairs.agg(F.count(F.lit(1)).alias("hidden")))
    return out.select("signal", "found", F.try_divide("found", "hidden").alias("recall"), "proposed", F.try_divide("found", "proposed").alias("precision"))


def by_plugin(candidate: DataFrame, plugin: str) -> DataFrame:
    return candidate.where(F.col("plugin") == plugin).orderBy(F.desc("score"), "fqdn")


def by_platform(tenant: DataFrame, platform: str) -> DataFrame:
    return tenant.where((F.col("platform") == platform) & (F.size("plugins_proposes") > 0)).orderBy("tenant", "fqdn")
