"""Why pairs of host and plugin are proposed, verdicts on them, and pseudonyms for reports."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import PIVOTS
from .classify import Steps
from .domains import Params
from .stable import stable


_PIVOT = ["pivot_type", "id_pivot"]


def _surroundings(link: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(of_hosts, around): what hosts link to (id_fqdn, kind, id), and hosts and plugins around each pivot; the links are read twice in all."""
    others = [p for p in PIVOTS if p != "fqdn"]
    of_hosts = stable(link.where((F.col("type_1") == "fqdn") & F.col("type_2").isin(*PIVOTS, "plugin")).select(F.col("id_1").alias("id_fqdn"), F.col("type_2").alias("kind"), F.col("id_2").alias("id")).distinct())
    ends = link.where(F.col("type_1").isin(*others) & F.col("type_2").isin("fqdn", "plugin")).select(F.col("type_1").alias("pivot_type"), F.col("id_1").alias("id_pivot"), F.col("type_2").alias("kind"), F.col("id_2").alias("id")).distinct()
    hosts = of_hosts.where("kind in ('fqdn', 'plugin')").select(F.lit("fqdn").alias("pivot_type"), F.col("id_fqdn").alias("id_pivot"), "kind", "id")
    return of_hosts, stable(ends.unionByName(hosts))


def explain_pivots(hosts: DataFrame, link: DataFrame, params: Params = Params()) -> DataFrame:
    """(id_fqdn, pivot_type, id_pivot, degree, id_plugin, n, total, purity, direct, kept, top) of all pivots of many hosts.

    Votes leave the host's own ones out. A pivot above the largest degree gets no votes: one row with a null plugin.
    top lists the pivot's three plugins with most votes.

    A pivot's votes are counted once, into one row with a map by plugin that its degree bounds; each of its hosts takes
    its own plugins out of that map, so no row is widened before it is known to count.
    """
    of_hosts, around = _surroundings(link)
    near = of_hosts.where("kind <> 'plugin'").join(hosts.select("id_fqdn").distinct(), "id_fqdn", "left_semi").select("id_fqdn", F.col("kind").alias("pivot_type"), F.col("id").alias("id_pivot"))
    plugins = of_hosts.where("kind = 'plugin'").select("id_fqdn", F.col("id").alias("id_plugin"))
    degree = stable(around.where("kind = 'fqdn'").join(near.select(*_PIVOT).distinct(), _PIVOT, "left_semi").groupBy(*_PIVOT).agg(F.count("id").alias("degree")))
    small = degree.where(F.col("degree") <= params.max_degree)
    members = around.where("kind = 'fqdn'").join(small.select(*_PIVOT), _PIVOT, "left_semi").select(*_PIVOT, F.col("id").alias("id_fqdn"))
    counted = members.join(plugins, "id_fqdn").groupBy(*_PIVOT, "id_plugin").agg(F.count("id_fqdn").alias("n"))
    votes = counted.groupBy(*_PIVOT).agg(F.map_from_entries(F.collect_list(F.struct("id_plugin", "n"))).alias("votes"))
    linked = around.where("kind = 'plugin'").groupBy(*_PIVOT).agg(F.collect_set("id").alias("linked"))
    none = F.array().cast("array<bigint>")
    pivots = small.join(votes, _PIVOT, "left").join(linked, _PIVOT, "left")
    rows = near.join(pivots, _PIVOT).join(plugins.groupBy("id_fqdn").agg(F.collect_set("id_plugin").alias("own")), "id_fqdn", "left")
    left = F.transform_values("votes", lambda p, n: n - F.coalesce(F.array_contains("own", p), F.lit(False)).cast("bigint"))
    rows = rows.withColumn("linked", F.coalesce("linked", none)).withColumn("left", F.coalesce(F.filter(F.map_entries(left), lambda e: e["value"] > 0), F.array().cast("array<struct<key: bigint, value: bigint>>")))
    order = F.array_sort(F.transform("left", lambda e: F.named_struct(F.lit("m"), -e["value"], F.lit("id_plugin"), e["key"])))
    top = F.transform(F.slice(order, 1, 3), lambda e: F.named_struct(F.lit("id_plugin"), e["id_plugin"], F.lit("n"), -e["m"]))
    total = F.aggregate("left", F.lit(0).cast("bigint"), lambda a, e: a + e["value"])
    named = F.array_union("linked", F.transform("left", lambda e: e["key"]))
    rows = rows.select("id_fqdn", *_PIVOT, "degree", "linked", F.map_from_entries("left").alias("left"), total.alias("total"), top.alias("top"), F.explode(named).alias("id_plugin"))
    rows = rows.withColumns({"n": F.coalesce(F.try_element_at("left", F.col("id_plugin")), F.lit(0).cast("bigint")), "direct": F.array_contains("linked", F.col("id_plugin"))})
    rows = rows.withColumn("purity", F.when(F.col("total") == 0, 1.0).otherwise(F.try_divide("n", "total")))
    trusted = F.col("direct") & ((F.col("total") == 0) | (F.col("purity") >= params.guard_purity))
    kept = trusted | ((F.col("n") >= params.min_votes) & (F.col("purity") >= params.min_purity))
    rows = rows.select("id_fqdn", *_PIVOT, "degree", "id_plugin", "n", "total", "purity", "direct", kept.alias("kept"), "top")
    hubs = near.join(degree.where(F.col("degree") > params.max_degree), _PIVOT).select("id_fqdn", *_PIVOT, "degree")
    return rows.unionByName(hubs.withColumns({"direct": F.lit(False), "kept": F.lit(False)}), allowMissingColumns=True)


def pivot_detail(pivots: DataFrame, pairs: DataFrame, limit: int = 30) -> DataFrame:
    """The first pivots of each pair for its plugin: kept, direct, most votes and small degree first."""
    own = Window.partitionBy("id_fqdn", "id_plugin").orderBy(F.desc("kept"), F.desc("direct"), F.desc("n"), "degree", "pivot_type", "id_pivot")
    return pivots.join(pairs.select("id_fqdn", "id_plugin").distinct(), ["id_fqdn", "id_plugin"], "left_semi").withColumn("place", F.row_number().over(own)).where(F.col("place") <= limit)


def competition(pivots: DataFrame, classified: DataFrame, anc: DataFrame, tenant: DataFrame, params: Params = Params(), limit: int = 15) -> DataFrame:
    """(id_fqdn, id_plugin, signals, score, place, tie) of the plugins that a host's kept pivots and tenant name propose.

    classified is (id_fqdn, id_plugin), tenant (id_fqdn, id_plugin). tie: the two best scores are equal, so none is taken.
    """
    keys = ["id_fqdn", "id_plugin"]
    inherited = anc.select("id_fqdn", F.explode("plugins").alias("id_plugin"))
    said = pivots.where("kept").select(*keys, F.col("pivot_type").alias("signal")).join(inherited, keys, "left_anti").unionByName(tenant.select(*keys, F.lit("tenant").alias("signal")))
    said = said.join(classified, keys, "left_anti").distinct()
    weights = F.create_map(*[F.lit(x) for pair in params.weights.items() for x in pair])
    rows = said.groupBy(*keys).agg(F.array_sort(F.collect_set("signal")).alias("signals"), F.sum(F.coalesce(F.try_element_at(weights, F.col("signal")), F.lit(0))).alias("score")).where(F.col("score") >= params.min_score)
    by = Window.partitionBy("id_fqdn")
    rows = rows.withColumn("place", F.row_number().over(by.orderBy(F.desc("score"), "id_plugin"))).withColumn("best", F.max("score").over(by))
    rows = rows.withColumn("tie", F.count_if(F.col("score") == F.col("best")).over(by) > 1)
    return rows.where(F.col("place") <= limit).select(*keys, "signals", "score", "place", "tie")


def explain_pairs(pairs: DataFrame, s: Steps, candidate: DataFrame) -> DataFrame:
    """One row a pair (id_fqdn, id_plugin): linked plugins, ancestor, inherited plugins, whether it is a platform, tenant, and the candidate row if there is one."""
    from .domains import own_plugins

    none = F.array().cast("array<bigint>")
    anc = s.anc.select("id_fqdn", "anchor", F.col("plugins").alias("inherited"), "tenant", "brand", "brand_plugins")
    platform = s.stats.join(s.platform.withColumn("is_platform", F.lit(True)), "anchor", "left").drop("plugins")
    rows = pairs.select("id_fqdn", "id_plugin").distinct().join(own_plugins(s.classified), "id_fqdn", "left").join(anc, "id_fqdn", "left").join(platform, "anchor", "left")
    cand = candidate.select("id_fqdn", "id_plugin", "status", "score", "signals", "nb_pivots")
    rows = rows.join(cand, ["id_fqdn", "id_plugin"], "left")
    return rows.withColumns({"own": F.coalesce("own", none), "inherited": F.coalesce("inherited", none), "is_platform": F.coalesce("is_platform", F.lit(False)), "proposed": F.col("status").isNotNull()})


def sample_groups(df: DataFrame, groups: list[str | Column], keys: list[str], k: int, seed: int = 0) -> DataFrame:
    """At most k rows of each group, by a seeded hash of the keys."""
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in keys]).cast("binary"))
    own = Window.partitionBy(*groups).orderBy(order, *keys)
    return df.withColumn("_n", F.row_number().over(own)).where(F.col("_n") <= k).drop("_n")


def sample_candidates(candidate: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """(fqdn, plugin, status, score, signals, verdict, commentaire): at most k of each status and set of signals, for review."""
    rows = candidate.withColumn("signals", F.array_join(F.array_sort("signals"), "+"))
    blank = F.lit("")
    return sample_groups(rows, ["status", "signals"], ["fqdn", "plugin"], k, seed).select("fqdn", "plugin", "status", "score", "signals", blank.alias("verdict"), blank.alias("commentaire"))


def clean_verdicts(rows: DataFrame) -> DataFrame:
    """(fqdn, plugin, verdict, commentaire), trimmed, verdicts in capitals, rows without host or plugin dropped."""
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    out = rows.select(text("fqdn").alias("fqdn"), text("plugin").alias("plugin"), F.upper(text("verdict")).alias("verdict"), text("commentaire").alias("commentaire"))
    return out.where("fqdn <> '' and plugin <> ''")


def judged_pairs(verdicts: DataFrame) -> DataFrame:
    """The rows with a verdict of any kind; all rows if there are none, so that a fresh sample can be explained too."""
    judged = verdicts.where("verdict <> ''")
    return judged if judged.head(1) else verdicts


def verdict_report(verdicts: DataFrame, candidate: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(totals, changed, by_signal) of OK and KO verdicts against the present candidates.

    totals: verdict, judged, still, gone, precision (of those still proposed, on both rows). changed: pairs
    judged KO still proposed, or OK and no longer. by_signal: scope (signal or combination), signals, ok, ko, precision.
    """
    have = candidate.select("fqdn", "plugin", "signals").withColumn("proposed", F.lit(True))
    rows = verdicts.where("verdict in ('OK', 'KO')").join(have, ["fqdn", "plugin"], "left").withColumn("proposed", F.coalesce("proposed", F.lit(False)))
    still = F.count_if("proposed")
    totals = rows.groupBy("verdict").agg(F.count(F.lit(1)).alias("judged"), still.alias("still"), F.count_if(~F.col("proposed")).alias("gone"))
    precision = rows.where("proposed").agg(F.try_divide(F.count_if(F.col("verdict") == "OK"), F.count(F.lit(1))).alias("precision"))
    changed = rows.where((F.col("verdict") == "KO") == F.col("proposed")).select("verdict", "fqdn", "plugin")
    combo = F.coalesce(F.array_join(F.array_sort("signals"), "+"), F.lit("none"))
    scopes = rows.select("verdict", F.lit("combination").alias("scope"), combo.alias("signals")).unionByName(rows.select("verdict", F.lit("signal").alias("scope"), F.explode(F.coalesce("signals", F.array(F.lit("none")))).alias("signals")))
    by_signal = scopes.groupBy("scope", "signals").agg(F.count_if(F.col("verdict") == "OK").alias("ok"), F.count_if(F.col("verdict") == "KO").alias("ko"))
    return totals.crossJoin(precision), changed, by_signal.withColumn("precision", F.try_divide("ok", F.col("ok") + F.col("ko")))


def alias(column: Column, kind: str, length: int) -> Column:
    return F.concat(F.lit(f"{kind}_"), F.substring(F.sha1(column.cast("binary")), 1, length))


class _Fold(dict):
    """Characters as names are compared: in lower case, one for one."""

    def __missing__(self, code: int) -> str:
        one = chr(code).casefold()
        self[code] = one if len(one) == 1 else chr(code)
        return self[code]


# Letters whose simple lower case is another letter than casefold's.
_FOLD = _Fold({0x130: "i", 0x131: "i"})


def folded(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_FOLD)


def variants(names: DataFrame, max_names: int = 200_000) -> dict[str, str]:
    """Each name variant's pseudonym.

    names has a column name; the pseudonym is made of the name as it is written. Variants are the lower-case name
    and the same without separators; one that several names share stands for the shortest (of equal ones the
    first in order). ValueError above max_names, which bounds what is sent to tasks.
    """
    rows = names.select("name").where("name <> ''").distinct().select("name", alias(F.col("name"), "plugin", 6).alias("alias")).limit(max_names + 1).collect()
    if len(rows) > max_names:
        raise ValueError(f"more than {max_names} names")
    out: dict[str, str] = {}
    for name, masked in sorted(map(tuple, rows), key=lambda r: (len(r[0]), r[0])):
        for variant in (folded(name), re.sub(r"[^0-9a-z]", "", name.lower())):
            if variant:
                out.setdefault(variant, masked)
    return out


class Masker:
    """Finds all names in one pass over a text: a trie of the variants with failure links.

    Of the matches the leftmost counts, of those that start together the longest. Variants under four characters count
    between separators only.
    """

    def __init__(self, masks: dict[str, str]) -> None:
        import ahocorasick

        self._trie = ahocorasick.Automaton()
        for variant, masked in masks.items():
            self._trie.add_word(variant, (len(variant), masked))
        if masks:
            self._trie.make_automaton()
        self._empty = not masks

    def mask(self, text: str) -> str:
        if self._empty or not text:
            return text
        seen = folded(text)
        found = []
        for end, (n, masked) in self._trie.iter(seen):
            start = end - n + 1
            if n >= 4 or not (start and _LETTER.match(seen[start - 1]) or end + 1 < len(seen) and _LETTER.match(seen[end + 1])):
                found.append((start, -n, masked))
        out, at = [], 0
        for start, n, masked in sorted(found):
            if start >= at:
                out += [text[at:start], masked]
                at = start - n
        return "".join([*out, text[at:]]) if out else text


_LETTER = re.compile("[0-9a-z]")


def pseudonymise(df: DataFrame, columns: list[str], names: DataFrame) -> DataFrame:
    """df with the names in its text columns masked; null stays null. The time is in proportion to the text, however many names."""
    shared = df.sparkSession.sparkContext.broadcast(variants(names))

    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Masker(shared.value)  # once a task
        for texts in batches:
            yield texts.map(lambda t: t if t is None else own.mask(t))

    masked = F.pandas_udf(mask, "string")
    return df.withColumns({c: masked(F.col(c)) for c in columns})


def pseudonymise_values(df: DataFrame, names: DataFrame, kind: str = "pivot_type", value: str = "value") -> DataFrame:
    """df with its typed values masked as a report shows them: captures by an alias, applications as they are, names in all others."""
    masked = pseudonymise(df.withColumn("_plain", F.col(value)), [value], names)
    shown = F.when(F.col(kind) == "application", F.col("_plain")).when(F.col(kind) == "capture", alias(F.col("_plain"), "capture", 8)).otherwise(F.col(value))
    return masked.withColumn(value, shown).drop("_plain")


def mapping_table(names: DataFrame) -> DataFrame:
    """(name, alias) of all names, to read a masked report by."""
    return names.select("name").where("name <> ''").distinct().select("name", alias(F.col("name"), "plugin", 6).alias("alias"))
