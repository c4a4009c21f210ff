"""URL filtering by rules and by empirical-Bayes host reputation, in DataFrame operations alone.

A url's host is what follows its first "://" up to "/", "?", "#" or the end,
with A-Z lower-cased; its path goes on up to "?", "#" or the end. A rule (host,
path, verdict) fits its host and all subdomains where the path starts with the
rule's; the longest fitting rule decides. Elsewhere the host's reputation does.

Reputation: labelled pages (1: bad) are counted by host. Bad rates are shrunk
from the whole to the suffix, from there to the registered domain, and from
there to the host: at each level a group's prior is a beta distribution whose
mean is its parent's posterior mean and whose strength is that level's
overdispersion, by the method of moments for beta-binomial counts. A host is
blocked where the lower bound of its posterior (mean less `z` standard
deviations) is above `max_bad`. A host without labels is judged by its prior: the
mean is that of its nearest labelled ancestor (registered domain, suffix or the
whole), the variance that of the unlabelled levels below it taken together.

The suffix is a host's last label, or its last two where these are in `suffixes` (such
as "co.uk"; a list of public suffixes is the caller's to give); the registered
domain has one label more.

Defined results: a null url, or one without "://", has an empty host and path,
fits no rule and is allowed (there is no host to judge); repeated rows are
judged each; labels that are null don't count; a page with several labels counts
once per label; an empty label table allows every page that no rule blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookflow.llm.common import staged

#: (host, path, verdict)
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))

#: A host is blocked where even the posterior's lower bound (z standard deviations below its mean) is worse than this share of bad pages.
MAX_BAD, Z = 0.5, 1.645

#: A prior's strength in pages: its least and greatest value.
STRENGTH = (2.0, 1000.0)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """(the longest fitting rule's host and path as one string, its verdict), null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, what in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name, verdict = F.when(fits, rule_host + rule_path).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def domain_of(host: Column, suffixes: tuple[str, ...] = ()) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), F.substring_index(host, ".", -3)).otherwise(two) if suffixes else two


def suffix_of(host: Column, suffixes: tuple[str, ...] = ()) -> Column:
    one, two = F.substring_index(host, ".", -1), F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), two).otherwise(one) if suffixes else one


def _shrunk(groups: DataFrame, parents: DataFrame, key: str, parent: str) -> DataFrame:
    """Adds each group's posterior parameters: (key, n, bad, mean, strength), from its parent's mean."""
    joined = groups.join(parents.select(parent, F.col("mean").alias("prior")), parent)
    n, m = F.col("n").cast("double"), F.col("prior")
    spread = n * (F.col("bad") / n - m) * (F.col("bad") / n - m)
    moments = joined.agg(F.sum(spread).alias("seen"), F.sum(m * (1 - m)).alias("binomial"), F.sum(m * (1 - m) * (n - 1)).alias("over"))
    rho = F.when(F.col("over") > 0, (F.col("seen") - F.col("binomial")) / F.col("over")).otherwise(F.lit(0.0))
    low, high = STRENGTH
    strength = F.greatest(F.lit(low), F.least(F.lit(high), F.when(rho > 0, 1 / rho - 1).otherwise(F.lit(high))))
    return joined.crossJoin(F.broadcast(moments.select(strength.alias("strength")))).select(  # one row
        *groups.columns, F.col("strength"), ((F.col("prior") * F.col("strength") + F.col("bad")) / (F.col("strength") + n)).alias("mean"))


def _bound(mean: Column, share: Column) -> Column:
    """Z standard deviations below the mean; share: the variance as a share of mean * (1 - mean)."""
    return mean - Z * F.sqrt(mean * (1 - mean) * share)


def _below(strength: Column, share: Column) -> Column:
    """The variance share of a group two levels down: its parent, unlabelled, is beta with `strength`, and share is the group's under a known parent."""
    return 1 / (strength + 1) + strength / (strength + 1) * share


def reputations(labelled: DataFrame, suffixes: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(host, n, bad, mean, bound) for every host of labelled (host, bad), bad being 0 or 1; and the bounds that unlabelled hosts have below
    each labelled domain (domain, bound), suffix (suffix, bound) and the whole (bound: one row, or none without labels).

    The three levels are small sums of per-host counts; only those are shuffled. Each is written
    once, as the levels below it and the bounds read it again.
    """
    hosts = labelled.where(F.col("bad").isNotNull() & (F.col("host") != "")).groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    hosts = staged(hosts.withColumn("domain", domain_of(F.col("host"), suffixes)).withColumn("suffix", suffix_of(F.col("host"), suffixes)), "host-counts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("all", F.lit(0))
    whole = suffixes.groupBy("all").agg(((F.sum("bad") + 1.0) / (F.sum("n") + 2.0)).alias("mean"))
    by_suffix = staged(_shrunk(suffixes, whole, "suffix", "all"), "by-suffix")
    by_domain = staged(_shrunk(domains, by_suffix, "domain", "suffix"), "by-domain")
    by_host = staged(_shrunk(hosts, by_domain, "host", "domain"), "by-host")
    weight = F.col("strength") + F.col("n")
    # one row: the strength of each level
    levels = [level.agg(F.first("strength").alias(name)) for level, name in ((by_host, "of_host"), (by_domain, "of_domain"), (by_suffix, "of_suffix"))]
    strengths = F.broadcast(levels[0].crossJoin(levels[1]).crossJoin(levels[2]))
    below_domain = 1 / (F.col("of_host") + 1)
    below_suffix = _below(F.col("of_domain"), below_domain)
    below_whole = _below(F.col("of_suffix"), below_suffix)
    mean = F.col("mean")
    return (
        by_host.select("host", "n", "bad", "mean", _bound(mean, 1 / (weight + 1)).alias("bound")),
        by_domain.crossJoin(strengths).select("domain", _bound(mean, below_domain).alias("bound")),
        by_suffix.crossJoin(strengths).select("suffix", _bound(mean, below_suffix).alias("bound")),
        whole.crossJoin(strengths).select(_bound(mean, below_whole).alias("bound")),
    )


def judge_urls(pages: DataFrame, labelled: DataFrame, *, id_col: str = "page_id", url_col: str = "url", rules: tuple[tuple[str, str, str], ...] = RULES, max_bad: float = MAX_BAD, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """(page_id, host, path, rule, verdict, bad_bound) for every row of pages; labelled: (page_id, bad).

    The join of pages with reputations is on the host: a host with a third of all
    pages is split by Spark's skew join, and its counts are summed before a shuffle.
    Levels above it are joined with distinct hosts.
    """
    urls = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    marks = labelled.select(F.col("page_id").alias("labelled_id"), "bad").where(F.col("bad").isNotNull())
    known = urls.join(marks, urls["page_id"] == marks["labelled_id"]).select("host", "bad")
    by_host, by_domain, by_suffix, whole = reputations(known, suffixes)
    hosts = urls.where(F.col("host") != "").select("host").distinct()
    hosts = hosts.withColumn("domain", domain_of(F.col("host"), suffixes)).withColumn("suffix", suffix_of(F.col("host"), suffixes))
    levels = hosts.join(by_host.select("host", F.col("bound").alias("of_host")), "host", "left")
    levels = levels.join(by_domain.withColumnRenamed("bound", "of_domain"), "domain", "left").join(by_suffix.withColumnRenamed("bound", "of_suffix"), "suffix", "left")
    judged = levels.join(F.broadcast(whole.select(F.col("bound").alias("of_whole"))), how="left").select("host", F.coalesce("of_host", "of_domain", "of_suffix", "of_whole").alias("bad_bound"))  # one row
    bounds = judged.where(F.col("bad_bound") > max_bad)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bad_bound").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return urls.join(bounds, "host", "left").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "bad_bound")
