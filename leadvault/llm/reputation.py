"""URL filters: explicit host and path rules, and empirical-Bayes host reputation where no rule fits.

Reputation: labelled page outcomes give each host, registered domain and suffix its number of bad pages.
Each level's rate is shrunk to its parent's through a beta-binomial prior whose strength comes from the data
(moments over all groups of that level). A host is blocked if the lower bound of its posterior bad rate is above that of all
pages (or a given rate): it is worse than the web at large, and not by chance. Hosts without outcomes have their domain's,
suffix's or the global prior."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadvault.llm.common import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Suffixes of two labels, under which a registered domain has three: these before a country's two letters. Fixed values.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gob", "gov", "go", "ltd", "mil", "ne", "net", "nom", "or", "org", "plc")
#: A host is blocked if mean - WIDTH deviations of its bad rate exceeds the threshold.
WIDTH = 1.645


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or end, A-Z lower-cased; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Number of the longest of `rules` (verdict, host, path) that fits, else null. A rule fits its host and all
    subdomains, where the path starts with the rule's."""
    def fits(rule):
        _, name, prefix = rule
        return ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(prefix))

    ranked = sorted(range(len(rules)), key=lambda k: (-len(rules[k][1] + rules[k][2]), k))
    return F.coalesce(*[F.when(fits(rules[k]), F.lit(k)) for k in ranked]) if ranked else F.lit(None).cast("int")


def site_of(host: Column) -> Column:
    """The host without user info, port and final dot."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"(?::[0-9]*)?$|\.(?::[0-9]*)?$", "")


def _is_address(site: Column) -> Column:
    return site.rlike(r"^[0-9]+(\.[0-9]+){3}$") | site.startswith("[")


def suffix_of(site: Column, second_level: tuple = SECOND_LEVEL) -> Column:
    """The last label, or two of them under a country's second level; an address is its own suffix."""
    two = F.regexp_extract(site, rf"(?:^|\.)((?:{'|'.join(second_level)})\.[a-z][a-z])$", 1)
    return F.when(_is_address(site), site).when(two != "", two).otherwise(F.regexp_extract(site, r"([^.]*)$", 1))


def domain_of(site: Column, second_level: tuple = SECOND_LEVEL) -> Column:
    """The suffix and the label before it; the site itself where it has no more, and an address."""
    labels = F.split(site, r"\.")
    count = F.size(F.split(suffix_of(site, second_level), r"\.")) + 1
    return F.when(_is_address(site) | (F.size(labels) <= count), site).otherwise(
        F.array_join(F.slice(labels, F.size(labels) - count + 1, count), "."))


def _strength(groups: DataFrame) -> float:
    """The prior's weight in pages, by moments: how far the groups' bad counts k of n scatter beyond a binomial
    of their parent's rate. `groups` has n, k and prior."""
    plain = F.col("prior") * (1 - F.col("prior"))
    extra, room = groups.agg(F.sum((F.col("k") - F.col("n") * F.col("prior")) ** 2 - F.col("n") * plain),
                             F.sum(F.col("n") * (F.col("n") - 1) * plain)).first()
    spread = min(0.9, max(0.001, extra / room)) if extra is not None and room else 0.5
    return 1 / spread - 1


def reputations(outcomes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, tuple]:
    """Posterior (alpha, beta) of the bad rate per host, per domain and per suffix, and globally, from `outcomes`
    (host, bad 0 / 1; rows with null bad teach nothing)."""
    told = outcomes.where("bad is not null and host is not null").select(site_of(F.col("host")).alias("host"), "bad")
    hosts = told.groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("k")).withColumns(
        {"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    hosts = stored(outcomes.sparkSession, hosts, "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    n, k = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("k"), F.lit(0))).first()
    top = (k + 1.0, n - k + 1.0)

    def shrunk(groups: DataFrame, prior: Column) -> DataFrame:
        with_prior = groups.withColumn("prior", prior)
        weight = _strength(with_prior)
        return with_prior.withColumn("alpha", F.col("prior") * weight + F.col("k")).withColumn(
            "beta", (1 - F.col("prior")) * weight + F.col("n") - F.col("k")).withColumn("weight", F.lit(weight))

    def mean(level):
        return F.col(f"{level}.alpha") / (F.col(f"{level}.alpha") + F.col(f"{level}.beta"))

    suffixes = shrunk(suffixes, F.lit(top[0] / (top[0] + top[1]))).select("suffix", "alpha", "beta", "weight")
    domains = shrunk(domains.join(suffixes.select("suffix", F.struct("alpha", "beta").alias("up")), "suffix"),
                     mean("up")).select("domain", "alpha", "beta", "weight")
    hosts = shrunk(hosts.join(domains.select("domain", F.struct("alpha", "beta").alias("up")), "domain"),
                   mean("up")).select("host", "alpha", "beta", "weight")
    return hosts, domains, suffixes, top


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], outcomes: DataFrame, width: float = WIDTH,
          bad_rate: float | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, bad_mean, bad_low) for every row of `pages` (page_id, url, others
    ignored). verdict is the longest fitting rule's, else `block` where bad_low > bad_rate (by default the
    bad rate of all outcomes), else `allow`. Reputations know a host without user info and port; an address is a site of its
    own. A null url, or one without `://`, has empty host and path and is judged as the host ''; repeated rows are judged
    alike; without outcomes the global prior is even and nothing is blocked."""
    hosts, domains, suffixes, top = reputations(outcomes)
    bad_rate = top[0] / (top[0] + top[1]) if bad_rate is None else bad_rate
    cut = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    cut = cut.withColumn("_site", site_of(F.col("host")))
    cut = cut.withColumns({"_domain": domain_of(F.col("_site")), "_suffix": suffix_of(F.col("_site")),
                           "_rule": best_rule(F.col("host"), F.col("path"), rules)})
    levels = [(hosts, "host", "_site"), (domains, "domain", "_domain"), (suffixes, "suffix", "_suffix")]
    for k, (level, key, own) in enumerate(levels):
        found = level.select(F.col(key).alias(f"_key{k}"), F.struct("alpha", "beta", "weight").alias(f"_p{k}"))
        cut = cut.join(found, F.col(own) == F.col(f"_key{k}"), "left").drop(f"_key{k}")

    # A level without outcomes of its own passes its parent's rate on, at the weight of a prior.
    known = F.coalesce(*[F.col(f"_p{k}") for k in range(3)])
    rate = F.coalesce(known["alpha"] / (known["alpha"] + known["beta"]), F.lit(top[0] / (top[0] + top[1])))
    own = F.col("_p0").isNotNull()
    weight = F.when(own, F.col("_p0.alpha") + F.col("_p0.beta")).otherwise(F.coalesce(known["weight"], F.lit(2.0)))
    low = rate - width * F.sqrt(rate * (1 - rate) / (weight + 1))
    texts = F.array(*[F.lit(h + p) for _, h, p in rules]) if rules else F.array(F.lit(None).cast("string"))
    says = F.array(*[F.lit(v) for v, _, _ in rules]) if rules else texts
    return cut.withColumns({"bad_mean": rate, "bad_low": low}).select(
        "page_id", "host", "path", F.get(texts, F.col("_rule")).alias("rule"),
        F.coalesce(F.get(says, F.col("_rule")), F.when(F.col("bad_low") > bad_rate, "block").otherwise("allow")).alias("verdict"),
        "bad_mean", "bad_low")
