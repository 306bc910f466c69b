"""URL filter: rules of hosts and paths, and empirical-Bayes reputation where no rule fits.

Labelled pages are Bernoulli outcomes of their host. The share of good pages of a host is shrunk towards that of its
registered domain, that towards its public suffix, that towards all pages. Each level has a beta-binomial prior whose
strength is estimated from the spread of its own groups (method of moments), so groups with few labels stay near their
parent and groups with many speak for themselves. A page without a rule is allowed when the lower posterior bound of its
host reaches a threshold.

Outcomes are summed before they are shuffled, one row per host; a table of hosts goes back to the pages by a measured
broadcast or a salted join, so a host that has a third of all pages is spread over tasks. Only columns in use are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenlake.llm.common import table
from tokenlake.operators.skew import join_groups
from tokenlake.workspace import Workspace

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"
# Public suffixes of two labels; of other hosts the last label is the suffix.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "co.nz", "com.br", "co.in", "co.za")
ADDRESS = r"^[0-9.]+$|^\["
# Standard deviations below the posterior mean, and the share of good pages that must be reached there.
DEVIATIONS = 1.645
LEAST_GOOD = 0.7
# Bounds on the correlation of outcomes within a group, and its value where no group has two outcomes.
CORRELATION = (0.002, 0.5)
UNKNOWN_CORRELATION = 0.05


@dataclass(frozen=True)
class UrlRule:
    """``verdict`` for hosts that are ``host`` or below it, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a NULL or an url without ``://``."""
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, PARTS, 1), UPPER, LOWER), F.regexp_extract(text, PARTS, 2)


def first_rule(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """(text, verdict) of the longest rule that fits, else NULL; of equally long ones the first as text.

    Rules are a short list that becomes one expression.
    """
    fitting = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text), reverse=True):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        fitting = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(fitting)
    return fitting


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """Registered domain and public suffix of a host, without its port; an address is its own."""
    bare = F.regexp_replace(host, ":[0-9]*$", "")
    labels = F.split(bare, r"\.")
    last = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".")
    n = F.when(last.isin(*TWO_LABEL_SUFFIXES), 2).otherwise(1)

    def end(k: Column) -> Column:
        return F.array_join(F.slice(labels, F.greatest(F.size(labels) - k, F.lit(0)) + 1, k), ".")

    return tuple(F.when(bare.rlike(ADDRESS), bare).otherwise(end(k)) for k in (n + 1, n))


def prior_strength(groups: DataFrame) -> float:
    """Pseudo-outcomes of the prior, from (n, k, mu) of all groups of a level. One row comes to the driver."""
    n, k, mu = F.col("n"), F.col("k"), F.col("mu")
    spread = mu * (1 - mu)
    row = groups.agg(
        F.sum((k - n * mu) * (k - n * mu) - n * spread).alias("excess"), F.sum(n * (n - 1) * spread).alias("pairs")
    ).first()
    rho = row["excess"] / row["pairs"] if row["pairs"] else UNKNOWN_CORRELATION
    rho = min(max(rho, CORRELATION[0]), CORRELATION[1])
    return (1 - rho) / rho


def host_reputation(hosts: DataFrame) -> DataFrame:
    """(host, n, good, mean, bound) from one row (host, n, k) per host: labelled pages and good ones."""
    work = Workspace(hosts.sparkSession, "reputation")
    domain, suffix = domain_and_suffix(F.col("host"))
    hosts = work.save(hosts.select("host", "n", "k", domain.alias("domain"), suffix.alias("suffix")), "hosts")
    domains = work.save(hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "domains")
    suffixes = work.save(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "suffixes")
    everything = suffixes.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    overall = ((everything["k"] or 0) + 1) / ((everything["n"] or 0) + 2)

    def shrunk(groups: DataFrame) -> tuple[DataFrame, float]:
        strength = prior_strength(groups)
        return groups.withColumn("mean", (strength * F.col("mu") + F.col("k")) / (strength + F.col("n"))), strength

    def parents(groups: DataFrame, key: str) -> DataFrame:
        return groups.select(key, F.col("mean").alias("mu"))

    suffixes, _ = shrunk(suffixes.withColumn("mu", F.lit(overall)))
    domains, _ = shrunk(work.save(join_groups(domains, parents(suffixes, "suffix"), ["suffix"]), "domain-priors"))
    hosts, strength = shrunk(work.save(join_groups(hosts, parents(domains, "domain"), ["domain"]), "host-priors"))
    mean, seen = F.col("mean"), strength + F.col("n")
    bound = mean - DEVIATIONS * F.sqrt(mean * (1 - mean) / (seen + 1))
    return hosts.select("host", "n", F.col("k").alias("good"), "mean", bound.alias("bound"))


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[UrlRule] = RULES,
    key: str = "page_id",
    url_col: str = "url",
    least_good: float = LEAST_GOOD,
) -> DataFrame:
    """(key, host, path, rule, verdict, bound): one row per page.

    ``outcomes`` has rows (key, good 0 or 1). A page takes part with every outcome of its key; outcomes that are NULL or
    have no page count nothing, pages without a key have none. Hosts without any outcome get the bound of their domain's
    prior. Pages without a host (NULL, empty, no ``://``) share the empty host. Repeated pages give repeated rows, an
    empty table none; urls of any length are judged whole. Other columns are not read, whatever their names.
    """
    work = Workspace(pages.sparkSession, "url-filter")
    host, path = host_and_path(F.col(url_col))
    parsed = pages.select(F.col(key).alias("page"), host.alias("host"), path.alias("path"))
    good = F.col("good").cast("long")
    labelled = (
        outcomes.select(F.col(key).alias("page"), "good")
        .filter("page IS NOT NULL AND good IS NOT NULL")
        .groupBy("page")
        .agg(F.count("good").alias("n"), F.sum(good).alias("k"))
    )
    seen = join_groups(parsed.select("page", "host"), labelled, ["page"]).select("host", "n", "k")
    every = parsed.select("host", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("k"))
    hosts = seen.unionByName(every).groupBy("host").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    reputation = work.save(host_reputation(hosts).select("host", "bound"), "bounds")
    judged = join_groups(parsed, reputation, ["host"])
    fitting = first_rule(F.col("host"), F.col("path"), rules)
    earned = F.when(F.col("bound") >= least_good, "allow").otherwise("block")
    return judged.withColumn("fitting", fitting).select(
        F.col("page").alias(key),
        "host",
        "path",
        F.col("fitting.text").alias("rule"),
        F.coalesce("fitting.verdict", earned).alias("verdict"),
        "bound",
    )


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: host, path, rule, verdict, posterior bound. A page is labelled by the quality of the document of its id."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return filter_urls(pages, labels).withColumn("bound", F.round("bound", 6))


def _sql_level(name: str, source: str, mu: str) -> str:
    """Common table expressions ``<name>_s`` (strength of the prior) and ``<name>_m`` (shrunk means) over (n, k, mu)."""
    low, high = CORRELATION
    return f"""{name}_mu AS (SELECT g.*, {mu} AS mu FROM {source}),
{name}_rho AS (
    SELECT least({high}, greatest({low}, coalesce(
        sum((k - n * mu) * (k - n * mu) - n * mu * (1 - mu)) / nullif(sum(n * (n - 1) * mu * (1 - mu)), 0), {UNKNOWN_CORRELATION}))) AS rho
    FROM {name}_mu),
{name}_m AS (SELECT m.*, (1 - rho) / rho AS s, ((1 - rho) / rho * mu + k) / ((1 - rho) / rho + n) AS mean FROM {name}_mu m, {name}_rho)"""


_TWO = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
_CASES = "\n".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN {{'text': '{r.text}', 'verdict': '{r.verdict}'}}"
    for r in sorted(RULES, key=lambda r: (-len(r.text), r.text))
)
ORACLE = rf"""
WITH parsed AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{PARTS}', 1), '{UPPER}', '{LOWER}') AS host,
           regexp_extract(coalesce(url, ''), '{PARTS}', 2) AS path
    FROM pages
), labelled AS (
    SELECT doc_id AS page_id, count(quality) AS n, sum(quality) AS k FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), hosts AS (
    SELECT host, coalesce(sum(n), 0)::double AS n, coalesce(sum(k), 0)::double AS k FROM parsed LEFT JOIN labelled USING (page_id) GROUP BY host
), bare AS (SELECT *, regexp_replace(host, ':[0-9]*$', '') AS b FROM hosts
), cut AS (SELECT *, string_split(b, '.') AS ls FROM bare
), sized AS (SELECT *, CASE WHEN array_to_string(ls[greatest(len(ls) - 1, 1):], '.') IN ({_TWO}) THEN 2 ELSE 1 END AS c FROM cut
), named AS (
    SELECT host, n, k, CASE WHEN regexp_matches(b, '{ADDRESS}') THEN b ELSE array_to_string(ls[greatest(len(ls) - c - 1, 0) + 1:], '.') END AS domain,
           CASE WHEN regexp_matches(b, '{ADDRESS}') THEN b ELSE array_to_string(ls[greatest(len(ls) - c, 0) + 1:], '.') END AS suffix
    FROM sized
), domains AS (SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM named GROUP BY suffix, domain
), suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY suffix
), overall AS (SELECT (sum(k) + 1) / (sum(n) + 2) AS p FROM suffixes
), {_sql_level("s", "suffixes g, overall", "p")},
{_sql_level("d", "domains g JOIN s_m USING (suffix)", "s_m.mean")},
{_sql_level("h", "named g JOIN d_m USING (domain)", "d_m.mean")},
bounds AS (SELECT host, mean - {DEVIATIONS} * sqrt(mean * (1 - mean) / (s + n + 1)) AS bound FROM h_m
), ruled AS (
    SELECT *, CASE {_CASES} END AS fitting FROM parsed JOIN bounds USING (host)
)
SELECT page_id, host, path, fitting.text AS rule,
       coalesce(fitting.verdict, CASE WHEN bound >= {LEAST_GOOD} THEN 'allow' ELSE 'block' END) AS verdict, round(bound, 6) AS bound
FROM ruled
"""
