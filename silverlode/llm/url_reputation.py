"""URL filter: rules first, then an empirical-Bayes reputation of the host."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

# Quantile of the standard normal distribution that the posterior bound uses.
Z = 1.645


@dataclass(frozen=True)
class Rule:
    """``host/path``: fits the host, its subdomains and every path that starts with ``path``."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    behind = F.substring(rest, F.length(host) + 1, F.length(rest))
    path = F.regexp_extract(behind, r"^[^?#]*", 0)
    known = url.isNotNull() & (at > 0)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(known, lowered).otherwise(""), F.when(known, path).otherwise("")


def longest_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Pattern and verdict of the longest rule that fits; null without one."""
    pattern = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.pattern)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        pattern = F.when(fits, rule.pattern).otherwise(pattern)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return pattern, verdict


# Second-level names of country domains under which anyone can register.
SHARED_LABELS = "ac co com edu gob gov go ltd me mil ne net nom or org plc sch".split()
SHARING_COUNTRIES = "ar au br cn co eg gr hk id il in jp ke kr mx my ng nz pe ph pk pl sa sg th tr tw ua uk uy ve vn za".split()


def domain_and_suffix(host: Column, suffixes: list[str]) -> tuple[Column, Column]:
    """Registered domain and public suffix of a host.

    The suffix is the longest of ``suffixes`` that fits; else two labels where a shared
    label stands below a country that shares it (``co.uk``, ``com.au``); else the last label.
    """
    last, second = F.substring_index(host, ".", -1), F.substring_index(F.substring_index(host, ".", -2), ".", 1)
    shared = host.contains(".") & last.isin(SHARING_COUNTRIES) & second.isin(SHARED_LABELS)
    suffix = F.when(shared, F.substring_index(host, ".", -2)).otherwise(last)
    labels = F.when(shared, 2).otherwise(1)
    for known in sorted(suffixes, key=len):
        fits = (host == known) | host.endswith("." + known)
        suffix = F.when(fits, known).otherwise(suffix)
        labels = F.when(fits, known.count(".") + 1).otherwise(labels)
    parts = F.split(host, r"\.")
    keep = F.least(F.size(parts), labels + 1)
    return F.array_join(F.slice(parts, F.size(parts) - keep + 1, keep), "."), suffix


def _prior(counts: DataFrame, above: DataFrame, name: str, strength: float) -> DataFrame:
    """Posterior mean of the good share per ``name`` of ``counts(name, up, good, n)``.

    ``above`` is ``(up, mean)``: the prior's mean, worth ``strength`` pages.
    """
    joined = counts.join(above.toDF("_up", "_mean"), F.col("up").eqNullSafe(F.col("_up")))
    mean = (F.col("good") + strength * F.col("_mean")) / (F.col("n") + strength)
    return joined.select(name, mean.alias("mean"))


def strengths(counts: DataFrame, above: DataFrame, least: float = 2.0, most: float = 1000.0) -> float:
    """Pages the prior is worth, by the method of moments over all groups.

    The variance of group shares beyond binomial noise gives the beta distribution's
    concentration; it is kept between ``least`` and ``most``.
    """
    joined = counts.where("n > 0").join(above.toDF("_up", "_mean"), F.col("up").eqNullSafe(F.col("_up")))
    noise = F.col("_mean") * (1 - F.col("_mean"))
    off = F.col("good") - F.col("n") * F.col("_mean")
    # E[off**2] = n p (1 - p) (1 + (n - 1) / (1 + strength))
    extra, pairs = joined.agg(
        F.sum(off * off - F.col("n") * noise), F.sum(F.col("n") * (F.col("n") - 1) * noise)
    ).first()
    if not pairs:
        # Nothing is known about the spread, so the prior says little.
        return least
    if extra <= 0:
        return most
    return min(most, max(least, pairs / extra - 1))


def reputation(outcomes: DataFrame, suffixes: list[str], z: float = Z) -> DataFrame:
    """``(host, mean, bound)``: posterior of a host's share of good pages.

    ``outcomes`` is ``(host, good)``, with ``good`` 1, 0 or null (not labelled); hosts
    without labels get what their registered domain or suffix says.  Beta-binomial
    priors are fitted from all pages down: all labels for suffixes, suffixes for
    registered domains, domains for hosts.  ``bound`` is the mean plus ``z`` standard
    deviations.  Tables are grouped by host first, so a hot host is one row.
    """
    per_host = outcomes.groupBy("host").agg(
        F.sum(F.coalesce("good", F.lit(0))).cast("double").alias("good"), F.count("good").cast("double").alias("n")
    )
    domain, suffix = domain_and_suffix(F.col("host"), suffixes)
    hosts = materialize(per_host.select("host", domain.alias("domain"), suffix.alias("suffix"), "good", "n"), "hosts")
    sums = [F.sum("good").alias("good"), F.sum("n").alias("n")]
    good, n = hosts.agg(*sums).first()
    everything = ((good or 0) + 1) / ((n or 0) + 2)
    top = hosts.select("suffix").distinct().select("suffix", F.lit(everything).alias("mean"))
    by_suffix = hosts.groupBy("suffix").agg(*sums).withColumn("up", F.col("suffix"))
    suffix_mean = materialize(_prior(by_suffix, top, "suffix", strengths(by_suffix, top)), "suffixes")
    by_domain = hosts.groupBy("domain", F.col("suffix").alias("up")).agg(*sums)
    domain_mean = materialize(_prior(by_domain, suffix_mean, "domain", strengths(by_domain, suffix_mean)), "domains")
    by_host = hosts.withColumnRenamed("domain", "up")
    strength = strengths(by_host, domain_mean)
    total = F.col("n") + strength
    means = hosts.select("host", "n").join(_prior(by_host, domain_mean, "host", strength), "host")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (total + 1))
    return means.select("host", "mean", (F.col("mean") + z * deviation).alias("bound"))


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: list[Rule],
    suffixes: list[str],
    least: float = 0.7,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """Verdict on every page's URL.

    ``outcomes`` is ``(page_id, good)``: labelled pages, one row per page at most.
    Returns one row per page: ``page_id``, ``host``, ``path``, ``rule`` (the longest
    rule that fits, or null), ``verdict`` (the rule's; else ``block`` if even the upper
    posterior bound of the host's good share is below ``least``, else ``allow``), and
    the host's ``reputation`` and ``bound``.

    * URLs that are null or lack ``://`` have an empty host and path and share one
      reputation; an empty URL too.
    * Pages without an id are judged; their outcome is unknown.
    * Repeated rows are judged alike and counted each.  Other columns are not read.
    * Without labels every host has the same reputation of one half, whose bound
      blocks nothing at the default.  An empty table gives an empty result.
    """
    url = F.col(f"`{url_column}`").cast("string")
    host, path = host_and_path(url)
    rows = pages.select(F.col(f"`{id_column}`").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    known = outcomes.select(F.col("page_id").cast("long").alias("_id"), F.col("good").cast("int").alias("good"))
    known = known.where("_id is not null").groupBy("_id").agg(F.min("good").alias("good"))
    judged = rows.select("page_id", "host").join(known, F.col("page_id") == F.col("_id"), "left")
    standing = materialize(reputation(judged.select("host", "good"), suffixes), "reputation")
    pattern, ruled = longest_rule(rules, F.col("host"), F.col("path"))
    own = F.when(F.col("bound") < least, "block").otherwise("allow")
    return rows.join(standing, "host").select(
        "page_id", "host", "path", pattern.alias("rule"), F.coalesce(ruled, own).alias("verdict"),
        F.col("mean").alias("reputation"), "bound",
    )


def outcomes_of_copies(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcomes of pages whose URL ends in the number of a labelled document.

    A page is good if its document has quality 1 and is not toxic.
    """
    _, path = host_and_path(F.col("url"))
    number = F.regexp_extract(path, r"/(\d{1,18})(?:\.html)?/?$", 1).try_cast("long")
    good = ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int")
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("_doc"))
    known = known.agg(F.min(good).alias("good"))
    return pages.select("page_id", number.alias("_number")).join(known, F.col("_number") == F.col("_doc")).select("page_id", "good")
