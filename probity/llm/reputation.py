"""Verdicts on urls: given rules, else the reputation of the host.

Labelled outcomes of pages are counted per host, registered domain and suffix.
Each level's bad rate is a beta-binomial draw around the posterior mean of the
level above; how strongly it is drawn there is estimated from the spread of the
level's own rates (moments). A page is blocked where the lower bound of its
host's posterior is above the limit, so a host without outcomes goes by its
domain, and nothing is blocked on little evidence. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from probity.llm.scratch import new_folder, saved

#: Suffixes of two labels under which names are registered, beside those of one, where no table of
#: suffixes is given. Hosts under any other such suffix then share one registered domain.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in")


@dataclass(frozen=True)
class UrlRule:
    """Fits its host and all subdomains where the url's path begins with the rule's."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Prior:
    """``limit``: bad rate to block above; ``z``: normal quantile of the bound.

    Strengths are kept between the two bounds; ``mean`` and ``strength`` are used
    where there are no outcomes to estimate them from.
    """

    limit: float = 0.3
    z: float = 1.645
    mean: float = 0.5
    strength: float = 10.0
    weakest: float = 1.0
    strongest: float = 10_000.0


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for NULL and for a url without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def first_rule(host: Column, path: Column, rules: Sequence[UrlRule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else NULL. Of equal rules the first wins."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):
        own = (host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))
        fits = own & F.startswith(path, F.lit(rule.path))
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def read_suffixes(spark: SparkSession, path: str) -> DataFrame:
    """The rules of a file of public suffixes, as the column ``rule``.

    One rule a line, up to the first white space; ``//`` begins a comment.
    """
    lines = spark.read.text(path).select(F.lower(F.regexp_extract("value", r"^\s*(\S+)", 1)).alias("rule"))
    return lines.filter((F.col("rule") != "") & ~F.col("rule").startswith("//")).distinct()


def suffix_lengths(hosts: DataFrame, suffixes: DataFrame) -> DataFrame:
    """host and ``labels``, how many its public suffix has by the rules of ``suffixes`` (rule).

    A rule is a suffix; ``*.`` before it stands for one label more, ``!`` for an
    exception, which has one label less. An exception counts before others, then the
    longest rule, and without any the last label is the suffix. Ends of hosts and
    rules meet by equality.
    """
    rules = suffixes.select(
        F.regexp_replace("rule", r"^(!|\*\.)", "").alias("tail"),
        F.when(F.col("rule").startswith("!"), -1).when(F.col("rule").startswith("*."), 1).otherwise(0).alias("more"),
    ).distinct()
    parts = F.split("host", r"\.")
    tails = hosts.select("host", F.size(parts).alias("size"), F.explode(F.sequence(F.lit(1), F.size(parts))).alias("k"))
    tails = tails.withColumn("tail", F.expr("substring_index(host, '.', -k)"))
    fits = tails.join(rules, "tail").withColumn("labels", F.col("k") + F.col("more")).filter("labels <= size")
    found = fits.groupBy("host").agg(
        F.max(F.when(F.col("more") == -1, F.col("labels"))).alias("exception"), F.max("labels").alias("longest")
    )
    return hosts.select("host").join(found, "host", "left").select(
        "host", F.coalesce("exception", "longest", F.lit(1)).alias("labels")
    )


def _levels(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """Adds the suffix and the registered domain of each host."""
    if suffixes is not None:
        lengths = suffix_lengths(hosts, suffixes)
        return hosts.join(lengths, "host").select(
            *hosts.columns,
            F.expr("substring_index(host, '.', -labels)").alias("suffix"),
            F.expr("substring_index(host, '.', -labels - 1)").alias("domain"),
        )
    last_two = F.substring_index("host", ".", -2)
    two = last_two.isin(*TWO_LABEL_SUFFIXES)
    suffix = F.when(two, last_two).otherwise(F.substring_index("host", ".", -1))
    domain = F.when(two, F.substring_index("host", ".", -3)).otherwise(last_two)
    return hosts.withColumns({"suffix": suffix, "domain": domain})


def _counts(groups: DataFrame, *keys: str) -> DataFrame:
    return groups.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def _strength(groups: DataFrame, prior: Prior) -> tuple[float, float]:
    """The mean rate, and the strength that the spread of the groups' rates speaks for."""
    sums = groups.filter("n > 0").agg(
        F.sum("n").cast("double").alias("n"),
        F.sum("bad").cast("double").alias("bad"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("n2"),
        F.sum(F.col("bad").cast("double") * F.col("bad") / F.col("n")).alias("b2"),
        F.count("*").alias("groups"),
    )
    found = sums.first()
    if not found["n"]:
        return prior.mean, prior.strength
    mean = found["bad"] / found["n"]
    noise, more = mean * (1 - mean), found["groups"] - 1
    spread = found["b2"] - found["n"] * mean * mean - noise * more
    room = noise * (found["n"] - found["n2"] / found["n"] - more)
    if room <= 0:
        return mean, prior.strength
    strength = room / spread - 1 if spread > 0 else prior.strongest
    return mean, min(max(strength, prior.weakest), prior.strongest)


def _shrunk(bad: Column, n: Column, mean: Column, strength: float) -> Column:
    return (bad + mean * strength) / (n + strength)


def host_posteriors(
    hosts: DataFrame, prior: Prior = Prior(), suffixes: DataFrame | None = None
) -> DataFrame:
    """Per row of ``hosts`` (host, n, bad): also bad_rate and its bound ``lower``.

    ``n`` are a host's labelled pages, ``bad`` those that were bad; hosts with
    none are judged by their domain, a domain with none by its suffix. What a level
    takes from the one above is without its own pages, so that none counts twice.
    Three one-row aggregates are fetched, one for each level's prior. ``suffixes`` are
    the rules of public suffixes, see ``suffix_lengths``.
    """
    hosts = _levels(hosts, suffixes)
    domains = _counts(hosts, "suffix", "domain")
    suffixes = _counts(hosts, "suffix")
    mean, of_mean = _strength(suffixes, prior)
    _, of_suffix = _strength(domains, prior)
    _, of_domain = _strength(hosts, prior)
    s = suffixes.select("suffix", F.col("n").alias("suffix_n"), F.col("bad").alias("suffix_bad"))
    above = domains.join(s, "suffix").select(
        "suffix",
        "domain",
        F.col("n").alias("domain_n"),
        F.col("bad").alias("domain_bad"),
        _shrunk(
            F.col("suffix_bad") - F.col("bad"), F.col("suffix_n") - F.col("n"), F.lit(mean), of_mean
        ).alias("suffix_rate"),
    )
    bad, n, rate = F.col("bad"), F.col("n"), F.col("bad_rate")
    domain_rate = _shrunk(
        F.col("domain_bad") - bad, F.col("domain_n") - n, F.col("suffix_rate"), of_suffix
    )
    deviation = F.sqrt(rate * (1 - rate) / (n + of_domain + 1))
    return (
        hosts.join(above, ["suffix", "domain"])
        .withColumn("bad_rate", _shrunk(bad, n, domain_rate, of_domain))
        .select("host", "n", "bad", "bad_rate", (rate - prior.z * deviation).alias("lower"))
    )


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[UrlRule],
    prior: Prior = Prior(),
    suffixes: DataFrame | None = None,
) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block), bad_rate and lower for every row of ``pages``.

    ``bad_rate`` is the posterior mean of the host, ``lower`` the bound by which it is judged.

    ``pages`` has page_id and url, ``outcomes`` page_id and ``bad`` (0 or 1; NULL
    is no outcome). Other columns are ignored. Each row of a repeated page_id is
    judged, and each outcome counts for each of them. A NULL url, or one without
    ``://``, has an empty host, which has a reputation like any other.
    """
    host, path = host_and_path(F.col("url"))
    rule, ruled = first_rule(F.col("host"), F.col("path"), rules)
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    seen = outcomes.filter("bad IS NOT NULL").groupBy("page_id").agg(
        F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad")
    )
    counted = (
        urls.select("page_id", "host")
        .join(seen, "page_id", "left")
        .groupBy("host")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    )
    folder = new_folder(pages.sparkSession)
    known = host_posteriors(saved(counted, folder, "hosts"), prior, suffixes).select("host", "bad_rate", "lower")
    by_host = F.when(F.col("lower") > prior.limit, "block").otherwise("allow")
    return urls.join(known, "host", "left").select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(ruled, by_host).alias("verdict"),
        "bad_rate",
        "lower",
    )
