"""URL filters: written rules first, then an empirical-Bayes reputation of the host.

Outcomes of labelled pages (bad or not) are counted per host. A beta-binomial prior shrinks
each host towards its registered domain, each domain towards its suffix and each suffix
towards all pages; the strength of each prior is estimated from the spread of the rates on
its level. A host is blocked where even the lower bound of its posterior bad rate exceeds
the limit. Only DataFrame functions are used.

Defined cases: a null URL or one without ``://`` has an empty host and path, fits no rule and
is allowed or blocked as the empty host is; a host without labelled pages takes its domain's
rate; without any outcome everything the rules leave open is allowed. Repeated pages count
as often as they appear. Other columns of the tables are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
URL_PATTERN = "://([^/?#]*)([^?#]*)"
#: Outcomes a prior is worth at least, so that one outcome alone never decides over a host.
LEAST_PRIOR = 2.0


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains, below a path: ``block`` for ``example.org/es/``."""

    verdict: str
    text: str

    def fits(self, host: Column, path: Column) -> Column:
        own, slash, rest = self.text.partition("/")
        same = (host == own) | host.endswith("." + own)
        return same & path.startswith(slash + rest)


def with_host(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host``, with A-Z lower-cased, and ``path``, replacing columns of these names."""
    part = lambda k: F.coalesce(F.regexp_extract(F.col(f"`{url}`"), URL_PATTERN, k), F.lit(""))
    return pages.withColumns({"host": F.translate(part(1), UPPER, UPPER.lower()), "path": part(2)})


def with_parents(hosts: DataFrame) -> DataFrame:
    """Add the registered domain (two last labels) and the suffix (last label) of ``host``."""
    domain = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    suffix = F.regexp_extract("host", r"([^.]+)$", 1)
    numeric = F.col("host").rlike(r"^[0-9.:]+$")
    named = lambda part: F.when(numeric | (part == ""), F.col("host")).otherwise(part)
    return hosts.withColumns({"domain": named(domain), "suffix": named(suffix)})


def _concentration(units: DataFrame) -> tuple[float, float]:
    """Overall rate of the units' ``bad`` of ``n``, and the prior strength by moments.

    The single row of sums this reads has one size for every input.
    """
    n, y = F.col("n"), F.col("bad")
    seen = units.where(n > 0)
    row = seen.agg(
        F.count("*").alias("k"), F.sum(n).alias("n"), F.sum(y).alias("y"),
        F.sum(n * n).alias("nn"), F.sum(y * y / n).alias("yyn"),
    ).first()
    if not row["k"]:
        return 0.0, LEAST_PRIOR
    rate = row["y"] / row["n"]
    spread = rate * (1 - rate)
    between = row["yyn"] - row["n"] * rate * rate - (row["k"] - 1) * spread
    room = (row["n"] - row["nn"] / row["n"] - (row["k"] - 1)) * spread
    correlation = between / room if room > 0 else 0.0
    return rate, max(1 / min(max(correlation, 0.001), 0.999) - 1, LEAST_PRIOR)


def reputation(pages: DataFrame, outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """One row per host of ``pages``: ``host, n, bad, rate, bound``.

    ``outcomes`` holds ``page_id, bad`` (0 or 1; null means not labelled). ``rate`` is the
    posterior mean of the bad rate and ``bound`` lies ``z`` posterior deviations below it.
    """
    labelled = outcomes.where(F.col("bad").isNotNull()).select("page_id", F.col("bad").cast("long").alias("bad"))
    counted = (
        with_host(pages).select("page_id", "host").join(labelled, "page_id", "left")
        .groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    )
    hosts = with_parents(counted)
    sums = lambda *by: hosts.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes, domains = sums("suffix"), sums("suffix", "domain")
    rate, strong = _concentration(suffixes)
    post = lambda m, prior: (F.col("bad") + m * prior) / (F.col("n") + m)
    suffixes = suffixes.select("suffix", post(strong, F.lit(rate)).alias("suffix_rate"))
    _, strong = _concentration(domains)
    domains = domains.join(suffixes, "suffix").select("domain", post(strong, F.col("suffix_rate")).alias("domain_rate"))
    _, strong = _concentration(hosts)
    prior = F.col("domain_rate")
    a = F.col("bad") + strong * prior
    b = F.col("n") - F.col("bad") + strong * (1 - prior)
    mean = a / (a + b)
    return hosts.join(domains, "domain").select(
        "host", "n", "bad", mean.alias("rate"),
        (mean - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))).alias("bound"),
    )


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: list[Rule], max_bad: float = 0.5, z: float = 1.645
) -> DataFrame:
    """Every page with ``host, path, rule, verdict, rate, bound``; the longest fitting rule wins.

    A third of all pages may share one host: hosts are counted with partial sums, and the join
    back is one that Spark splits where a host is hot.
    """
    judged = with_host(pages).select("page_id", "url", "host", "path")
    rule = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = r.fits(F.col("host"), F.col("path"))
        rule = F.when(fits, r.text) if rule is None else rule.when(fits, r.text)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    known = reputation(pages, outcomes, z).select("host", "rate", "bound")
    own = F.when(F.col("bound") > max_bad, "block").otherwise("allow")
    return judged.join(known, "host", "left").select(
        "page_id", "url", "host", "path",
        (F.lit(None).cast("string") if rule is None else rule).alias("rule"),
        (own if verdict is None else F.coalesce(verdict, own)).alias("verdict"),
        "rate", "bound",
    )
