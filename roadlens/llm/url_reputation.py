"""URL filter: explicit rules first, then an empirical-Bayes reputation of the host.

Labelled page outcomes (bad or not) are counted per host.  A host's bad rate
is shrunk towards its registered domain, the domain towards its public suffix
and the suffix towards the overall rate; each level is a beta-binomial whose
prior strength is estimated from the spread of its groups around their
parents (method of moments), and is never worth more pages than the parent's
own posterior rests on.  A host is blocked if the lower bound of its
posterior bad rate is above ``max_bad``; hosts without outcomes have their
domain's posterior as prior and so a wide one.

Only DataFrame functions.  Outcomes are summed per host before anything is
joined; a host with a third of all pages is one row in every table but the
last join of the pages with their hosts, which the adaptive skew join splits.

Registered domains follow a rule (second-level names under country codes) and a
list of hosting services; both are arguments of ``domain_of``.

Edge cases: a null url, or one without ``://``, has empty host and path: no
host can be judged, so it is allowed unless a rule fits.  Ports and user names belong to the host, as it
stands.  Pages without an outcome count for nothing; with no outcome at all
every method verdict is allow.  Rows that repeat an id keep their own rows.
Labels that repeat a document count once, bad if one says so; labels with
null quality are no outcome.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, small_side, write_table

#: Highest lower bound of the posterior bad rate that is still allowed.
MAX_BAD = 0.5
#: Standard deviations below the posterior mean (about 95 percent, one-sided).
BOUND_Z = 1.645
#: Prior strength (in pages) is kept between these.
STRENGTH = (1.0, 10_000.0)
# fixed values: names under a two-letter country code below which domains are registered ("co" of "co.nz")
SECOND_LEVELS = tuple(
    "ab ac ad asn asso biz co com coop ed edu firm gc gob gouv gov govt gr gub gv id in info lg ltd me mi mil muni mus ne net nhs nic nom or org "
    "plc police press pro rec res sch tm web".split()
)
# fixed values: hosting services whose customers have a name of their own each
SHARED_SUFFIXES = tuple(
    "appspot.com azurewebsites.net blogspot.com cloudfront.net firebaseapp.com fly.dev github.io gitlab.io glitch.me herokuapp.com neocities.org netlify.app "
    "onrender.com pages.dev readthedocs.io substack.com surge.sh tumblr.com typepad.com vercel.app web.app weebly.com wixsite.com wordpress.com workers.dev".split()
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return lower_ascii(F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url)))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule ``host/path`` that fits: the host or a subdomain, and a path prefix; null if none."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, decision in sorted(rules, key=lambda r: len(r[0])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(f"/{rest}"))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def domain_of(host: Column, shared: Sequence[str] = SHARED_SUFFIXES, second_levels: Sequence[str] = SECOND_LEVELS) -> Column:
    """Registered domain: the suffix and one label more.

    A suffix has two labels if it is one of ``shared``, or a country code below one of ``second_levels``.
    """
    labels = F.split(host, r"\.")
    below_country = (F.char_length(F.element_at(labels, -1)) == 2) & F.try_element_at(labels, F.lit(-2)).isin(*second_levels)
    double = F.substring_index(host, ".", -2).isin(*shared) | F.coalesce(below_country, F.lit(False))
    last = lambda n: F.array_join(F.slice(labels, -n, n), ".")
    return F.when(F.size(labels) <= 2, host).when(double, last(3)).otherwise(last(2))


def suffix_of(domain: Column) -> Column:
    """What follows the first label of a registered domain (empty for a bare name)."""
    return F.regexp_extract(domain, r"^[^.]*\.(.*)$", 1)


def _shrink(groups: DataFrame) -> DataFrame:
    """``groups(…, bad, n, parent, weight)`` with the shrunken ``rate``, its own ``pages`` and lower ``bound``.

    ``parent`` is the rate of the level above, ``weight`` the pages it rests on.

    With S the spread of the groups' rates around their parents (weighted by
    pages), V0 the spread that binomial chance alone gives and V1 the most it
    could be: share = (S - V0) / (V1 - V0), strength = (1 - share) / share.  The
    variances of a group around its parent and of the parent itself add up, so
    the prior counts for strength * weight / (strength + weight) pages.
    """
    m, n = F.col("parent"), F.col("n")
    chance = m * (1 - m)
    seen = n > 0
    sums = groups.agg(
        F.sum(F.when(seen, n * F.pow(F.col("bad") / n - m, F.lit(2.0)))).alias("s"),
        F.sum(F.when(seen, chance)).alias("v0"),
        F.sum(F.when(seen, n * chance)).alias("v1"),
    )
    share = (F.col("s") - F.col("v0")) / (F.col("v1") - F.col("v0"))
    strength = F.when((F.col("v1") > F.col("v0")) & (share > 0), F.least(F.greatest((1 - share) / share, F.lit(STRENGTH[0])), F.lit(STRENGTH[1]))).otherwise(F.lit(STRENGTH[1]))
    k = sums.select(strength.alias("k")).scalar()
    prior = k * F.col("weight") / (k + F.col("weight"))
    out = groups.withColumn("prior", prior).withColumn("pages", F.col("n") + F.col("prior"))
    out = out.withColumn("rate", (F.col("bad") + F.col("prior") * F.col("parent")) / F.col("pages"))
    return out.withColumn("bound", F.col("rate") - F.lit(BOUND_Z) * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("pages") + 1)))


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """Written table (host, bad, n, rate, bound) from ``outcomes(host, bad)``; null ``bad``: a page without outcome."""
    hosts = outcomes.filter("host <> ''").groupBy("host").agg(
        F.coalesce(F.sum(F.col("bad").cast("double")), F.lit(0.0)).alias("bad"), F.count("bad").cast("double").alias("n")
    )
    hosts = hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("domain")))
    hosts = write_table(hosts, "hosts")
    sums = (F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    domains = write_table(hosts.groupBy("domain", "suffix").agg(*sums), "domains")
    total = hosts.agg(F.coalesce(F.sum("bad") / F.nullif(F.sum("n"), F.lit(0.0)), F.lit(0.0)).alias("parent"), (F.coalesce(F.sum("n"), F.lit(0.0)) + 1).alias("weight"))
    above = lambda groups, name: groups.select(name, F.col("rate").alias("parent"), F.col("pages").alias("weight"))
    suffixes = domains.groupBy("suffix").agg(*sums).withColumns({c: total.select(c).scalar() for c in ("parent", "weight")})
    suffixes = write_table(above(_shrink(suffixes), "suffix"), "suffixes")
    rates = write_table(above(_shrink(domains.join(small_side(suffixes, 64), "suffix")), "domain"), "domain_rates")
    return write_table(_shrink(hosts.join(small_side(rates, 96), "domain")).select("host", "bad", "n", "rate", "bound"), "host_rates")


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]], max_bad: float = MAX_BAD) -> DataFrame:
    """One row per row of ``pages(page_id, url)``: page_id, host, path, rule, verdict, bound (of its host)."""
    hosts = host_reputation(outcomes).select(F.col("host").alias("known"), "bound")
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, decided = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "decided": decided}).join(hosts, F.col("host") == F.col("known"), "left")
    blocked = F.coalesce(F.col("bound") > max_bad, F.lit(False))
    return rows.select("page_id", "host", "path", "rule", F.coalesce("decided", F.when(blocked, "block").otherwise("allow")).alias("verdict"), "bound")


def outcomes_by_document(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad) of every page: the label of the document whose number is the last one in the url's path."""
    marks = labels.filter("quality IS NOT NULL").groupBy("doc_id").agg(F.max(((F.col("quality") == 0) | F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int")).alias("bad"))
    number = F.expr("try_cast(regexp_extract(path, '([0-9]+)[^0-9]*$', 1) AS BIGINT)")
    rows = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).select("host", number.alias("number"))
    return rows.join(marks, F.col("number") == F.col("doc_id"), "left").select("host", "bad")
