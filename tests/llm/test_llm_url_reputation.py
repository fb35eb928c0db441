"""URL filter: rules against a plain version, shrinkage by hand, edge cases."""

from __future__ import annotations

import math
import random
import re

from pyspark.sql import functions as F
from roadlens.llm import url_reputation as U

RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
URLS = [
    "http://a.org/x", "http://example.org/es/1", "https://www.example.org/es/2?x#y", "http://example.org/en/17", "http://example.org/en/2",
    "http://EXAMPLE.org/en/1", "http://notexample.org/es/3", "http://a.com/fr/", "http://a.com/fr", "http://b.a.com/de/9", "http://com/de/1", "http://xcom/de/1",
    "http://org", "http://org?x", "http://a.net/1", "ftp://A.B.co.uk:80/p#q", "nothing", "", None, "://", "http:///p", "http://É.org/é", "a://b://c/d",
]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(t, v) for t, v in RULES for n, _, p in [t.partition("/")] if (host == n or host.endswith("." + n)) and path.startswith("/" + p)]
    return host, path, *max(fit, key=lambda r: len(r[0]), default=(None, None))


def test_rules_match_the_plain_version(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r["rule"], r.verdict) for r in U.judge(pages, spark.createDataFrame([], "host string, bad int"), RULES).collect()}
    for i, u in enumerate(URLS):
        host, path, rule, verdict = plain(u)
        assert got[i] == (host, path, rule, verdict or "allow"), u


def test_domains_and_suffixes(spark):
    hosts = ["a.b.example.com", "example.com", "com", "x.y.co.uk", "y.co.uk", "co.uk", "", "a.b.co.nz", "x.com.cn", "me.github.io", "a.de", "www.a.de", "t.co"]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    rows = df.withColumn("d", U.domain_of(F.col("host"))).withColumn("s", U.suffix_of(F.col("d"))).collect()
    assert {r.host: (r.d, r.s) for r in rows} == {
        "a.b.example.com": ("example.com", "com"), "example.com": ("example.com", "com"), "com": ("com", ""),
        "x.y.co.uk": ("y.co.uk", "co.uk"), "y.co.uk": ("y.co.uk", "co.uk"), "co.uk": ("co.uk", "uk"), "": ("", ""), "a.b.co.nz": ("b.co.nz", "co.nz"), "x.com.cn": ("x.com.cn", "com.cn"),
        "me.github.io": ("me.github.io", "github.io"), "a.de": ("a.de", "de"), "www.a.de": ("a.de", "de"), "t.co": ("t.co", "co"),
    }


def test_bad_hosts_are_blocked_and_few_pages_are_not_enough(spark):
    rng = random.Random(1)
    rows = [(f"h{d}.good{d}.net", int(rng.random() < 0.1)) for d in range(20) for _ in range(60)]
    rows += [("www.spam.net", int(rng.random() < 0.95)) for _ in range(200)] + [("new.spam.net", None)] * 5
    rows += [("one.else.net", 1)] + [("quiet.good1.net", None)]
    found = {r.host: r for r in U.host_reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}
    blocked = {h for h, r in found.items() if r.bound > U.MAX_BAD}
    assert "www.spam.net" in blocked and blocked <= {"www.spam.net", "new.spam.net"}
    assert found["one.else.net"].rate < 0.9 and found["quiet.good1.net"].n == 0
    assert found["new.spam.net"].rate > found["quiet.good1.net"].rate  # its domain speaks for it


def test_one_level_by_hand(spark):
    rows = [("a", 2.0, 10.0, 0.3, 50.0), ("b", 9.0, 12.0, 0.3, 50.0), ("c", 0.0, 0.0, 0.3, 50.0)]
    out = {r.host: r for r in U._shrink(spark.createDataFrame(rows, "host string, bad double, n double, parent double, weight double")).collect()}
    s = 10 * (0.2 - 0.3) ** 2 + 12 * (0.75 - 0.3) ** 2
    share = (s - 2 * 0.21) / (22 * 0.21 - 2 * 0.21)
    k = min(max((1 - share) / share, U.STRENGTH[0]), U.STRENGTH[1])
    k = k * 50 / (k + 50)
    rate = (9 + k * 0.3) / (12 + k)
    assert math.isclose(out["b"].rate, rate) and math.isclose(out["b"].bound, rate - U.BOUND_Z * math.sqrt(rate * (1 - rate) / (12 + k + 1)))
    assert math.isclose(out["c"].rate, 0.3)


def test_outcomes_nulls_and_repeats(spark):
    pages = spark.createDataFrame([(1, "http://a.net/en/7.html"), (1, "http://a.net/en/7.html"), (2, "http://a.net/en/8?x=9"), (3, None), (4, "http://a.net/x"), (5, "http://a.net/" + "9" * 30)], "page_id long, url string")
    labels = spark.createDataFrame([(7, 1, 0), (7, 0, None), (8, 1, None), (9, 0, 0), (None, 0, 0), (10, None, 1)], "doc_id long, quality int, toxic int")
    rows = sorted((r.host, str(r.bad)) for r in U.outcomes_by_document(pages, labels).collect())
    assert rows == sorted([("a.net", "1"), ("a.net", "1"), ("a.net", "0"), ("", "None"), ("a.net", "None"), ("a.net", "None")])
    assert U.judge(pages.limit(0), U.outcomes_by_document(pages.limit(0), labels.limit(0)), RULES).collect() == []
