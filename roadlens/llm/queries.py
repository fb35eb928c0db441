"""Registered queries of the training-data operators: thin contract forms over whole tables, and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, exact_dedup, html_text, kneser_ney, langid, licenses, merkle, packing, prefix_trie, simhash, suffix_dedup, url_reputation, warc
from .common import LOWER, UPPER, reachable, table

Query = Callable[[SparkSession, str], DataFrame]


# fixed values: the rules of the URL query
URL_RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    outcomes = url_reputation.outcomes_by_document(pages, table(spark, sf_dir, "labels"))
    return url_reputation.judge(pages, outcomes, URL_RULES).drop("bound")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_report(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.document_manifest(table(spark, sf_dir, "documents"), claimed=tampered)


def _registered(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reachable(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    f.__name__: _registered(f)
    for f in (
        op1_simhash,
        op2_html_text,
        op3_decontamination,
        op4_url_filter,
        op5_quality,
        op6_packing,
        op7_warc,
        op8_language_id,
        op9_exact_dedup,
        op10_licenses,
        op11_suffix_dedup,
        op12_prefix_trie,
        op13_merkle_manifest,
    )
}


def _license_sql() -> str:
    words = lambda text: f"list_filter(regexp_split_to_array(translate({text}, '{UPPER}', '{LOWER}'), '[^0-9a-z\\x{{80}}-\\x{{10FFFF}}]+'), lambda w: w <> '')"
    pairs = "CASE WHEN len(w) > 1 THEN list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) ELSE w END"
    templates = ", ".join(f"('{name}', '{text}')" for name, text in licenses.TEMPLATES.items())
    t = licenses.MIN_DICE
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
units AS (
    SELECT doc_id, unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS unit FROM texts
    UNION ALL SELECT doc_id, text FROM texts WHERE regexp_matches(text, '[\\r\\n]')
), u AS (SELECT doc_id, {pairs} AS have FROM (SELECT doc_id, {words("unit")} AS w FROM units) WHERE len(w) > 0),
t AS (SELECT license, {pairs} AS want FROM (SELECT license, {words("body")} AS w FROM (VALUES {templates}) v(license, body))),
m AS (
    SELECT doc_id, license, dice FROM (SELECT doc_id, license, 2.0::DOUBLE * len(list_intersect(have, want)) / (len(have) + len(want)) AS dice
    FROM u JOIN t ON len(have) >= ceil(len(want) * {t / (2 - t)} - 1e-9) AND len(want) >= ceil(len(have) * {t / (2 - t)} - 1e-9)) WHERE dice >= {t}
), whole AS (
    SELECT doc_id, CASE WHEN len(w) > 1 THEN list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END AS steps
    FROM (SELECT doc_id, {words("text")} AS w FROM texts) WHERE len(w) > 0
), sizes AS (SELECT license, want, greatest(1, len(w) - 1) AS n, CAST(ceil(len(want) * {t / (2 - t)} - 1e-9) AS BIGINT) AS least
    FROM (SELECT license, {pairs} AS want, w FROM (SELECT license, {words("body")} AS w FROM (VALUES {templates}) v(license, body)))
), near AS (SELECT doc_id, license, want, n, steps FROM whole JOIN sizes ON len(steps) >= n AND len(list_intersect(steps, want)) >= least),
windows AS (
    SELECT doc_id, license, max(2.0::DOUBLE * len(list_intersect(have, want)) / (len(have) + len(want))) AS dice
    FROM (SELECT doc_id, license, want, list_distinct(steps[i : i + n - 1]) AS have FROM (SELECT *, unnest(generate_series(1, len(steps) - n + 1)) AS i FROM near))
    GROUP BY doc_id, license HAVING max(2.0::DOUBLE * len(list_intersect(have, want)) / (len(have) + len(want))) >= {t}
), per AS (
    SELECT coalesce(u.doc_id, v.doc_id) AS doc_id, coalesce(u.license, v.license) AS license, coalesce(u.dice, v.dice) AS dice, coalesce(u.n, 1) AS n
    FROM (SELECT doc_id, license, max(dice) AS dice, count(*) AS n FROM m GROUP BY doc_id, license) u
    FULL JOIN windows v ON u.doc_id IS NOT DISTINCT FROM v.doc_id AND u.license = v.license
), best AS (SELECT doc_id, min(struct_pack(d := -dice, l := license)) AS b, CAST(sum(n) AS BIGINT) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS ls FROM per GROUP BY doc_id)
SELECT d.doc_id, b.l AS license, coalesce(-b.d, 0.0::DOUBLE) AS dice, coalesce(n, 0)::BIGINT AS n_matches, coalesce(ls, '') AS licenses
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN best ON d.doc_id IS NOT DISTINCT FROM best.doc_id
"""


def _packing_sql(buckets: int = packing.BUCKETS, budget: int = packing.TOKEN_BUDGET) -> str:
    """The dynamic programme, one step per bucket (for tables with at least that many distinct lengths)."""
    steps = "d1 AS (SELECT j, struct_pack(v := total * longest, i := 0) AS s FROM h)"
    for k in range(2, buckets + 1):
        steps += f""",
d{k} AS (SELECT h.j AS j, min(struct_pack(v := p.s.v + (h.total - q.total) * h.longest, i := p.j)) AS s
    FROM h JOIN d{k - 1} p ON p.j < h.j JOIN h q ON q.j = p.j GROUP BY h.j)"""
    back = f"b{buckets} AS (SELECT max(j) AS j FROM h)"
    for k in range(buckets - 1, 0, -1):
        back += f", b{k} AS (SELECT d.s.i AS j FROM d{k + 1} d JOIN b{k + 1} b ON d.j = b.j)"
    uppers = " UNION ALL ".join(f"SELECT longest FROM h JOIN b{k} USING (j)" for k in range(1, buckets + 1))
    return rf"""
WITH t AS (SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n FROM documents),
bins AS (SELECT n AS longest, count(*) AS c FROM t GROUP BY n),
h AS (SELECT row_number() OVER w AS j, longest, CAST(sum(c) OVER w AS BIGINT) AS total FROM bins WINDOW w AS (ORDER BY longest)),
{steps}, {back}, u AS ({uppers}),
r AS (
    SELECT doc_id, n, (SELECT CAST(count(*) + 1 AS INTEGER) FROM u WHERE u.longest < n) AS bucket, (SELECT min(u.longest) FROM u WHERE u.longest >= n) AS bucket_tokens FROM t
), p AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY doc_id) - 1 AS place, greatest(1, {budget} // greatest(bucket_tokens, 1)) AS capacity FROM r)
SELECT doc_id, n AS n_tokens, bucket, bucket_tokens, place // capacity AS batch, place % capacity AS slot FROM p
"""


def _shrunk(groups: str) -> str:
    """SQL of one shrinkage level: ``groups`` has bad, n, parent and weight; adds rate, pages and bound."""
    low, high = url_reputation.STRENGTH
    return f"""
    SELECT *, rate - {url_reputation.BOUND_Z} * sqrt(rate * (1 - rate) / (pages + 1)) AS bound FROM (
        SELECT g.*, n + k * weight / (k + weight) AS pages, (bad + k * weight / (k + weight) * parent) / (n + k * weight / (k + weight)) AS rate FROM ({groups}) g, (
            SELECT CASE WHEN v1 > v0 AND s > v0 THEN least(greatest((v1 - s) / (s - v0), {low}), {high}) ELSE {high} END AS k FROM (
                SELECT sum(n * pow(bad / n - parent, 2)) AS s, sum(parent * (1 - parent)) AS v0, sum(n * parent * (1 - parent)) AS v1
                FROM ({groups}) WHERE n > 0)))"""


#: DuckDB: the 256 remainders of CRC-32, and the CRC-32 of a whole number's digits.
_CRC_TABLE = "SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, i: xor(c >> 1, (c & 1) * 3988292384))) AS t"


def _crc_sql(number: str) -> str:
    digits = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {digits}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def _merkle_sql(inner: int = 20, outer: int = 12) -> str:
    """One step per level: ``inner`` within a source, ``outer`` over the sources (3 to that power are covered)."""

    def field(v: str) -> str:
        return f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    def climb(node: str, path: str, levels: int) -> str:
        steps = []
        for k in range(levels):
            steps.append(f"""
{node}{k}g AS MATERIALIZED (SELECT tree, i // 3 AS i, list(d ORDER BY i) AS ds, any_value(n) AS n FROM {node}{k} GROUP BY tree, i // 3),
{node}{k + 1} AS MATERIALIZED (SELECT tree, i, (n + 2) // 3 AS n, CASE WHEN n = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END AS d FROM {node}{k}g),
{path}{k + 1} AS MATERIALIZED (
    SELECT p.* EXCLUDE (g, pre, post) REPLACE (p.i // 3 AS i, CASE WHEN g.n = 1 THEN proof ELSE proof || pre || post END AS proof, CASE WHEN g.n = 1 THEN claim ELSE sha256(pre || claim || post) END AS claim)
    FROM (SELECT p.*, g, array_to_string(g.ds[1 : p.i % 3], '') AS pre, array_to_string(g.ds[p.i % 3 + 2 :], '') AS post FROM {path}{k} p JOIN {node}{k}g g ON g.tree = p.tree AND g.i = p.i // 3) p
)""")
        return ",".join(steps)

    return f"""
WITH crc AS ({_CRC_TABLE}),
rows AS (
    SELECT doc_id, coalesce('=' || source, '') AS tree, {leaf("text")} AS leaf,
           CASE WHEN {_crc_sql("doc_id")} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS claim FROM documents, crc
), p0 AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, claim) - 1 AS i, '' AS proof FROM rows
), n0 AS MATERIALIZED (SELECT tree, i, count(*) OVER (PARTITION BY tree) AS n, leaf AS d FROM p0),
{climb("n", "p", inner)},
tops AS (SELECT tree AS name, d, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, count(*) OVER () AS n FROM n{inner}),
m0 AS MATERIALIZED (SELECT '' AS tree, i, n, d FROM tops),
q0 AS MATERIALIZED (SELECT doc_id, '' AS tree, leaf, claim, tops.i AS i, proof, tops.d AS subroot FROM p{inner} p JOIN tops ON p.tree = tops.name),
{climb("m", "q", outer)}
SELECT doc_id, leaf, subroot, m.d AS root, sha256(proof) AS proof_sha256, claim AS folded_root, claim = m.d AS verified FROM q{outer}, m{outer} m
"""


def _trie_sql() -> str:
    return f"""
WITH crc AS ({_CRC_TABLE}),
t AS (
    SELECT conv_id, d, size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM (
        SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d, length(coalesce(text, '')) AS size FROM conversations WHERE conv_id IS NOT NULL)
), sizes AS (SELECT conv_id, n FROM t WHERE i = 1),
c AS (
    SELECT s.conv_id, s.conv_id - s.conv_id % {prefix_trie.FAMILY} AS family, coalesce(f.n, 0) AS fn, {_crc_sql("s.conv_id")} % {prefix_trie.OPENINGS} AS h
    FROM sizes s LEFT JOIN sizes f ON f.conv_id = s.conv_id - s.conv_id % {prefix_trie.FAMILY}, crc
), r AS (
    SELECT conv_id, 0 AS depth, '' AS d, 0 AS size FROM c
    UNION ALL SELECT c.conv_id, t.i, t.d, t.size FROM c JOIN t ON t.conv_id = c.family AND t.i <= c.h
    UNION ALL SELECT c.conv_id, t.i - c.h + least(c.h, c.fn), t.d, t.size FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h
), k AS MATERIALIZED (
    SELECT conv_id, depth, size, sha256(string_agg(d, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM r
), up AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM k),
nodes AS MATERIALIZED (
    SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, any_value(size) AS size, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends
    FROM up GROUP BY node
), kids AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
sums AS (
    SELECT a.node AS node, sum(CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END) AS leaves, sum((n.n_convs - 1) * n.size) AS saved
    FROM nodes n JOIN k a ON a.conv_id = n.conv_id AND a.depth <= n.depth LEFT JOIN kids ON kids.node = n.node GROUP BY a.node
)
SELECT n.conv_id AS conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs AS n_convs, CAST(coalesce(kids.n, 0) AS BIGINT) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN sums ON sums.node = n.node LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN kids ON kids.node = n.node
"""


_RULE = "CASE " + " ".join(
    f"WHEN (host = '{n}' OR ends_with(host, '.{n}')) AND starts_with(path, '/{p}') THEN '{{{i}}}'"
    for i, (n, _, p) in enumerate(r[0].partition("/") for r in sorted(URL_RULES, key=lambda r: -len(r[0])))
) + " END"
_SORTED = sorted(URL_RULES, key=lambda r: -len(r[0]))
_DOUBLES = ", ".join(f"'{d}'" for d in url_reputation.SHARED_SUFFIXES)
_SECOND = ", ".join(f"'{d}'" for d in url_reputation.SECOND_LEVELS)
_REST = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END"

ORACLE: dict[str, str] = {
    "op3_decontamination": rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
    SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS win
    FROM (SELECT item, w, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM bw),
firsts AS (SELECT DISTINCT split_part(win, ' ', 1) || ' ' || split_part(win, ' ', 2) AS two, n FROM bw),
pos AS (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM d WHERE len(w) > 0),
starts AS (
    SELECT p.doc_id, p.i, f.n, array_to_string(p.w[p.i : p.i + f.n - 1], ' ') AS win
    FROM pos p JOIN firsts f ON f.two = p.w[p.i] || ' ' || (CASE WHEN f.n > 1 THEN coalesce(p.w[p.i + 1], '') ELSE '' END)
    WHERE p.i + f.n - 1 <= len(p.w)
), hits AS (SELECT s.doc_id, s.i, s.n, bw.item FROM starts s JOIN bw ON bw.win = s.win AND bw.n = s.n),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw ON d.doc_id = hw.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
""",
    "op6_packing": _packing_sql(),
    "op9_exact_dedup": f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, digest AS text_sha256
FROM (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS digest FROM documents)
WINDOW same AS (PARTITION BY digest)
""",
    "op4_url_filter": f"""
WITH p AS (
    SELECT page_id, translate(regexp_extract(coalesce({_REST}, ''), '^[^/?#]*', 0), '{UPPER}', '{LOWER}') AS host,
           regexp_extract(coalesce({_REST}, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM pages
), marks AS (
    SELECT doc_id, max(CASE WHEN quality = 0 OR coalesce(toxic = 1, false) THEN 1 ELSE 0 END) AS bad FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), h0 AS (
    SELECT host, coalesce(sum(bad), 0)::DOUBLE AS bad, count(bad)::DOUBLE AS n
    FROM p LEFT JOIN marks ON try_cast(regexp_extract(path, '([0-9]+)[^0-9]*$', 1) AS BIGINT) = doc_id WHERE host <> '' GROUP BY host
), h1 AS (
    SELECT *, CASE WHEN len(string_split(host, '.')) <= 2 THEN host
        WHEN array_to_string(string_split(host, '.')[-2:], '.') IN ({_DOUBLES}) OR (len(string_split(host, '.')[-1]) = 2 AND string_split(host, '.')[-2] IN ({_SECOND})) THEN array_to_string(string_split(host, '.')[-3:], '.')
        ELSE array_to_string(string_split(host, '.')[-2:], '.') END AS domain FROM h0
), h AS (SELECT *, CASE WHEN instr(domain, '.') > 0 THEN substr(domain, instr(domain, '.') + 1) ELSE '' END AS suffix FROM h1),
overall AS (SELECT coalesce(sum(bad) / nullif(sum(n), 0), 0) AS parent, coalesce(sum(n), 0) + 1 AS weight FROM h),
s AS ({_shrunk("SELECT suffix, sum(bad) AS bad, sum(n) AS n, any_value(o.parent) AS parent, any_value(o.weight) AS weight FROM h, overall o GROUP BY suffix")}),
d AS ({_shrunk("SELECT domain, sum(h.bad) AS bad, sum(h.n) AS n, any_value(s.rate) AS parent, any_value(s.pages) AS weight FROM h JOIN s USING (suffix) GROUP BY domain")}),
r AS ({_shrunk("SELECT host, h.bad AS bad, h.n AS n, d.rate AS parent, d.pages AS weight FROM h JOIN d USING (domain)")}),
j AS (SELECT p.*, {_RULE.format(*[r[0] for r in _SORTED])} AS rule, {_RULE.format(*[r[1] for r in _SORTED])} AS decided FROM p)
SELECT page_id, j.host AS host, path, rule, coalesce(decided, CASE WHEN bound > {url_reputation.MAX_BAD} THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN r ON j.host = r.host
""",
    "op7_warc": f"""
SELECT page_id, size AS payload_bytes, digest AS payload_digest,
       CASE WHEN size >= {warc.LEAST_REVISIT} AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN size >= {warc.LEAST_REVISIT} AND page_id <> first_id THEN first_id END AS refers_to
FROM (SELECT page_id, strlen(coalesce(html, '')) AS size, sha256(coalesce(html, '')) AS digest, min(page_id) OVER (PARTITION BY sha256(coalesce(html, ''))) AS first_id FROM pages)
""",
    "op10_licenses": _license_sql(),
    "op11_suffix_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT r, i, hash(substr(x, 2 * i + 1, {2 * suffix_dedup.MIN_BYTES})) AS h, md5(substr(x, 2 * i + 1, {2 * suffix_dedup.MIN_BYTES})) AS m
    FROM (SELECT r, x, unnest(generate_series(0, len(x) // 2 - {suffix_dedup.MIN_BYTES})) AS i FROM d WHERE len(x) >= {2 * suffix_dedup.MIN_BYTES})),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY m) AS n FROM w SEMI JOIN (SELECT h FROM w GROUP BY h HAVING count(*) > 1) s USING (h)) WHERE n > 1),
runs AS (
    SELECT r, min(i) AS a, max(i) + {suffix_dedup.MIN_BYTES} AS b FROM (
        SELECT r, i, sum(CASE WHEN i - p <= {suffix_dedup.MIN_BYTES} THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS run
        FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS p FROM again))
    GROUP BY r, run
), cuts AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM runs),
kept AS (
    SELECT r, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, max(b) AS tail, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS front
    FROM cuts JOIN d USING (r) GROUP BY r
)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN x ELSE front || substr(x, 2 * tail + 1) END)) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
""",
    "op12_prefix_trie": _trie_sql(),
    "op13_merkle_manifest": _merkle_sql(),
}
