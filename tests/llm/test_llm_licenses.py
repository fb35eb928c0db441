"""Licence scan against a brute force without pruning."""

from __future__ import annotations

import functools
import random
import re
import time

import duckdb
import pandas as pd
from roadlens.llm import licenses as L
from roadlens.llm import queries as Q


def grams(text):
    words = re.findall("[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    return {f"{a} {b}" for a, b in zip(words, words[1:])} or set(words)


def brute(rows, templates, least=L.MIN_DICE):
    out = []
    for i, t in rows:
        lines = re.split(r"\r\n|\r|\n", t or "")
        units = list(enumerate(lines, 1)) + ([(0, t)] if len(lines) > 1 else [])
        for n, unit in units:
            a = grams(unit)
            for name, body in templates.items():
                b = grams(body)
                dice = 2 * len(a & b) / (len(a) + len(b)) if a else 0.0
                if dice >= least:
                    out.append((str(i), n, name, round(dice, 9)))
    return sorted(out)


def rows():
    rng = random.Random(4)
    out = [(1, None), (2, ""), (3, "!!\n--"), (4, "mit"), (None, "Released under the MIT License."), (5, "x " * 30_000 + "\nLicensed under CC BY-NC 4.0.")]
    for i, body in enumerate(L.TEMPLATES.values()):
        words = body.split()
        out.append((10 + i, "Some prose here.\n" + body.upper().replace(" ", "*** ") + "\nand more"))
        out.append((40 + i, "\r\n".join(" ".join(words[j : j + 9]) for j in range(0, len(words), 9))))
        for n in (1, 2, len(words) // 4):
            changed = list(words)
            for _ in range(n):
                changed[rng.randrange(len(changed))] = rng.choice(["foo", "the", ""])
            out.append((100 + 10 * i + n, " ".join(changed)))
    return out + [(10, "Released under the MIT License."), (10, "Released under the MIT License.")]


def test_matches_brute_force(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string").repartition(4)
    for least in (0.5, 0.8, 1.0):
        got = sorted((str(r.doc_id), r.line, r.license, round(r.dice, 9)) for r in L.matches(df, min_dice=least).collect())
        assert got == brute(rows(), L.TEMPLATES, least) and len(got) > 20


def test_one_row_per_document(spark):
    df = spark.createDataFrame([(*r, "x") for r in rows()], "doc_id long, text string, license string")
    out = L.scan(df)
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == len({i for i, _ in rows()}) == len(got)
    assert got[1].license is None and got[1].dice == 0.0 and got[1].n_matches == 0 and got[1].licenses == ""
    assert got[None].license == "mit" and got[None].dice == 1.0 and got[5].license == "cc-by-nc-4.0"
    every = brute(rows(), L.TEMPLATES)
    assert got[10].n_matches == sum(m[0] == "10" for m in every)


def test_empty_table(spark):
    assert L.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@functools.cache
def best_window(text, body):
    words, b = re.findall("[0-9a-z\x80-\U0010ffff]+", text.lower()), grams(body)
    size = len(re.findall("[0-9a-z]+", body.lower()))
    found = ({f"{x} {y}" for x, y in zip(w, w[1:])} or set(w) for w in (words[i : i + size] for i in range(len(words) - size + 1)))
    return max((2 * len(a & b) / (len(a) + len(b)) for a in found), default=0.0)


def brute_windows(text, templates, least=L.MIN_DICE):
    """Best Dice per template over all windows of as many words as the template has."""
    best = {name: best_window(text or "", body) for name, body in templates.items()}
    return {name: round(d, 9) for name, d in best.items() if d >= least}


def wrapped(body, width, mark="# "):
    words = body.split()
    return "\n".join(mark + " ".join(words[i : i + width]) for i in range(0, len(words), width))


def window_rows():
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice("the of software license version and copy under any public notice".split()) for _ in range(n))
    out = [(1, None), (2, "license"), (3, prose(250))]
    for i, body in enumerate(L.TEMPLATES.values()):
        changed = [w if rng.random() > 0.04 else "foo" for w in body.split()]
        out.append((10 + i, f"{prose(40)}\n{wrapped(body, 9)}\n{prose(30)}"))
        out.append((40 + i, f"{prose(50)} {' '.join(changed)} {prose(20)}"))
        out.append((70 + i, f"{wrapped(body, 7, '// ')}\n{prose(60)}\n{wrapped(body, 5)}"))
    return out


def test_wrapped_and_embedded_notices_match_brute_force(spark):
    rows, templates = window_rows(), L.TEMPLATES | {"word": "Unlicense"}
    rows.append((4, "this is the unlicense of " * 3 + "\n" + "prose " * 50))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for least in (0.6, 0.8, 1.0):
        got = {}
        for r in L.windows(df, templates, least).collect():
            of = got.setdefault(r.doc_id, {})
            of[r.license] = max(of.get(r.license, 0.0), round(r.dice, 9))
        assert got == {i: w for i, t in rows if (w := brute_windows(t, templates, least))} and len(got) > 20
    out = {r.doc_id: r for r in L.scan(df, templates).collect()}
    units = brute(rows, templates)
    for i, t in rows:
        lines = {m[2] for m in units if m[0] == str(i)}
        assert set(out[i].licenses.split(",")) - {""} == lines | set(brute_windows(t, templates))
        assert out[i].n_matches == sum(m[0] == str(i) for m in units) + len(set(brute_windows(t, templates)) - lines)
    assert all(name in out[10 + i].licenses.split(",") for i, name in enumerate(L.TEMPLATES))


def test_sql_covers_lines_texts_and_windows(spark):
    """The registered SQL on rows with wrapped, embedded and changed notices (no id twice with different texts)."""
    rows = [r for r in window_rows() if r[0] is not None]
    frame = pd.DataFrame(rows, columns=["doc_id", "text"])
    con = duckdb.connect()
    con.register("documents", frame)
    cur = con.execute(Q.ORACLE["op10_licenses"])
    names = [d[0] for d in cur.description]
    want = sorted((dict(zip(names, r)) for r in cur.fetchall()), key=lambda r: r["doc_id"])
    got = L.scan(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [{c: round(v, 9) if isinstance(v, float) else v for c, v in r.asDict().items()} for r in got] == [{c: round(v, 9) if isinstance(v, float) else v for c, v in r.items()} for r in want]
    assert sum(r["n_matches"] > 0 for r in want) > 30


def test_time_grows_with_the_length_of_a_text(spark):
    body = L.TEMPLATES["mit-whole"].split()
    rng = random.Random(6)

    def seconds(n):
        words = [rng.choice(body) if i % 50 else "software without" for i in range(n)]
        df = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
        began = time.time()
        L.windows(df).collect()
        return time.time() - began

    seconds(10_000)
    assert seconds(160_000) < 6 * seconds(40_000) + 5


def test_whole_short_licences(spark):
    head = "MIT License\n\nCopyright (c) 2020 A. Person\n\n"
    df = spark.createDataFrame([(i, head + wrapped(L.TEMPLATES[n], 11, "")) for i, n in enumerate(("mit-whole", "isc-whole"))], "doc_id long, text string")
    got = {r.doc_id: (r.license, r.licenses) for r in L.scan(df).collect()}
    assert [got[i][1] for i in (0, 1)] == ["mit-grant,mit-whole", "isc,isc-whole"]
