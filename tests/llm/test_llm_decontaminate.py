"""Decontamination against a word-by-word brute force."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc

from roadlens.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=13):
    out = []
    for i, t in docs:
        w, hit, seen = words(t), set(), set()
        for item, body in items:
            b = words(body)
            n = min(window, len(b))
            grams = {tuple(b[j : j + n]) for j in range(len(b) - n + 1)} if n else set()
            for j in range(len(w) - n + 1) if n else ():
                if tuple(w[j : j + n]) in grams:
                    hit.update(range(j, j + n))
                    if item is not None:
                        seen.add(str(item))
        digest = hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest()
        out.append((str(i), len(w), len(hit), len(seen), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def case():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)] + ["é", "日本", "x9"]
    text = lambda n: rng.choice([" ", ", ", "-"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 5, 13, 14, 40]))) for i in range(12, 30)]
    items += [(100, items[3][1]), (101, "..."), (102, None), (None, text(15)), (12, items[0][1])]
    docs = [(i, text(rng.choice([0, 1, 5, 12, 13, 60]))) for i in range(40)]
    docs += [(50 + i, text(100) + " " + (b or "").upper() + " " + text(20)) for i, (_, b) in enumerate(items)]
    docs += [(90, None), (91, ""), (92, "!!"), (None, items[5][1]), (93, items[5][1]), (93, items[5][1]), (94, (items[5][1] + " filler ") * 4000)]
    return docs, items


def test_matches_brute_force(spark):
    docs, items = case()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in D.contamination(d, b).collect())
    assert got == brute(docs, items)


def test_blocks_of_items_change_nothing(spark):
    docs, items = case()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(D.window_blocks(b, 13, 400))) > D.BLOCKS_PER_SCAN
    key = lambda df: sorted((str(r.row.doc_id), r.row.text or "", r.n_words, r.hits, r["items"]) for r in df.collect())
    assert key(D.scanned(d, b, 13, 400)) == key(D.scanned(d, b))


def test_dropping_and_cutting(spark):
    long = " ".join(f"q{i}" for i in range(14))
    docs = [(1, "clean text here", 7), (2, f"Some {long.upper()}, more.", 8), (3, "z " * 1000 + long, 9), (4, None, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, n_words int")
    b = spark.createDataFrame([(1, long)], "item_id long, text string")
    left = D.drop_contaminated(d, b)
    assert left.columns == d.columns and sorted(r.doc_id for r in left.collect()) == [1, 3, 4]
    cut = {r.doc_id: r.text for r in D.remove_spans(d, b).collect()}
    assert cut[1] == "clean text here" and re.sub(r"\s+", " ", cut[2]) == "Some , more." and cut[4] is None and "q3" not in cut[3]


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.contamination(d.limit(0), b).collect() == []
    row = D.contamination(d, b.limit(0)).first()
    assert (row.n_hit, row.n_items, row.contaminated, row.items_sha256) == (0, 0, False, hashlib.sha256(b"").hexdigest())


def test_pieces_and_hash_collisions_change_nothing(monkeypatch):
    rng = random.Random(12)
    vocabulary = ["a", "B", "ü", "c1", "d"]
    items = [(str(i), " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 40])))) for i in range(30)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 4, 60, 400]))) + rng.choice(["", "!", " --"]) for _ in range(60)]
    rows = [(i, t.encode()) for i, t in items]

    def results(base):
        windows = D.WindowSet.build(rows, 5, base)
        return windows.base, [(n, hits.tolist(), sorted(seen)) for n, hits, seen in (windows.scan(t.encode()) for t in texts)]

    _, want = results(D.BASE)
    assert any(h for _, h, _ in want) and any(not h for _, h, _ in want)
    base, got = results(1)  # a sum of word numbers: many windows collide, so another factor is taken
    assert got == want and base > 1
    for size in (1, 9, 100):
        monkeypatch.setattr(D, "PIECE_BYTES", size)
        assert results(D.BASE)[1] == want


def test_window_sets_and_long_texts_take_little_memory():
    rng = random.Random(13)
    vocabulary = [f"word{i}" for i in range(20_000)]
    items = [(str(i), " ".join(rng.choice(vocabulary) for _ in range(2_000)).encode()) for i in range(100)]
    size = sum(len(t) for _, t in items)
    tracemalloc.start()
    windows = D.WindowSet.build(items, 13)
    tracemalloc.reset_peak()
    held = tracemalloc.get_traced_memory()[0]
    text = b"word1 word2 something else " * 300_000 + items[0][1]
    before = tracemalloc.get_traced_memory()[0]
    tracemalloc.reset_peak()
    assert windows.scan(text)[2] == {"0"}
    most = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert held < 20 * size and most < 12 * len(text)
