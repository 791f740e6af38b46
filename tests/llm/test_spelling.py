"""Spelling variants against all pairs of words compared letter by letter."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidegauge.llm import spelling


def one_apart(u, v):
    if u == v or abs(len(u) - len(v)) > 1:
        return False
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v, strict=True)) == 1
    u, v = sorted((u, v), key=len)
    return any(v[:k] + v[k + 1 :] == u for k in range(len(v)))


def plain(words):
    """words: {word: n}."""
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words.get(form[w]))
    return out


def by_hand(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return plain({w: k for w, k in n.items() if len(w) >= 5 and k >= 3})


@pytest.mark.parametrize(("seed", "letters", "sizes"), [(1, "ab", (5, 9)), (2, "abcdeé", (5, 7)), (3, "a", (5, 30)), (4, "abcÿ", (5, 6))])
def test_near_words(spark, seed, letters, sizes):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(*sizes))): rng.choice([3, 3, 4, 6, 7, 12, 50]) for _ in range(700)}
    rows = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(rows).collect()}
    assert got == plain(words)


def test_a_file_of_many_slices_and_chance_meetings():
    """One file with all words, as if all hashes met: each pair is still found in the range of its difference only."""
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abc") for _ in range(size)) for size in (6, 7) for _ in range(300)}, key=lambda w: rng.random())
    longer = np.array([len(w) == 7 for w in words])
    found = Counter()
    for start in (0, 3):
        for one, other in spelling.pairs(words, longer, np.array([len(words)]), 6, start, start + 3):
            found.update((words[a], words[b]) for a, b in zip(one, other, strict=True))
    assert set(found.values()) == {1}
    assert set(found) == {(u, v) for u in words for v in words if one_apart(u, v) and min(len(u), len(v)) == 6}


def test_documents(spark):
    rng = random.Random(2)
    base = ["".join(rng.choice("aeionrstÉé") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    texts = [" ".join(rng.choice(base) for _ in range(rng.randint(0, 60))) for _ in range(120)]
    texts += [None, "", " . ", base[0] * 3 + "x", "Word, " * 3000, "Word, " * 3000, "Größe×Maß ÷ naïve Naïve NAÏVE " * 5, "ŁŁŁŁŁŁ " * 5]
    rows = [(k, t) for k, t in enumerate(texts)] + [(3, texts[3]), (3, texts[3])]
    docs = spark.createDataFrame([(d, t, "w", 1, "r") for d, t in rows], "doc_id long, text string, word string, n long, root string").repartition(3)
    words = spelling.counted(docs)
    got = spelling.variants(words.where("length(word) >= 5 and n >= 3"))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got.collect()} == by_hand(rows)
    assert spelling.variants(spelling.counted(docs.limit(0))).count() == 0


def test_query_against_duckdb(spark):
    import duckdb

    con, path = duckdb.connect(), "/root/testdata/sf0.001"
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    got = spelling.op11_spelling_variants(spark, path)
    want = con.sql(spelling.oracle_sql())
    assert got.columns == want.columns and {tuple(r) for r in got.collect()} == set(want.fetchall())
