"""The ten corpus operators and the pipeline against plain Python, with nulls, empty and long texts, ties, repeats, clashing columns."""

import collections
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidegauge.llm import ann, html, jaccard, langid, licences, media, mixing, packing, sharding, simhash, urls
from tidegauge.llm.graph import components

DOC = "doc_id long, text string, lang string, source string, n_chars long, size long, component_id string, shard string, key string, row string"
WORDS = "the of and haonn thedin eronst tion blees anhat mit license cc by gnu general public apache".split()


def texts():
    rng = np.random.default_rng(3)
    base = [" ".join(rng.choice(WORDS, int(n))) for n in rng.integers(1, 80, 30)]
    special = [None, "", " \n\t", "CC BY", "cc.by the MIT License, MIT License", "x", "x y", "GNU  General\nPublic-License", "é ü ñ", "123 456", "long " * 5000, base[0], base[0], base[1] + " extra"]
    return base + special


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ("en", "de", None)[i % 3], ("b", "a", None, "hot", "hot")[i % 5], 0, 1, "c", "s", "k", "r") for i, t in enumerate(texts())]
    rows += [rows[5], rows[5], (None, "no id", None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def test_licences(docs, none):
    for r in licences.scan(docs).collect():
        if r.doc_id is None:
            continue
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(texts()[r.doc_id]))
        at, labels = [], set()
        for phrase, label in licences.PHRASES.items():
            p = phrase.split()
            found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            at += found
            labels |= {label} if found else set()
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(at), ",".join(sorted(labels)))
        assert (r.first_word, r.last_word) == (min(at, default=None), max(at, default=None))
        assert labels <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert licences.scan(none).count() == 0


def test_licence_notice_needs_its_key_phrase(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"
    rows = spark.createDataFrame([(1, f"Intro. {mit}. End."), (2, mit.replace("hereby granted", "never given")), (3, "plain text")], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licences.scan(rows).collect()}
    assert got == {1: "mit-notice", 2: "", 3: ""}


def test_whole_licence_texts_and_a_table_of_ones_own(spark):
    mit, isc = (next(t for label, t, _ in licences.TEXTS if label == name) for name in ("mit-text", "isc-text"))
    rows = [(1, f"Copyright 2020 someone. {mit} End."), (2, mit.replace("merge, publish,", "").replace("THE AUTHORS", "THE GOOD PEOPLE AND AUTHORS")), (3, isc), (4, mit[:300]), (5, "House rules: feed the cat. " + "other words " * 30)]
    own = spark.createDataFrame([("house", "house rules feed the cat", ["feed the cat"])], "label string, text string, keys array<string>")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: set(r.labels.split(",")) for r in licences.scan(docs, notices=[*licences.NOTICES, *licences.TEXTS, *licences.notices_from(own)]).collect()}
    assert "mit-text" in got[1] and "mit-text" in got[2] and got[3] == {"isc-notice", "isc-text"} and "mit-text" not in got[4] and got[5] == {"house"}
    with pytest.raises(ValueError):
        licences.notices_from(own, 0)


def test_alignment_needs_two_words():
    known = licences.templates({"red green blue": "rgb", "alone": "one"}, [])
    index = licences.build_index(known, 100, {b"red": 5, b"green": 9, b"blue": 2, b"alone": 1})
    assert set(index.postings) == {b"blue", b"alone"} and index.looked_up == {b"blue", b"red", b"alone"}
    assert licences.aligned(index, b"blue x red green blue blue".split()) == {(0, 2)}
    assert licences.scan_words(index, b"red green blue alone red x blue".split())[0] == [0, 3]


def plain_print(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(values, bits):
    """Smallest index linked to each of the values."""
    up = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= bits:
                a, b = i, j
                while up[a] != a:
                    a = up[a]
                while up[b] != b:
                    b = up[b]
                up[max(a, b)] = min(a, b)

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    return [top(i) for i in range(len(values))]


def test_simhash(docs, none):
    prints = [plain_print(t) for t in texts()]
    want = roots(prints, 2)
    for r in simhash.near_duplicates(docs).collect():
        if r.doc_id is not None:
            assert r.fp & (2**64 - 1) == prints[r.doc_id] and r.component_id == want[r.doc_id]
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("bits,limit", [(2, 1024), (2, 4), (3, 4), (1, 1024)])
def test_no_link_is_lost(spark, bits, limit):
    rng = np.random.default_rng(bits)
    values = {0}
    for centre in rng.integers(0, 2**63, 12, dtype=np.uint64).tolist():
        for _ in range(40):
            v = centre
            for b in rng.integers(0, 64, int(rng.integers(0, 6))):
                v ^= 1 << int(b)
            values.add(v)
    values = sorted(values)
    frame = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fp long").repartition(3)
    found = {r.node & (2**64 - 1): r.root for r in components(simhash.links(frame, bits, limit)).collect()}
    want = roots(values, bits)
    groups = collections.defaultdict(set)
    for v, r in zip(values, want, strict=True):
        groups[r].add(v)
    got = collections.defaultdict(set)
    for v in values:
        got[found.get(v, v - 2**64 if v >= 2**63 else v)].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


@pytest.mark.parametrize("seed,few", [(0, 1000), (1, 0), (2, 20)])
def test_components_grow(spark, seed, few):
    """Stars, chains, hubs, loops and repeats; later edges are added to the components of the earlier ones."""
    import numpy as np

    rng = np.random.default_rng(seed)
    ends = lambda low, high, n: [tuple(map(int, e)) for e in rng.integers(low, high, (n, 2))]
    first = ends(0, 60, 25) + [(k, k + 1) for k in range(100, 120)] + [(200, k) for k in range(201, 230)] + [(7, 7), (None, 3), (3, None)]
    second = ends(0, 130, 6) + [(120, 215), (228, 300), (9, 9)]
    frame = lambda e: spark.createDataFrame(e, "u long, v long").repartition(3)

    def plain(edges):
        root = {n: n for e in edges for n in e if n is not None}
        for _ in root:
            for u, v in edges:
                if u is not None and v is not None:
                    root[u] = root[v] = min(root[u], root[v])
        return {n: r for n, r in root.items() if n != r}

    roots = components(frame(first), few_edges=few)
    assert {r.node: r.root for r in roots.collect()} == plain(first)
    more = components(frame(second), roots, few_edges=few)
    assert {r.node: r.root for r in more.collect()} == plain(first + second) and more.count() == len(plain(first + second))
    assert components(frame([]), roots).count() == roots.count() and components(frame([]), components(frame([]))).count() == 0


def test_last_cell_of_a_batch_is_bounded():
    """A run over the limit is passed on wherever it stands in its batch, in pieces or whole."""
    import pyarrow as pa

    prints = np.arange(300, dtype=np.int64)
    for cuts in ([300], [100, 300], [50, 51, 300], [300]):
        parts, start = [], 0
        for end in cuts:
            parts.append(pa.RecordBatch.from_arrays([pa.array(np.zeros(end - start, np.int64)), pa.array(prints[start:end])], ["anchor", "fp"]))
            start = end
        out = list(simhash._compare(iter(parts), 2, 60))
        assert all(b.column("hot")[0].as_py() for b in out) and sum(b.num_rows for b in out) == 300 * 65


def test_near_dedup_of_short_texts_of_one_form(spark):
    """Texts that share all shingles but one, none alike by 0.8, and pairs among them that are."""
    form = "thank you for your order number is confirmed {} please keep this letter for your records until it has come {}"
    rows = [(k, form.format(f"x{k}", "")) for k in range(1500)] + [(5000 + k, form.format(f"x{k}", "soon")) for k in range(0, 1500, 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
    assert all(got[5000 + k] == k for k in range(0, 1500, 100)) and all(got[k] == k for k in range(1500))


def test_near_dedup_whatever_the_rows(spark):
    """Copies go by text, not by doc_id alone; names cannot clash; maps and dots are no obstacle; one row of a group stays."""
    import corpus_pipeline

    t, u = "one two three four five six seven", "another text of quite other words it is"
    docs = spark.createDataFrame([(3, t, "a", 1, 2, {"k": 1}), (5, t, "b", 3, 4, {"k": 2}), (5, u, "c", 5, 6, None), (5, u, "c", 5, 6, None), (5, u + ".", "c", 5, 6, None), (None, "", "d", 7, 8, {}), (None, None, "d", 7, 8, {})], "doc_id long, text string, `a.b` string, _id long, _same long, m map<string,int>").withColumns({"_keep": F.lit(1), "root": F.lit(2), "tie": F.lit("x"), "row": F.lit(0), "lang": F.lit("en"), "told": F.lit("y")})
    got = corpus_pipeline.near_dedup(spark, docs, "")
    assert got.columns == docs.columns
    rows = got.collect()
    assert sorted((r.doc_id or 0, r._id) for r in rows) == [(0, 7), (3, 1), (5, 5), (5, 5)] and {r.text for r in rows if r.doc_id == 5} == {u, u + "."}
    kept = corpus_pipeline.language_id(spark, docs.withColumn("lang", F.lit("xx")), "")
    assert kept.columns == docs.columns and {r.lang for r in kept.collect()} == {"xx"} and kept.count() == 5
    assert mixing.mixed(docs.withColumn("source", F.lit("s"))).columns == [*docs.columns, "source"]


def test_empty_documents_are_drawn_alike_however_they_come(spark):
    docs = spark.createDataFrame([(i % 7 if i % 3 else None, "", "a" if i % 2 else "b", i) for i in range(200)] + [(900, "some words", "a", 0), (901, "many more words than the others have", "b", 0)], "doc_id long, text string, source string, n long").repartition(4)
    runs = []
    for batch in (10_000, 3):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        runs.append(sorted(map(str, mixing.mixed(docs).collect())))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    assert runs[0] == runs[1]


def test_pairing_keeps_expected_copies():
    """Over many seeds the words taken from each document come to its expectation."""
    sizes, masses = [9.0, 7.0, 5.0, 4.0, 2.0], [3.0, 6.0, 1.0, 2.0, 1.5]
    taken = np.zeros(5)
    for run in range(4000):
        held = (0, masses[0])
        for i in range(1, 5):
            a, b = mixing._pair(held[1], sizes[held[0]], masses[i], sizes[i], mixing._draw(run, i))
            done, left = ((held[0], a), (i, b)) if a in (0.0, sizes[held[0]]) else ((i, b), (held[0], a))
            taken[done[0]] += done[1]
            held = left
        taken[held[0]] += sizes[held[0]] * (mixing._draw(run, "last") * sizes[held[0]] < held[1])
    assert np.abs(taken / 4000 - masses).max() < 0.25


def test_near_dedup_at_similarity(spark):
    """The pipeline's stage keeps what plain Python keeps at five words and 0.8, with copies on either side of the bound."""
    import corpus_pipeline

    rng, rows = np.random.default_rng(8), []
    for _ in range(25):
        base = [f"w{k}" for k in rng.integers(0, 400, int(rng.integers(6, 150)))]
        for changed in (0, 0, 1, 1, 2, 3, 5):
            copy = list(base)
            for at in rng.integers(0, len(base), changed):
                copy[at] = f"new{rng.integers(1000)}"
            rows.append(" ".join(["the same words at the start of it all"] * (changed % 2) + copy))
    rows += ["", None, "a b", "a b c"]

    def cut(t):
        w = (t or "").split()
        return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets, root = [cut(t) for t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert sorted(r.doc_id for r in got) == sorted(set(root)) and len(set(root)) < len(set(rows))
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def test_urls(spark):
    rows = [(1, "https://A.example.org/es/1", None), (2, "http://x.net/p", '<a href="http://bad.com/">'), (3, "http://bad.com/de/1?q", "<a href='//x.net/z'>"), (4, None, None), (5, "nothing", ""), (6, "http://example.org/en/12", None), (6, "http://example.org/en/12", None), (7, "http://notorg/", None), (8, "x://h?q://z", None), (9, "http://y.org/#a", None)]
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, host string, verdict string").select("page_id", "url", "html", F.lit("x").alias("rule"))
    got = {r.page_id: r for r in urls.filter_urls(pages).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert (got[2].rule, got[2].verdict) == (None, "block") and got[2].distrust > got[2].trust
    assert (got[3].path, got[3].rule, got[3].verdict) == ("/de/1", "com/de/", "block")
    assert (got[4].host, got[4].path, got[4].verdict) == ("", "", "allow") == (got[5].host, got[5].path, got[5].verdict)
    assert got[6].rule == "example.org/en/1" and got[7].rule is None and (got[8].host, got[8].path) == ("h", "") and got[9].verdict == "allow"
    assert urls.filter_urls(pages.limit(0)).count() == 0


def test_urls_whatever_the_size_and_the_distance(spark):
    """Distrust of 8e-10 (many blocked pages, many links to the one linked) and a host 14 hops away still block."""
    rows = [(i, f"http://w.com/de/{i}", None) for i in range(2000)] + [(3000, "http://bad.com/de/", None), (3001, "http://y.org/", '<a href="//bad.com">' * 300_000), (3002, "http://x.net/", '<a href="//bad.com">')]
    rows += [(4000 + i, f"http://h{i}.net/", f'<a href="//{f"h{i - 1}.net" if i else "w.com"}/">') for i in range(14)] + [(5000, "http://far.net/", "<a href='//elsewhere.net'>")]
    got = {r.page_id: r for r in urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert 0 < got[3002].distrust < 1e-9 and got[3002].verdict == "block"
    assert [got[4000 + i].verdict for i in range(14)] == ["block"] * 14
    assert got[5000].verdict == "allow" and got[3001].verdict == "allow"


def test_mixing(docs, none):
    runs = [sorted(map(tuple, mixing.mix(docs.repartition(n), bucket_rows=8, fan_in=2).fillna({"doc_id": -1, "source": "~"}).collect())) for n in (1, 5)]
    assert runs[0] == runs[1]
    rows = mixing.mix(docs, bucket_rows=8, fan_in=2).collect()
    assert len(rows) == docs.count()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    total = sum(r.size for r in rows)
    assert abs(sum(v[0].target for v in by.values()) - total) < 1e-6
    for v in by.values():
        assert {r.source_size for r in v} == {sum(r.size for r in v)} and all(0 <= r.copies <= 3 for r in v)
        assert v[0].target <= 3 * v[0].source_size + 1e-6
        assert abs(sum(r.copies * r.size for r in v) - v[0].target) <= max(r.size for r in v)
    assert mixing.mix(none).count() == 0
    out = mixing.mixed(docs)
    assert out.columns == docs.columns


def test_water_filling(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1), ("c", 100), (None, 50)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert got["b"] == 3 and abs(sum(got.values()) - 161) < 1e-9 and got["a"] == 30
    assert abs(got["c"] / got[None] - 3) < 1e-9  # weights 3 and 1


def test_sharding(docs, none):
    rows = sharding.interleave(docs, 4, bucket_rows=8).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
        t = "no id" if r.doc_id is None else texts()[r.doc_id] or ""
        assert (r.size, r.text_crc32) == (len(t.encode()) + 1, zlib.crc32(t.encode()))
    sizes = [len(v) for v in by.values()]
    assert len(by) == 4 and max(sizes) - min(sizes) <= 1 and len(rows) == docs.count()
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    # the order: hash order in each source, then by fractional rank over all sources
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r.source].append((r.shard, r.slot))
    order = sorted(((i + 0.5) / len(v), k or "", p) for k, v in groups.items() for i, p in enumerate(sorted(v)))
    assert [p for _, _, p in order] == sorted(p for _, _, p in order)
    hot = [sum(r.source == "hot" for r in v) for v in by.values()]
    assert max(hot) - min(hot) <= 2
    assert sharding.interleave(none).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a></li><li><a href="/x">About</a></li></ul></nav><div class="cookie notice"><p>We use cookies</p></div>
<article><h1>{t} &amp; more</h1><p><b>First   {t}<br><p>Second&nbsp;block of {t}.</p><div class="ad">Buy now</div><ul><li>point one</li></ul></article>
<aside class="sidebar"><p>Related posts</p></aside><section class="comments"><p>Nice post!</p></section><form><p>Subscribe</p></form><footer>&copy; me</footer></body></html>"""


def test_html(spark):
    rows = [(i, f"u{i}", PAGE.format(t=f"story {i} of words, the and of")) for i in range(40)] + [(90, "n", None), (91, None, ""), (92, "b", "<p>cut off &am"), (1, "u1", PAGE.format(t="again")), (93, "x", "<<>>< a <b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {(r.page_id, r.url): r for r in html.extract(pages, sample=20, drawn=300).collect()}
    right = 0
    for i in range(2, 40):
        t = f"story {i} of words, the and of"
        right += got[i, f"u{i}"].text == f"{t} & more\nFirst {t}\nSecond block of {t}.\npoint one"
    assert right >= 36
    assert got[90, "n"].text == "" == got[91, None].text and got[90, "n"].n_chars == 0
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert html.extract(pages.limit(0), drawn=5).count() == 0


ICONS = ['<svg class="icon"/>', "<math/>", "<object data=x>", "<select>", "<video>", '<video-player src="a"></video-player>', "<svg><text>hidden</text></svg>", "<svg/><svg>hidden</svg>"]


@pytest.mark.parametrize("icon", ICONS)
def test_html_text_after_an_icon_stays(icon):
    path = ["html", "body", "article", "p"]
    got = html.leaves(f"<html><body><article><p>First part</p>{icon}<p>Second part</p><p>Third <b>part</b></p></article></body></html>")
    assert [t for _, t, _ in got] == ["First part", "Second part", "Third part"]
    assert all([e[0] for e in p] == path for p, _, _ in got) or icon.startswith("<video-")


def test_html_formulas_and_objects_are_text():
    page = "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> hold</p><object data='a.pdf'><p>Fallback text</p></object><script>var a</script></article>"
    assert [t for _, t, _ in html.leaves(page)] == ["Let x=1 hold", "Fallback text"]
    assert html.leaves("<p>a</p>" + "<select>" * 20_000)[0][1] == "a"


def test_html_article_with_icons(spark):
    rows = [(i, f"u{i}", PAGE.format(t=f"story {i} of words, the and of").replace("<p>Second", "<svg class='icon'/><math><mi>x</mi></math><p>Second")) for i in range(40)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), sample=20, drawn=300).collect()
    assert sum("Second block of" in r.text and "point one" in r.text for r in got) >= 36


def test_lstm_gradient():
    rng = np.random.default_rng(1)
    net, reader = html.Labeller(2), html.Reader()
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    drawn = [html.draw_page(rng, [WORDS]) for _ in range(3)]
    pages, labels = [reader.page(html.leaves(b)) for b, _ in drawn], [y for _, y in drawn]
    assert all(len(p[0]) == len(y) for p, y in zip(pages, labels, strict=True))
    grad, _ = net.gradients(pages, labels)
    for name in ("xf", "hb", "cb", "out", "path", "word"):
        rows = {"path": pages[0][0][0], "word": pages[0][1]}.get(name, np.arange(net.w[name].shape[0]))
        at = (int(rng.choice(rows)), *(int(rng.integers(n)) for n in net.w[name].shape[1:]))
        old, loss = net.w[name][at], []
        for d in (1e-3, -1e-3):
            net.w[name][at] = old + d
            loss.append(net.gradients(pages, labels)[1])
        net.w[name][at] = old
        assert abs((loss[0] - loss[1]) / 2e-3 - grad[name][at]) < 1e-3


def plain_profile(t, top):
    run = re.sub(r"[\W\d_]+", " ", f" {t.lower()} ")
    grams = collections.Counter(run[i : i + n] for n in (1, 2, 3) for i in range(len(run) - n + 1))
    grams = {g: c for g, c in grams.items() if g != " " and not (len(g) == 3 and g[1] == " ")}
    code = lambda g: sum((0 if c == " " else ord(c)) << 20 * k for k, c in enumerate(reversed(g))) | len(g) << 60
    return [g for _, _, g in sorted((-c, code(g), code(g)) for g, c in grams.items())][:top]


def test_out_of_place_distance():
    """The model against the plain sum of rank differences."""
    rng = np.random.default_rng(4)
    own = lambda: ["".join(rng.choice(list("abcdeé "), 60)) + "x" for _ in range(6)]
    profiles = {f"l{k}": langid.profile(*langid.ngrams(" ".join(own())), 40) for k in range(4)}
    model = langid.Model(profiles, 40)
    for t in own() * 5:
        mine, cost = plain_profile(t, 40), {}
        for lang, codes in profiles.items():
            rank = {g: i for i, g in enumerate(codes.tolist())}
            cost[lang] = sum(abs(rank[g] - i) if g in rank else 40 for i, g in enumerate(mine))
        best = min(sorted(cost), key=cost.get)
        assert model.predict(t) == (best, pytest.approx(1 - cost[best] / (40 * len(mine))))


def test_language_id(docs, none, spark):
    for t in ("The End, of it", "é ü ñ", "a1b2", "ÄÖ straße", "мир и война", "".join(map(chr, range(0x4E00, 0x4E60)))):
        assert langid.profile(*langid.ngrams(t), 30).tolist() == plain_profile(t, 30)
    rows = langid.identify(docs).collect()
    assert {r.lang_pred for r in rows} <= {"en", "de", "und"} and all(0 <= r.score <= 1 for r in rows)
    for r in rows:
        if r.doc_id is not None:
            t = texts()[r.doc_id]
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in t or ""))
    assert langid.identify(none).count() == 0
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


SPECIAL = ["hello <|endoftext|> x", "<|endoftext|>", "<|endoftext", "a<|endoftext|><|endoftext|>b"]


def test_packing(spark, docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    every = texts() + SPECIAL
    more = spark.createDataFrame([(len(texts()) + i, t) for i, t in enumerate(SPECIAL)], "doc_id long, text string")
    docs = docs.withColumn("bucket", F.lit("clash")).unionByName(more, allowMissingColumns=True)
    rows = packing.pack(docs.repartition(2), bucket_docs=16, shard_docs=7).collect()
    pieces, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    for i, t in enumerate(every):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        assert sum(r.length for r in pieces[i]) == len(ids) * (3 if i == 5 else 1)
        for r in pieces[i]:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    for s in seqs.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == [sum(x.length for x in s[:k]) for k in range(len(s))] and sum(r.length for r in s) <= 1024
    assert sum(sum(r.length for r in s) < 1024 for s in seqs.values()) <= len({q >> 32 for q in seqs})  # one open window a bucket
    assert sorted(map(str, rows)) == sorted(map(str, packing.pack(docs.repartition(5), bucket_docs=16, shard_docs=7).collect()))
    assert packing.pack(none).count() == 0


def plain_bm25(query, docs, df, n, mean):
    out = []
    for d in docs:
        total = 0.0
        for t in set(query):
            idf = max(0.0, np.log((n - df[t] + 0.5) / (df[t] + 0.5)))
            tf = list(d).count(t)
            total += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
        out.append(total)
    return out


def drawn_docs(seed, n=40):
    rng = np.random.default_rng(seed)
    return [np.r_[np.minimum(rng.zipf(1.3, int(rng.integers(1, 60))), 99), 0].astype(np.uint16) for _ in range(n)]


def counted(docs):
    df = np.zeros(100, np.int64)
    for d in docs:
        df[np.unique(d)] += 1
    return df, float(np.mean([len(d) for d in docs]))


def test_bm25():
    docs = drawn_docs(2)
    df, mean = counted(docs)
    index = packing.Bm25(docs[:15], packing.idf(len(docs), df), mean)
    for q in docs[10:20]:
        assert np.allclose(index.scores(np.unique(q).astype(np.int64)), plain_bm25(q.tolist(), [d.tolist() for d in docs[:15]], df, len(docs), mean))


@pytest.mark.parametrize("seed", range(4))
def test_fill_takes_the_seeds_neighbours(seed):
    """Piece by piece against plain Python: a window's seed is the document that opens it, then its best unused follow."""
    docs, window = drawn_docs(seed), 64
    df, mean = counted(docs)
    shards, packer = [docs[:25], docs[25:]], packing.Packer(0, window)
    got = [p[0] for k, shard in enumerate(shards) for p in packing.fill([((k, i), d) for i, d in enumerate(shard)], packer, packing.idf(len(docs), df), mean)]
    want, used, opened = [], 0, None
    for k, shard in enumerate(shards):
        left = list(range(len(shard)))
        while left:
            if opened is None:
                at = left[0]
            else:
                scores = plain_bm25(opened, [d.tolist() for d in shard], df, len(docs), mean)
                at = max(left, key=lambda i: (round(scores[i], 9), -i))
            left.remove(at)
            size = len(shard[at])
            while size:
                opened = shard[at].tolist() if not used else opened
                take = min(size, window - used)
                want.append((k, at))
                size, used = size - take, (used + take) % window
                opened = opened if used else None
    assert got == want


def test_documents_that_share_rare_ids_share_a_bucket(spark):
    """Pairs with a rare word of their own lie far apart in the table and still in one bucket, hot texts in several."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rare = [w for i in range(20000, 40000) if (w := tok.decode([i])).isascii() and w[1:].isalpha() and w.startswith(" ")][:50]
    rows = [(i, f"a pair of texts{rare[i % 50]}") for i in range(100)] + [(1000 + i, "the same text again") for i in range(300)]
    keys = spark.createDataFrame(rows, "doc_id long, text string")
    out = packing.pack(keys.repartition(3), bucket_docs=20).select("doc_id", (F.col("sequence_id") / 2**32).cast("int").alias("bucket")).distinct().collect()
    of = {r.doc_id: r.bucket for r in out}
    assert sum(of[i] == of[i + 50] for i in range(50)) >= 45
    assert len({of[1000 + i] for i in range(300)}) >= 10


def test_media(docs, none, spark):
    import hashlib

    for r in media.digests(docs).collect():
        raw = ("no id" if r.doc_id is None else texts()[r.doc_id] or "").encode()
        full = raw + b"\xff" * (576 if not raw else -len(raw) % 576)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-32:]))
        declared, stored = media.store(full)
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        assert r.declared == declared and r.type == media.STORED_TYPES[zlib.crc32(full) % 4] and f"corrected={str(r.type != declared).lower()}" in r.feature
    assert media.digests(none).count() == 0
    gif = b"GIF89a\x01\x00\x01\x00\x80\x00\x00" + bytes(6) + b"\x2c" + bytes(8) + b"\x00\x02\x02\x4c\x01\x00\x3b"
    files = [(1, "image/png", media.wav(b"a" * 576)), (2, None, b"junk BM P5 RIFF" + gif + b"tail" + media.au(b"x" * 576)), (3, "text/plain", b"BM is no bitmap"), (4, None, None), (5, "image/bmp", media.bmp(b"q" * 1152)[:-1])]
    got = {r.id: r for r in media.carve(spark.createDataFrame(files, "id long, declared string, data binary")).collect()}
    assert (got[1].type, got[1].corrected, got[1].embedded) == ("audio/wav", True, [])
    assert [(e.type, bytes(e.data)) for e in got[2].embedded] == [("image/gif", gif), ("audio/basic", media.au(b"x" * 576))]
    assert got[3].type == "text/plain" and not got[3].corrected and got[4].type == media.UNKNOWN and got[5].embedded == []


def test_media_within_a_text_and_hostile_files(spark):
    import time

    inner = media.pgm(b"q" * 576).decode()
    r = media.digests(spark.createDataFrame([(1, "before " + inner + " after")], "doc_id long, text string")).first()
    assert r.embedded == 1 and r.feature.endswith("carved=1:image/x-portable-graymap")
    began = time.time()
    for piece in (b"\xff\xfe\x00\x04\xff\xd8", b"OggS\0\0" + bytes(21), b"\0\0\0\x08ftyp", b"\xff\xd8\xff\xe0\xff\xff", b"GIF89a\0\0\0\0\0\0\0\x21\xf9\x0d", b"BM", b"RIFF"):
        assert media.sniff(piece * (600_000 // len(piece))) == []
    assert time.time() - began < 30


def test_nearest(spark):
    rng = np.random.default_rng(5)
    v = rng.standard_normal((600, 8)).astype(np.float32)
    v[100:300] = v[100]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(600, None), (620, [0.0] * 8), (640, [float("nan")] * 8), (660, [None] * 8), (680, []), (0, v[0].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash"))
    got = collections.defaultdict(list)
    for r in ann.nearest(table, lambda c: c % 20 == 0, depth=3).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r)
    assert sorted(got) == list(range(0, 600, 20))
    hits = 0
    for q, found in got.items():
        s = v.astype(float) @ v[q].astype(float)
        best = [i for i in np.lexsort((np.arange(600), -np.round(s, 12))) if i != q][:20]
        hits += len(set(best) & {r.vec_id for r in found})
        assert [r.rank for r in found] == list(range(1, 21)) and all(abs(r.score - s[r.vec_id]) < 1e-9 for r in found)
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
    assert hits / (20 * len(got)) >= 0.9
    assert ann.nearest(table.limit(0), lambda c: c % 20 == 0).count() == 0


@pytest.mark.parametrize("kind", ["unit", "lengths", "isotropic", "offset", "clusters"])
def test_recall_whatever_the_lengths(spark, kind):
    """0.93 of the 20 largest inner products, on tables whose vectors differ in length or lie off the origin."""
    rng = np.random.default_rng(6)
    v = rng.standard_normal((1600, 48))
    if kind in ("unit", "lengths"):
        v /= np.linalg.norm(v, axis=1, keepdims=True)
    if kind in ("lengths", "isotropic"):
        v *= rng.lognormal(0, 0.5, (len(v), 1))
    if kind == "offset":
        v += 3 * rng.standard_normal(48)
    if kind == "clusters":
        v += 2 * rng.standard_normal((30, 48))[rng.integers(0, 30, len(v))]
    v = v.astype(np.float32)
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    got = collections.defaultdict(set)
    for r in ann.nearest(rows, lambda c: c % 20 == 0).collect():
        got[r.query_id].add(r.vec_id)
    products = v.astype(float) @ v.astype(float).T
    np.fill_diagonal(products, -np.inf)
    hits = [len(got[q] & set(np.argsort(-products[q])[:20].tolist())) / 20 for q in range(0, len(v), 20)]
    assert np.mean(hits) >= 0.93


@pytest.mark.parametrize("n,width,seed", [(2, 8, 1), (5, 8, 11), (5, 8, 12), (10, 64, 1), (22, 64, 2), (25, 64, 4)])
def test_nearest_in_small_tables(spark, n, width, seed):
    """Every query gets min(20, n - 1) rows, whatever the forest."""
    v = np.random.default_rng(seed).standard_normal((n, width)).astype(np.float32)
    rows = ann.nearest(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>"), lambda c: c % 20 == 0, leaf_rows=4, query_rows=1).collect()
    for q in range(0, n, 20):
        got = [r.vec_id for r in sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)]
        assert len(got) == min(20, n - 1) and len(set(got)) == len(got) and q not in got
        if n <= 21:
            assert got == [i for i in np.argsort(-(v.astype(float) @ v[q].astype(float)), kind="stable") if i != q]


def test_nearest_of_equal_and_double_vectors(spark):
    """Equal queries drop their own id each; doubles are not rounded; the smallest vector of an id counts."""
    rows = [(i, [1.0, 1e-12 * (i % 2)]) for i in range(60)] + [(7, [9.0, 9.0])]
    got = collections.defaultdict(list)
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda c: c % 20 == 0, k=3, depth=2).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert got == {0: [1, 2, 3], 20: [0, 1, 2], 40: [0, 1, 2]}


def test_pipeline(spark, docs):
    import corpus_pipeline as p

    stages = dict(p.STAGES)
    kept = stages["language_id"](spark, docs, "")
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, t in enumerate(texts()) if any(c.isalpha() for c in t or "")} | {None}
    single = stages["near_dedup"](spark, docs, "")
    assert single.columns == docs.columns
    ids = [r.doc_id for r in single.collect()]
    want = set(roots([plain_print(t) for t in texts()], 2))
    assert len(ids) == len(set(ids)) and want <= set(ids) and set(ids) <= want | {None}
    assert stages["source_mixing"](spark, single, "").columns == docs.columns
    assert stages["sequence_packing"](spark, single, "").count() >= single.count()
