"""Quality classifier: features and updates against plain Python, held-out rows, cases."""

import math
import random
import zlib

import numpy as np
import pytest

from tidegauge.llm import quality

DOC = "doc_id long, text string, quality string, score double, predicted string"


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "tion", "ering", "haon", "wood", "river", "stone"]) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


def spoilt(rng, n):
    words = prose(rng, n).split()
    kind = rng.randrange(3)
    return " ".join([w + rng.choice(["###", "$$$"]) for w in words] if kind == 0 else [w for w in words for _ in range(4)] if kind == 1 else [w + " |" for w in words])


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for k in range(600):
        good = rng.random() < 0.85
        rows.append((k, (prose if good else spoilt)(rng, rng.randint(6, 90)), "q", 0.5, "p"))
        labels.append((k, int(good), 0))
    rows += [(600, None, None, None, None), (601, "", "", 0.0, ""), (602, " \n", "", 0.0, ""), (603, "word " * 30000, "", 0.0, ""), (None, rows[0][1], None, None, None), rows[1], rows[1]]
    labels += [(600, 1, 0), (601, None, 0), (7, 3, 0), (None, 1, 1), (100000, 0, 0), labels[3]]
    return spark.createDataFrame(rows, DOC), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_features_of_a_small_text():
    at, x = quality.features("a b a b!", quality.Tokens())
    again = dict(zip(range(quality.MARKS), x[-quality.MARKS :].tolist(), strict=True))
    # words a b a b ! : two of five stood two places before; pairs ab ba ab b!: one of four
    assert math.isclose(again[quality.BACK.index(2)] ** 2, 2 / 5, rel_tol=1e-6) and math.isclose(again[len(quality.BACK) + quality.BACK.index(2)] ** 2, 1 / 4, rel_tol=1e-6)
    assert sum(v > 0 for v in again.values()) == 2
    assert math.isclose(float((x[: -quality.MARKS] ** 2).sum()), 1, rel_tol=1e-6) and len(set(at.tolist())) == len(at)
    # 5 words + 4 pairs + 3 triples, a, b and ab twice
    assert sorted(round(v * v * 12) for v in x[: -quality.MARKS].tolist()) == [1] * 6 + [2] * 3
    assert [len(v) for v in quality.features(None, quality.Tokens())] == [0, 0] == [len(v) for v in quality.features(" \n", quality.Tokens())]
    assert (quality.features("A  B a\tb !", quality.Tokens())[0] == at).all()


def test_updates_are_the_leaders():
    rng = np.random.default_rng(0)
    leader = quality.Leader(3, alpha=0.7, beta=0.5, l1=0.05, l2=0.1)
    z, n = [0.0] * len(leader.z), [0.0] * len(leader.z)

    def weight(k):
        return 0.0 if abs(z[k]) <= 0.05 else -(z[k] - math.copysign(0.05, z[k])) / ((0.5 + math.sqrt(n[k])) / 0.7 + 0.1)

    for _ in range(60):
        at, label = rng.choice(len(z), 4, replace=False), int(rng.random() < 0.3)
        x = rng.random(4)
        w = [weight(k) for k in at]
        p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x, strict=True))))
        for k, v, old in zip(at, x, w, strict=True):
            g = (p - label) * v
            z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / 0.7 * old
            n[k] += g * g
        leader.learn(at, x, label)
    assert np.allclose(leader.z, z) and np.allclose(leader.weights(), [weight(k) for k in range(len(z))])


def test_held_out_rows(corpus):
    docs, labels = corpus
    rows = quality.sample(docs, labels)
    truth = {r.doc_id: r.quality for r in labels.collect() if r.doc_id is not None and r.quality in (0, 1)}
    learned = [d for d in [*range(601), 1, 1] if zlib.crc32(str(d).encode()) % 5 and d in truth and d != 600]
    assert len(rows) == len(learned)
    got = quality.scored(docs, quality.fit(rows)).collect()
    assert len(got) == docs.count()
    tested = [r for r in got if r.held_out and r.doc_id in truth and r.doc_id < 600]
    assert len(tested) > 80 and sum(r.predicted == truth[r.doc_id] for r in tested) >= 0.97 * len(tested)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    by_id = {r.doc_id: r.score for r in got}
    assert by_id[600] == by_id[601] == by_id[602] and by_id[None] == by_id[0]


def test_same_model_however_the_rows_are_cut(corpus):
    docs, labels = corpus
    one, two = (quality.fit(quality.sample(docs.repartition(k), labels.repartition(k), 200)) for k in (1, 5))
    assert (one == two).all()
    some = quality.sample(docs, labels, 200, 3000)
    assert 1 <= len(some) < 60


def test_nothing_to_learn_from(spark, corpus):
    docs, labels = corpus
    assert {r.score for r in quality.scored(docs, quality.fit(quality.sample(docs, labels.limit(0)))).collect()} == {0.5}
    assert quality.scored(docs.limit(0), quality.fit([])).count() == 0
    assert all(r.score > 0.5 for r in quality.scored(docs, quality.fit(quality.sample(docs, labels.where("quality = 1")))).collect())
