"""Ids by the pattern without look-ahead, keys by ranks, and an index that lets used documents go."""

import random

import numpy as np

from tidegauge.llm import packing


def test_ids_whatever_the_white_space():
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode, _ = packing.encoder(*packing.vocabulary_paths())
    rng = random.Random(3)
    some = [*"\t\n\x0b\x0c\r\x85\xa0    　​\x1c\x1f\x00", *[" "] * 9, "  ", "a", "Hello", "'s", "1", "23", ".", "!?", "é", "日本", "́", "🙂", "²", "<|endoftext|>"]
    runs = 0
    for _ in range(4000):
        text = "".join(rng.choice(some) for _ in range(rng.randint(0, 12)))
        runs += packing.RUN.search(text) is None
        assert encode(text).tolist() == [*tok.encode(text, add_special_tokens=False).ids, 0], repr(text)
    assert 1000 < runs < 3500


def test_rarest_by_ranks():
    rng = np.random.default_rng(5)
    df = rng.integers(0, 6, 300)
    places = packing.ranked(df)
    for size in [0, 1, 2, 3, *rng.integers(4, 60, 200)]:
        ids = rng.integers(0, 300, size).astype(np.uint16)
        want = sorted((df[i], i) for i in set(ids.tolist()) if df[i] > 1)[:3]
        assert packing.rarest(ids, *places) == [i for _, i in want] + [-1] * (3 - len(want))


def test_an_index_without_used_documents_scores_the_others_alike():
    rng = np.random.default_rng(6)
    docs = [rng.integers(0, 100, int(rng.integers(1, 50))).astype(np.uint16) for _ in range(200)]
    index = packing.Bm25(docs, rng.random(100), 25.0)
    before, used, held = [index.scores(t) for t in index.terms], rng.random(200) < 0.6, len(index.owner)
    index.without(used)
    assert len(index.owner) < held / 2
    assert all((s[~used] == index.scores(t)[~used]).all() for s, t in zip(before, index.terms, strict=True))


def test_keys_are_not_made_again_with_the_pieces(spark):
    docs = spark.createDataFrame([(i, f"text number {i} of a few") for i in range(50)], "doc_id long, text string")
    plan = packing.pack(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
