"""The language model: the same score for any split of the input, a gain on held-out text, and order that matters."""

from __future__ import annotations

import random

import numpy as np
import pytest

from pluvia.llm import gru, lm_scoring
from tests.llm.conftest import SOURCE


def scores(df):
    return {r.doc_id: (r.score / r.n_tokens, r.base_score / r.n_tokens, r.held_out) for r in lm_scoring.score(df).collect()}


def test_score_does_not_depend_on_partitions_and_beats_the_base(spark):
    docs = spark.read.parquet(SOURCE.replace("sf0.001", "sf0.01") + "/documents.parquet")
    one, many = scores(docs.coalesce(1)), scores(docs.repartition(17))
    assert one.keys() == many.keys()
    assert max(abs(one[d][0] - many[d][0]) for d in one) < 1e-5
    held = [d for d in one if one[d][2]]
    assert np.mean([one[d][0] - one[d][1] for d in held]) > 0.05


def test_several_shards_and_a_tree_of_copies(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "SHARD_TOKENS", 4000)
    monkeypatch.setattr(lm_scoring, "FAN_IN", 2)
    docs = spark.read.parquet(f"{SOURCE}/documents.parquet")
    one, many = scores(docs.coalesce(1)), scores(docs.repartition(9))
    assert max(abs(one[d][0] - many[d][0]) for d in one) < 1e-5 and all(np.isfinite(v[0]) for v in one.values())


def test_order_of_words_matters(spark):
    """A grammar of two alternating halves of the vocabulary: a shuffled text is less likely than an ordered one."""
    rnd = random.Random(3)
    a, b = [f"a{i}" for i in range(16)], [f"b{i}" for i in range(16)]
    ordered = lambda: " ".join(rnd.choice(a if k % 2 else b) for k in range(60))
    rows = [(i, ordered()) for i in range(30_000)]
    texts = [ordered() for _ in range(40)]
    rows += [(40_000 + i, t) for i, t in enumerate(texts)]
    rows += [(50_000 + i, " ".join(rnd.sample(t.split(), 60))) for i, t in enumerate(texts)]
    got = scores(spark.createDataFrame(rows, "doc_id long, text string"))
    right, wrong = (np.mean([got[k + i][0] for i in range(40)]) for k in (40_000, 50_000))
    base = [np.mean([got[k + i][1] for i in range(40)]) for k in (40_000, 50_000)]
    assert base[0] == pytest.approx(base[1]) and right > wrong + 0.1


def test_exponentials_are_scaled_only_where_they_must_be():
    """Small logits give the same without their maximum; large ones, which would overflow, are still scaled by it."""
    rng, words, tails = np.random.default_rng(2), 64, 3
    ids, starts = rng.integers(0, words + 1 + tails, 400), np.array([0, 150, 390])
    model = gru.Gru(gru.initial(rng.integers(1, 50, words + 1 + tails), words, tails))
    assert model.flat_logits("c", "cb") and model.flat_logits("w", "wb")
    plain = model.score(ids, starts)
    model.flat_logits = lambda weights, biases: False
    assert model.score(ids, starts) == pytest.approx(plain, rel=1e-5)
    del model.flat_logits
    model.p["cb"][0], model.p["wb"][0, 0] = 200, 150
    assert not model.flat_logits("c", "cb") and not model.flat_logits("w", "wb")
    model.train(ids, starts, gru.Adam(0.01), lanes=4)
    assert np.isfinite(model.score(ids, starts)).all() and all(np.isfinite(v).all() for v in model.p.values())
