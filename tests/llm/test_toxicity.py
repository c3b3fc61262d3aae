"""The Kneser-Ney models against plain counts, and stems whose every form is rare."""

from __future__ import annotations

import collections
import math
import random
import zlib

import numpy as np
import pytest

from pluvia.llm import toxicity

TEXTS = [(0, "ab abc, abc (ab)"), (0, "ab b ab"), (0, "ab b ab"), (1, "abd abe x"), (1, "abd c"), (1, "AB é abcdefghijklmnop"), (0, ""), (1, None), (0, "q abd")]


def plain_counts():
    """Distinct texts of each class that have an opening."""
    counts = collections.defaultdict(lambda: [0, 0])
    for y, text in set(TEXTS):
        words = {w.strip("().,") for w in (text or "").lower().split()}
        for o in {(w.encode() + b"\0")[:k] for w in words for k in range(1, min(len(w.encode()) + 1, toxicity.OPENING) + 1)}:
            counts[o][y] += 1
    return counts


def test_counts_and_probabilities_are_those_of_a_plain_version(spark):
    counts = toxicity.count_openings(spark.createDataFrame(TEXTS, "y int, text string").repartition(3))
    want = plain_counts()
    mark = lambda o: toxicity.xxhash.xxh64_intdigest(o, toxicity.SEED) - (1 << 63)
    got = {r.opening: (r.before, r["size"], r.n0, r.n1) for r in counts.collect()}
    assert got == {mark(o): (mark(o[:-1]), len(o), *n) for o, n in want.items()}

    discount = toxicity.discounts(counts)
    for y in (0, 1):
        n1, n2 = (sum(n[y] == k for n in want.values()) for k in (1, 2))
        assert discount[y] == pytest.approx(n1 / (n1 + 2 * n2)) and 0 < discount[y] < 1
    children = collections.defaultdict(list)
    for o in want:
        children[o[:-1]].append(o)
    rows = {r.opening: r for r in toxicity.probabilities(counts, discount).collect()}
    for o, n in want.items():
        same = [want[c] for c in children[o[:-1]]]
        shared = sum(n) / sum(map(sum, same))
        for y in (0, 1):
            s = sum(c[y] for c in same)
            backoff = 1 - sum(max(c[y] - discount[y], 0) for c in same) / s if s else 1
            p = (max(n[y] - discount[y], 0) / s if s else 0) + backoff * shared
            assert rows[mark(o)][f"p{y}"] == pytest.approx(p)
    for own in children.values():
        for y in (0, 1):
            assert sum(rows[mark(o)][f"p{y}"] for o in own) == pytest.approx(1)


def test_ratio_of_a_word_is_that_of_its_longest_known_opening():
    rnd = random.Random(4)
    words = ["".join(rnd.choices("abé", k=rnd.randint(1, 16))).encode() for _ in range(200)] + [b"zzz", b"q"]
    known = {m: 1 + i * 0.25 for i, m in enumerate({m for w in words[:40] for m in toxicity.openings(w)[1 : rnd.randint(2, 9)]})}
    marks = np.sort(np.array(list(known), np.int64))
    models = toxicity.Models(marks, np.array([known[m] for m in marks.tolist()]), np.zeros(3))
    want = [next((known[m] for m in reversed(toxicity.openings(w)[1:]) if m in known), 0.0) for w in words]
    assert models.word_ratios(words) == want and 0.0 in want
    cache = {}
    assert models.evidence(set(words), cache) == models.evidence(set(words), cache) and set(cache) == set(words)
    assert models.evidence(set(), {}) == (0.0, 0.0) and toxicity.Models(marks[:0], marks[:0] + 0.0, np.zeros(3)).word_ratios([b"a"]) == [0.0]


#: Three invented languages, each with its own letters and its own stem; every form of a stem is rare.
LANGUAGES = [("abcdefg", "grozna"), ("hijklmn", "mikholj"), ("opqrstué", "urésto")]


def corpus(seed, n):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        letters, stem = LANGUAGES[i % 3]
        word = lambda: "".join(rnd.choices(letters, k=rnd.randint(2, 7)))
        vocabulary = [word() for _ in range(90)]
        if bad := i % 7 == 0:
            for k in rnd.sample(range(90), 4):
                vocabulary[k] = stem + "".join(rnd.choices(letters, k=4))
        rows.append((i, " ".join(vocabulary), int(bad), i % 3))
    return rows


def test_rare_forms_of_a_stem_in_three_languages(spark):
    rows = corpus(1, 2100)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, _, y, _ in rows if i < 1800], "doc_id long, toxic int")
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    for language in range(3):
        held = [(scores[i] >= 0.5, y) for i, _, y, g in rows if i >= 1800 and g == language]
        caught = [p for p, y in held if y]
        assert np.mean(caught) >= 0.9 and np.mean([p for p, y in held if not y]) <= 0.03, language


def test_copies_are_learned_from_once(spark):
    """A text that one class has a thousand times weighs as it does once."""
    rows = corpus(2, 300)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y, _ in rows], "doc_id long, toxic int")
    text = next(t for i, t, y, _ in rows if not y and zlib.crc32(str(i).encode()) % 5 in (1, 2, 3))
    more = spark.createDataFrame([(1000 + i, text) for i in range(1000)], "doc_id long, text string")
    marked = spark.createDataFrame([(1000 + i, 0) for i in range(1000)], "doc_id long, toxic int")
    one, many = toxicity.train(docs, labels), toxicity.train(docs.unionByName(more), labels.unionByName(marked))
    assert np.array_equal(one.marks, many.marks) and np.allclose(one.ratios, many.ratios)
    assert math.isfinite(float(many.weights.sum()))
