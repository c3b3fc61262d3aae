"""Parts of the operators by themselves: planted cases, splits of hot groups, gradients, round trips."""

from __future__ import annotations

import random
import string

import numpy as np
import pyarrow as pa
import pytest

from pluvia.llm import components, decontamination, gru, line_dedup, packing, quality_classifier, quality_rules, rolling, secrets, simhash, toxicity
from pluvia.llm.common import fits
from tests.llm.conftest import SOURCE


def test_random_tokens_are_found_and_ordinary_ones_are_not(spark):
    rnd = random.Random(3)
    prose = " ".join(r.text for r in spark.read.parquet(f"{SOURCE}/documents.parquet").where("lang = 'en'").limit(50).collect()).split()
    rows = [(i, " ".join(rnd.choices(prose, k=60))) for i in range(60)]
    rows += [(100 + i, "x " + "".join(rnd.choices(string.ascii_letters + string.digits, k=40)) + " y") for i in range(30)]
    rows += [(200 + i, "x " + "".join(rnd.choices(string.ascii_lowercase + string.digits, k=48)) + " y") for i in range(30)]
    plain = string.ascii_letters + string.digits
    rows += [(300 + i, f"{plain} the-quick-brown-fox-jumps-over 12345678901234567890 {'ab' * 15}") for i in range(3)]
    got = {r.doc_id: len(r.found) for r in secrets.with_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = lambda a, b: sum(got[i] > 0 for i in got if a <= i < b)
    assert found(100, 200) >= 28 and found(200, 300) >= 28
    assert found(0, 100) <= 2 and found(300, 400) == 0


def test_upper_tail(spark):
    want = {0.0: 0.5, 1.0: 0.15865525393145707, -2.0: 0.9772498680518208, 6.0: 9.865876450376946e-10}
    rows = spark.createDataFrame([(z,) for z in want], "z double")
    assert {r.z: r.p for r in rows.select("z", secrets.upper_tail(rows.z).alias("p")).collect()} == pytest.approx(want, rel=1e-6)


@pytest.mark.parametrize("task_rows", [2000, 8])
def test_trie_join_with_split_tasks(spark, task_rows):
    rng = np.random.default_rng(1)
    near = [int(rng.integers(0, 2**64, dtype=np.uint64))]
    for _ in range(150):
        x = near[rng.integers(len(near))]
        for b in rng.choice(64, rng.integers(1, 5), replace=False):
            x ^= 1 << int(b)
        near.append(x)
    fps = np.unique(np.array([*near, *rng.integers(0, 2**64, 60, dtype=np.uint64)], np.uint64))
    graph = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    label = np.arange(len(fps))
    for _ in range(len(fps)):
        label = np.array([label[g].min() for g in graph])
    signed = fps.view(np.int64).tolist()
    want = {frozenset(signed[i] for i in np.flatnonzero(label == k)) for k in set(label.tolist()) if (label == k).sum() > 1}
    links = simhash.linked_fingerprints(spark.createDataFrame([(x,) for x in signed], "fp long"), task_rows=task_rows)
    got: dict[int, set[int]] = {}
    for r in components.components(links).collect():
        got.setdefault(r.root, set()).add(r.node)
    assert {frozenset(x) for x in got.values()} == want


@pytest.mark.parametrize("rows", [10, 1 << 23, 1 << 40])
def test_linked_fingerprints_share_a_route(spark, rows):
    """Any three bits may differ: one of the tries still has both under one node."""
    rng, base = np.random.default_rng(rows % 7), 0x0123456789ABCDEF
    fps = [base] + [base ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False)) for _ in range(40)]
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    routes: dict[int, set] = {}
    for r in simhash.routed(spark.createDataFrame([(x,) for x in signed], "fp long"), rows).collect():
        routes.setdefault(r.fp, set()).add((r.band, r.key))
    assert all(routes[signed[0]] & routes[x] for x in signed)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    assert {(r.node, r.root) for r in components.components(edges).collect()} == {(i, 0) for i in range(201)} | {(500, 500), (501, 500)}


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_lines_of_a_hot_key_over_many_partitions(spark, partitions):
    hot = "x" * 50
    docs = spark.createDataFrame([(i, f"{hot}\n{hot}\nown line {i}") for i in range(300)] + [(400 + i, "y" * 45) for i in range(4)], "doc_id long, text string")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        lost = {(r.doc_id, r.line) for r in line_dedup.repeated_lines(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert lost == {(i, k) for i in range(299) for k in (0, 1)}


def test_bitmaps_come_back():
    kept = np.random.default_rng(0).random(1003) < 0.5
    assert (line_dedup.unpack_bitmap(line_dedup.pack_bitmap(kept), 1003) == kept).all()
    assert line_dedup.unpack_bitmap(None, 3).all()
    assert line_dedup.unpack_bitmap(line_dedup.pack_bitmap(np.array([True, False] + 6 * [True])), 20).sum() == 19


@pytest.mark.parametrize("size", [200, 1 << 20])
def test_word_hashes_do_not_depend_on_slices(size, monkeypatch):
    monkeypatch.setattr(rolling, "SLICE", size)
    text = ("café \t one\ntwo  " + "z" * 300 + " a b ").encode() * 20
    words = text.split()
    got = rolling.word_hashes(text)
    assert len(got) == len(words)
    for i, a in enumerate(words):
        for j in range(i):
            assert (got[i] == got[j]) == (a == words[j])
    windows = rolling.window_hashes(got, 5)
    assert all((windows[i] == windows[j]) == (words[i : i + 5] == words[j : j + 5]) for i in range(60) for j in range(i))


def test_gru_gradients_and_scores():
    rng, words, tails = np.random.default_rng(1), 64, 3
    start = {k: v.astype(float) for k, v in gru.initial(rng.integers(1, 50, words + 1 + tails), words, tails).items()}
    ids, first, h0 = rng.integers(0, words + 1 + tails, (5, 7)), rng.random((5, 7)) < 0.2, np.zeros((7, gru.HIDDEN))

    def loss(p):
        model, h, total = gru.Gru(p), h0, 0.0
        for t in range(5):
            h = h * ~first[t][:, None]
            total -= model.log_probability(h, ids[t]).sum()
            h = model.step(h, p["x"][ids[t]])[0]
        return total / 35

    class Seen:
        def update(self, params, grad):
            self.grad = grad

    seen = Seen()
    gru.Gru(start).window(h0, ids, first, np.ones((5, 7), bool), seen)
    for k in start:
        at = tuple(rng.integers(0, s) for s in start[k].shape)
        at = (int(ids[0, 0]), at[1]) if k == "x" else at
        up, down = ({a: b.copy() for a, b in start.items()} for _ in range(2))
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        assert seen.grad[k][at] == pytest.approx((loss(up) - loss(down)) / 2e-5, rel=1e-3, abs=1e-6)

    model = gru.Gru(gru.initial(np.ones(words + 1 + tails), words, tails))
    docs = [rng.integers(0, words + 1 + tails, n) for n in (1, 40, 3, 17, 100, 2)]
    flat, starts = np.concatenate(docs), np.cumsum([0] + [len(d) for d in docs])[:-1]
    alone = [model.score(d, np.array([0]))[0] for d in docs]
    assert model.score(flat, starts, lanes=3) == pytest.approx(alone, rel=1e-4)
    every = np.arange(words + 1 + tails)
    assert np.exp(model.log_probability(np.zeros((len(every), gru.HIDDEN), np.float32) + 0.1, every)).sum() == pytest.approx(1, rel=1e-4)
    before = model.score(flat, starts).sum()
    optimiser = gru.Adam(0.02)
    for _ in range(30):
        model.train(flat, starts, optimiser, lanes=4)
    assert model.score(flat, starts).sum() > before


def test_forest_learns_and_flattens():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    forest = quality_classifier.fit_forest(x[:3000], y[:3000])
    assert ((forest.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.97
    assert forest.score(np.zeros((0, 5), np.float32)).shape == (0,)
    assert quality_classifier.fit_forest(x[:10], np.ones(10)).score(x[:2]) == pytest.approx([11 / 12] * 2)
    for text in (b"", b" ", b"\n\n", "é".encode(), b"a" * 10_000):
        assert np.isfinite(quality_classifier.document_statistics(text)).all()


def test_repeated_words_and_log_ratios():
    hashes = np.array([1, 2, 3, 9, 1, 2, 3, 4, 4, 4, 4], np.uint64)
    assert quality_rules.repeated_words(hashes) == 10
    assert quality_rules.repeated_words(hashes[:2]) == 0
    counts = np.zeros((2, quality_rules.BUCKETS), np.int64)
    assert np.allclose(quality_rules.log_ratios(counts), 0)
    counts[:, 5] = 1_000_000
    counts[0, 6] = 1_000_000
    ratios = quality_rules.log_ratios(counts)
    assert ratios[5] > 0.5 and ratios[6] < -2


def test_toxic_words_are_learned(spark):
    rnd, vocabulary = random.Random(0), [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(1500):
        text = rnd.choices(vocabulary, k=80)
        if bad := i % 5 == 0:
            for k in rnd.sample(range(80), 4):
                text[k] = rnd.choice(["vile", "nasty"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, marks)).collect()}
    assert np.mean([(scores[i] >= 0.5) == (i % 5 == 0) for i in scores]) > 0.98


def test_block_maxima_lose_no_item():
    rnd = random.Random(1)
    vocabulary = [f"t{i}".encode() for i in range(400)]
    items = [(i, b" ".join(rnd.choices(vocabulary, k=rnd.randint(3, 40)))) for i in range(600)]
    index = decontamination.build_index(items)
    assert index.block > 1
    cache = decontamination.TermNumbers(index.numbers)
    for k in range(20):
        text = rnd.choices(vocabulary, k=200)
        inside = items[rnd.randrange(600)][1].split()
        text[50 : 50 + len(inside)] = inside
        ids = np.array([cache[w] for w in text])
        got = {(s, i) for s, blocks in index.candidates(ids) for i in index.retrieve(ids[s : s + 2 * index.half], blocks)}
        every = np.arange(index.block_most.shape[1])
        starts = range(0, max(1, len(ids) - index.half), index.half)
        assert got == {(s, i) for s in starts for i in index.retrieve(ids[s : s + 2 * index.half], every)}


def test_shards_of_the_index_find_the_same(spark, sf_dir):
    docs, items = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    pairs = lambda **o: {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items, **o).collect()}
    assert pairs() == pairs(shard_bytes=2000)


@pytest.mark.parametrize("seed", range(3))
def test_plans_place_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    histogram = np.bincount(np.minimum(rng.geometric(0.004 * (seed + 1), 5000), 1024), minlength=1025)
    for plan in (packing.grouped_plan(histogram), packing.make_plan(histogram)):
        runs, room = sorted(plan.runs), {}
        for (length, rank, sequence, offset), after in zip(runs, [*runs[1:], (0, 0, 0, 0)], strict=True):
            last = after[1] if after[0] == length else int(histogram[length])
            for k in range(last - rank):
                room.setdefault(sequence + k, []).append((offset, length))
        assert sum(map(len, room.values())) == histogram[1:].sum()
        for pieces in room.values():
            ends = np.cumsum([n for _, n in sorted(pieces)])
            assert ends[-1] <= 1024 and [o for o, _ in sorted(pieces)] == [0, *ends[:-1].tolist()]
        assert len(room) <= 1.03 * np.ceil((histogram * np.arange(1025)).sum() / 1024) + 1


def test_sides_are_measured(spark):
    rows = spark.range(100).selectExpr("id", "repeat('x', 100) AS t", "array(1, 2, 3) AS a")
    assert fits(rows, 1 << 20) and not fits(rows, 5_000)
    assert fits(rows.where("false"), 0)


def test_records_are_arrow_batches():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a", None, ""])})
    from pluvia.llm.common import raw_texts

    assert raw_texts(batch) == [b"a", b"", b""]


def test_one_document_of_each_simhash_group_stays(spark):
    """Against components of all pairs of fingerprints; chains of near fingerprints are one group."""
    rnd, texts = random.Random(2), []
    for _ in range(12):
        base = [f"w{rnd.randrange(5000)}" for _ in range(400)]
        for edits in (0, 0, 1, 1, 2, 3, 5, 9, 20, 40):
            copy = list(base)
            for at in rnd.sample(range(400), edits):
                copy[at] = f"x{rnd.randrange(5000)}"
            texts.append(" ".join(copy))
    texts += ["", " \n", "one two", "One  two", "one two three"]
    rnd.shuffle(texts)
    fps = [simhash.fingerprint(t.encode()) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= simhash.ERRORS and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    rows = [(i, t, i) for i, t in enumerate(texts)] + [(None, texts[0], -1), (None, None, -2), (group[7], texts[group[7]], -3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int").repartition(3)
    left = simhash.keep_first(docs)
    assert left.columns == docs.columns
    assert sorted(r.row for r in left.collect()) == sorted([-1, -2, -3, *set(group)])
    assert len(set(group)) < len(texts) - 20


@pytest.mark.parametrize("size", [120, 600])
def test_clean_documents_without_a_label_stay(spark, size):
    """Rare words of their own are no reason to reject documents that have no label; junk without a label goes."""
    rnd, common, junk = random.Random(size), [f"c{i}" for i in range(60)], [f"j{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(size):
        bad, own = i % 10 == 0, [f"own{i}x{k}" for k in range(200)]
        rows.append((i, " ".join(rnd.sample(own, 90) + rnd.choices(junk if bad else common, k=90))))
        if rnd.random() < 0.3:
            labels.append((i, int(not bad)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    kept = {r.doc_id for r in quality_rules.judge(docs, marks).where("kept").collect()}
    clean = {i for i in range(size) if i % 10}
    assert len(clean - kept) <= 0.05 * len(clean) and len(kept - clean) <= 0.02 * size
