"""Spelling variants against plain neighbourhoods, and the index against plain text search."""

from __future__ import annotations

import collections
import itertools
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pluvia.llm import spelling
from pluvia.llm.op_queries import op11_spelling_variants


def counted(rows):
    counts = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return counts


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(vocabulary):
    near = collections.defaultdict(list)
    by_part = collections.defaultdict(set)
    for w in vocabulary:
        for i in range(len(w)):
            by_part[w[:i] + w[i + 1 :]].add(w)
            by_part[w].add(w)
    for group in by_part.values():
        for a, b in itertools.permutations(group, 2):
            if b not in near[a] and one_edit(a, b):
                near[a].append(b)
    form = {}
    for w, n in vocabulary.items():
        best = min(near[w], key=lambda x: (-vocabulary[x], x), default=None)
        form[w] = best if best is not None and vocabulary[best] >= 2 * n else None
    out = set()
    for w, n in vocabulary.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), vocabulary.get(form[w])))
    return out


def found(df):
    rows = df.collect()
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


def test_query(spark, sf_dir, docs_rows):
    want = expected({w: n for w, n in counted(docs_rows).items() if len(w) >= 5 and n >= 3})
    got = found(op11_spelling_variants(spark, sf_dir))
    assert got == want and sum(w[1] is not None for w in want) > 100


def corpus(spark, counts):
    """Documents in which each word occurs as often as asked for, none of them spoilt by the counting rule."""
    rows, ids = [], itertools.count()
    for word, n in counts.items():
        i = next(i for i in ids if zlib.crc32(f"{i}:{word}".encode()) % 97)
        rows.append((i, f" {word.upper() if word.isascii() else word}, " * n))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("shard", [1, 40, 1 << 18])
def test_shards_of_any_size(spark, shard):
    rng = np.random.default_rng(3)
    words = {"".join(rng.choice(list("abé"), rng.integers(5, 9))) for _ in range(250)}
    counts = {w: int(n) for w, n in zip(sorted(words), rng.integers(3, 60, len(words)), strict=True)}
    assert found(spelling.variants(corpus(spark, counts), shard_symbols=shard)) == expected(counts)


def test_chain_of_forms_ties_and_edges(spark):
    chain = {"aaaaa" + "b" * i: 3 * 2**i for i in range(9)}
    ties = {"tieab": 5, "tieac": 20, "tiead": 20, "àbcdé": 7, "àbcde": 14, "×÷×÷×": 4, "×÷×÷": 99}
    long = {"x" * 5000: 3, "x" * 4999 + "y": 6}
    counts = {**chain, **ties, **long}
    counts_in = {w: n for w, n in counts.items() if len(w) >= 5}
    got = found(spelling.variants(corpus(spark, counts)))
    assert got == expected(counts_in)
    by = {g[0]: g for g in got}
    assert by["aaaaa"][2] == "aaaaabbbbbbbb" and by["tieab"][1] == "tieac" and by["àbcdé"][1] == "àbcde"


WORD = st.text("abc", min_size=2, max_size=6)


@settings(deadline=None)
@given(st.sets(WORD, min_size=1, max_size=25), st.lists(WORD, min_size=1, max_size=8), st.integers(0, 2))
def test_search_of_one_index(words, queries, exact):
    words = sorted(words)
    index = spelling.Index(words)
    q, number = spelling.near_words(index, queries, np.full(len(queries), exact))
    got = {(int(i), words[w]) for i, w in zip(q, number, strict=True)}
    want = set()
    for i, query in enumerate(queries):
        tail = query[len(query) - exact :]
        for w in words:
            if w.endswith(tail) and one_edit(query[: len(query) - exact], w[: len(w) - exact]):
                want.add((i, w))
    assert got == want


@given(st.sets(st.text("ab", max_size=6), min_size=1, max_size=12))
def test_suffix_order(words):
    words = sorted(words)
    symbols, suffixes = [], []
    for i, w in enumerate(words):
        for k in range(len(w) + 1):
            suffixes.append((w[k:] and tuple(100 + ord(c) for c in w[k:]) + (i,)) or (i,))
        symbols += [100 + ord(c) for c in w] + [i]
    order = spelling.suffix_order(np.array(symbols))
    assert order.tolist() == sorted(range(len(symbols)), key=suffixes.__getitem__)
