"""Every stage of the pipeline against a plain version, over tables with every odd case."""

from __future__ import annotations

import collections

import pytest

import corpus_pipeline
import pluvia.llm.op_queries  # noqa: F401  registers the queries
from pluvia.llm.registry import QUERIES


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """(input, output) of every stage, as rows."""
    from pluvia.session import materialise

    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialise(stage(spark, docs, sf_dir), name)
        out[name] = (before, docs)
    return out


def rows(df):
    return collections.Counter((r.doc_id, r.text) for r in df.collect())


def query(name):
    return next(q for n, q in QUERIES.items() if n.startswith(f"op{name}_"))


def test_columns_stay(stages):
    for name, (before, after) in stages.items():
        assert (after.columns == before.columns) == (name != "best_fit_packing")


def test_quality_drops_rejected_documents_only(spark, stages, sf_dir):
    before, after = stages["quality_classifier"]
    rejected = {r.doc_id for r in query(5)(spark, sf_dir).where("predicted = 0").collect()}
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} <= rejected
    assert not {d for d, _ in rows(after)} & (rejected - {d for d, n in collections.Counter(d for d, _ in rows(before)).items() if n > 1})


def test_lines_are_dropped_and_characters_follow(stages):
    before, after = stages["line_dedup"]
    holders = collections.defaultdict(set)
    key = lambda line: line.encode().strip(b" \t\n\x0b\x0c\r").lower()
    for d, t in rows(before):
        for line in (t or "").split("\n"):
            if d is not None and len(key(line).decode()) >= 40:
                holders[key(line)].add(d)
    want = collections.Counter()
    for (d, t), n in rows(before).items():
        kept = [x for x in (t or "").split("\n") if d is None or len(holders.get(key(x), ())) < 5 or d == max(holders[key(x)])]
        want[d, t if t is None else "\n".join(kept)] += n
    assert rows(after) == want
    assert after.where("text IS NOT NULL AND n_chars <> length(text)").count() == 0


def test_one_of_each_group_stays(stages):
    from pluvia.llm import simhash

    before, after = stages["simhash_near_dedup"]
    fps = {t: simhash.fingerprint((t or "").encode()) for _, t in rows(before)}
    distinct = sorted(set(fps.values()))
    root = {f: f for f in distinct}
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 3 and root[a] != root[b]:
                old, new = root[a], root[b]
                root = {f: new if r == old else r for f, r in root.items()}
    least = {}
    for d, t in rows(before):
        if d is not None:
            least[root[fps[t]]] = min(d, least.get(root[fps[t]], d))
    want = {(d, t): n for (d, t), n in rows(before).items() if d is None or d == least[root[fps[t]]]}
    assert rows(after) == collections.Counter(want) and len(want) < len(rows(before))


def test_leaks_go_and_clean_documents_stay(spark, stages, sf_dir):
    before, after = stages["benchmark_decontamination"]
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() if r.text and len(r.text) > 5]
    leaks = lambda t: any(i in " ".join((t or "").lower().split()) for i in items)
    assert rows(after) == collections.Counter({k: n for k, n in rows(before).items() if not leaks(k[1])})


def test_everything_left_is_packed(stages):
    before, after = stages["best_fit_packing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}


def test_empty_tables_pass(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).count() == 0
