"""Every query over the odd tables against a plain version in Python, and over empty tables."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import xxhash

import pluvia.llm.op_queries  # noqa: F401  registers the queries
from pluvia.llm.registry import QUERIES

SPACE = b" \t\n\x0b\x0c\r"


def run(spark, name, folder):
    query = next(q for n, q in QUERIES.items() if n.startswith(f"op{name}_"))
    return [r.asDict() for r in query(spark, folder).collect()]


def multiset(rows, *names):
    return collections.Counter(tuple(r[n] for n in names) for r in rows)


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def held(doc_id, folds):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds


@pytest.mark.parametrize("name", range(1, 14))
def test_empty_tables_give_no_rows(spark, empty_dir, name):
    assert run(spark, name, empty_dir) == []


def test_secret_scans_base(spark, sf_dir, docs_rows):
    assign = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
    want = []
    for d, t in docs_rows:
        t = t or ""
        found = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(t) if len(m[2]) >= 8]
        found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found)).encode()).hexdigest()
        want.append({"doc_id": d, "base_sha256": digest} | {f"n_{k}": sum(f[3] == k for f in found) for k in ("assign", "access", "hex")})
    names = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    got = run(spark, 1, sf_dir)
    assert multiset(got, *names) == multiset(want, *names)
    assert any(r["n_assign"] for r in got)


def test_lm_scoring_base(spark, sf_dir, docs_rows):
    counts = collections.Counter()
    tokens = [[*(w.lower() for w in words(t)), None] for _, t in docs_rows]
    for (d, _), w in zip(docs_rows, tokens, strict=True):
        if held(d, 7) != 2:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    want = collections.defaultdict(list)
    for (d, _), w in zip(docs_rows, tokens, strict=True):
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        want[d, held(d, 7) == 2, len(w), sum(counts[x] > 0 for x in w), n].append(base)
    got = collections.defaultdict(list)
    for r in run(spark, 2, sf_dir):
        got[r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]].append(r["base_score"])
        assert r["score"] < 0 and math.isfinite(r["score"])
    assert {k: len(x) for k, x in got.items()} == {k: len(x) for k, x in want.items()}
    assert all(sorted(got[k]) == pytest.approx(sorted(want[k])) for k in want)


def test_quality_rules_base(spark, sf_dir, docs_rows):
    want = []
    for d, t in docs_rows:
        t, w = t or "", words(t)
        windows = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {i + k for i, x in enumerate(zip(w, w[1:], w[2:], strict=False)) if windows[x] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if x.encode().strip(SPACE)]
        counts = (len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        want.append(dict(zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), counts, strict=True)) | {"doc_id": d, "base_failed": failed})
    got, names = run(spark, 3, sf_dir), ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert multiset(got, *names) == multiset(want, *names)
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_simhash(spark, sf_dir, docs_rows):
    def fingerprint(text):
        w = [x.lower() for x in words(text)]
        if not w:
            return 0
        hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    cache = {t: fingerprint(t) for t in {t for _, t in docs_rows}}
    fps = sorted(set(cache.values()))
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for d, t in docs_rows:
        if d is not None:
            least[find(cache[t])] = min(d, least.get(find(cache[t]), d))
    want = [{"doc_id": d, "fingerprint": f"{cache[t]:016x}", "component_id": least.get(find(cache[t]))} for d, t in docs_rows]
    names = ("doc_id", "fingerprint", "component_id")
    assert multiset(run(spark, 4, sf_dir), *names) == multiset(want, *names)


@pytest.mark.parametrize("name,threshold", [(5, 0.3), (9, 0.5)])
def test_classifier_contract(spark, sf_dir, docs_rows, name, threshold):
    got = run(spark, name, sf_dir)
    assert multiset(got, "doc_id", "held_out") == collections.Counter((d, held(d, 5) == 0) for d, _ in docs_rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= threshold) for r in got)


def test_substring_dedup(spark, sf_dir, docs_rows):
    first, want = {}, []
    for d, t in docs_rows:
        w = words(t)
        for s in range(len(w) - 49 if d is not None else 0):
            k = tuple(w[s : s + 50])
            first[k] = min(d, first.get(k, d))
    for d, t in docs_rows:
        w = words(t)
        gone = bytearray(len(w))
        for s in range(len(w) - 49 if d is not None else 0):
            if first[tuple(w[s : s + 50])] < d:
                gone[s : s + 50] = b"\1" * 50
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want.append({"doc_id": d, "n_words": len(w), "n_removed": sum(gone), "kept_sha256": hashlib.sha256(kept).hexdigest()})
    names = ("doc_id", "n_words", "n_removed", "kept_sha256")
    got = run(spark, 6, sf_dir)
    assert multiset(got, *names) == multiset(want, *names)
    assert sum(r["n_removed"] for r in got) > 1000


def test_line_dedup(spark, sf_dir, docs_rows):
    key = lambda line: line.encode().strip(SPACE).lower()
    holders = collections.defaultdict(set)
    for d, t in docs_rows:
        for line in (t or "").split("\n"):
            if d is not None and len(key(line).decode()) >= 40:
                holders[key(line)].add(d)
    want = []
    for d, t in docs_rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or len(holders.get(key(x), ())) < 5 or d == max(holders[key(x)])]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        want.append({"doc_id": d, "n_lines": len(lines), "n_dropped": len(lines) - len(kept), "kept_sha256": digest})
    names = ("doc_id", "n_lines", "n_dropped", "kept_sha256")
    got = run(spark, 7, sf_dir)
    assert multiset(got, *names) == multiset(want, *names)
    assert sum(r["n_dropped"] for r in got) >= 12


def test_decontamination_finds_whole_items(spark, sf_dir, docs_rows):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() if r.text and len(r.text) > 5]
    flat = lambda t: " ".join((t or "").lower().split())
    want = {(d, i) for d, t in docs_rows for i, x in items if flat(x) in flat(t)}
    got = {(r["doc_id"], r["item_id"]) for r in run(spark, 8, sf_dir)}
    assert want and got == want


def test_packing(spark, sf_dir, docs_rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = collections.Counter()
    for d, t in docs_rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids), 1024), len(ids)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[d, i, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    got = run(spark, 10, sf_dir)
    assert multiset(got, "doc_id", "piece", "start", "length", "ids_crc32") == want
    rows = sorted((r["sequence_id"], r["offset"], r["length"]) for r in got)
    for before, here in zip([(None, 0, 0), *rows], rows, strict=False):
        assert here[1] == (before[1] + before[2] if before[0] == here[0] else 0) and here[1] + here[2] <= 1024
    total = sum(r["length"] for r in got)
    assert len({r[0] for r in rows}) <= 1.02 * math.ceil(total / 1024) + 1


def test_packing_of_added_tokens(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from pluvia.llm import packing

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["one<|endoftext|>two  <|endoftext|><|endoftext|> three", "<|endoftext|>", " <|endoftext|> x", "<|endoftext| >", "plain text"]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    ids = [np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4") for t in texts]
    want = {(d, len(x), zlib.crc32(x.tobytes())) for d, x in enumerate(ids)}
    assert {(r.doc_id, r.length, r.ids_crc32) for r in packing.tokenised(docs).collect()} == want
