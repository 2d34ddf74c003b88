"""Each stage of the pipeline against a brute-force version of it, on what its predecessor kept."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from isohyet.llm import common, mixing, packing, quality, suffixes, tokens
from tests.llm.test_corpus import _brute_components, _check_packed


@pytest.fixture(scope="module")
def kept(spark, sf_dir):
    """The rows that go into and come out of each stage."""
    out = [common.documents(spark, sf_dir)]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        found = stage(spark, out[-1], sf_dir)
        folder = common.new_folder(spark, f"test-stage-{k}")
        found.write.mode("overwrite").parquet(folder)
        out.append(spark.read.parquet(folder))
    return out


def _rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(kept):
    assert all(df.columns == list(common.DOCUMENT_COLUMNS) for df in kept[:-1])


def test_quality(spark, sf_dir, kept):
    before, after = _rows(kept[0]), _rows(kept[1])
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r.doc_id in before]
    matrix = lambda ids: quality.feature_matrix(pa.array([before[d].text or "" for d in ids], pa.large_string()))
    used = [(d, q) for d, q in labels if not quality.held_out(d)]
    x, y = matrix([d for d, _ in used]), np.array([q for _, q in used], dtype=float)
    order = np.lexsort((*x.T, y))
    scores = quality.train(x[order], y[order]).score(matrix(list(before)))
    assert set(after) == {d for d, s in zip(before, scores) if s >= quality.THRESHOLD}
    assert all(after[d] == before[d] for d in after)


def _shingles(text: str | None) -> frozenset:
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def _by_shingles(texts: dict) -> dict:
    """Roots by the rule itself: all pairs of texts whose five-word shingles have an intersection of 0.8 of their union."""
    return _brute_components({d: _shingles(t) for d, t in texts.items()}, lambda a, b: a == b or 5 * len(a & b) >= 4 * len(a | b))


def test_near_duplicates(kept):
    before, after = _rows(kept[1]), _rows(kept[2])
    roots = _by_shingles({d: r.text for d, r in before.items()})
    assert set(after) == {d for d, r in roots.items() if d == r} and len(after) < len(before)
    assert all(after[d] == before[d] for d in after)


def test_repeated_passages(kept):
    before, after = _rows(kept[2]), _rows(kept[3])
    seen: set[bytes] = set()
    for doc in sorted(before):
        raw = before[doc].text.encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - suffixes.WINDOW + 1):
            w = raw[p : p + suffixes.WINDOW]
            if w in seen:
                gone[p : p + suffixes.WINDOW] = b"\1" * suffixes.WINDOW
            seen.add(w)
        at, chars = 0, []
        for c in before[doc].text:  # a character goes if all its bytes do
            n = len(c.encode())
            if not all(gone[at : at + n]):
                chars.append(c)
            at += n
        text = "".join(chars)
        if any(gone) and not text.strip():
            assert doc not in after
        else:
            assert (after[doc].text, after[doc].n_chars) == (text, len(text))


def test_mixing(kept):
    plan = mixing.mix(kept[3]).collect()
    want = Counter({r.doc_id: len(r.shards) for r in plan if r.shards})
    assert Counter(r.doc_id for r in kept[4].collect()) == want and max(want.values()) <= 2
    total, taken = sum(r["size"] for r in plan), sum(r["size"] * len(r.shards) for r in plan)
    assert abs(taken - 1.5 * total) < 0.05 * total


def test_packing(kept):
    want = Counter((r.doc_id, r.text) for r in kept[4].collect())
    sequences = _check_packed(kept[5].collect(), want)
    total = sum(r.length for rs in sequences.values() for r in rs)
    assert total > 0.99 * packing.CAPACITY * (len(sequences) - 1)


def test_run(spark, sf_dir, kept):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, kept[5].collect()))


#: Names that stages and operators give to their own columns.
TAKEN = [
    "quality_score", "cut_spans", "mix_mark", "mix_shards", "mix_copy", "mix_shard", "near_row", "near_kept", "kept_id", "kept_key", "text_key", "fp", "bands", "node", "root",
    "component_id", "size", "block", "blocks", "mark", "shards", "score", "shard", "file", "blob", "bucket", "start", "length", "worker", "slot", "x", "path", "Mix_Mark_", "quality_score_",
]


@pytest.mark.parametrize("extra", [False, True])
def test_empty_and_odd_tables(spark, sf_dir, extra):
    schema = ", ".join(f"{c} {'long' if c in ('doc_id', 'n_chars') else 'string'}" for c in common.DOCUMENT_COLUMNS)
    odd = [(None, None, None, None, None), (None, "some words here", "en", None, 3), (4, "", None, "a", 0), (4, "", None, "a", 0), (5, None, "en", "a", None), (6, "plain text " * 50, "en", "b", 1), (7, "long text of many words " * 40_000, "en", "b", 1)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        if extra:
            docs = docs.select("*", *(F.struct(F.xxhash64("doc_id").alias("a"), F.array(F.lit(k)).alias("b")).alias(name) for k, name in enumerate(TAKEN)))
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            folder = common.new_folder(spark, "test-odd")
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(folder)
            docs = spark.read.parquet(folder)
            if name == "packing":
                continue
            assert docs.columns == columns
            if extra:
                for r in docs.collect():
                    assert [r[c].b for c in TAKEN] == [[k] for k in range(len(TAKEN))]
                assert docs.filter(" or ".join(f"{c}.a <> xxhash64(doc_id)" for c in TAKEN)).count() == 0
    assert tokens.END_ID == 2
