"""Similar documents against the true share of their five-word shingles."""

from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from isohyet.llm import simhash
from tests.llm.test_corpus import SCHEMA, _brute_components


def _shingles(text: str) -> frozenset:
    words = text.lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def _near(a: frozenset, b: frozenset) -> bool:
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def _pair(rng: random.Random, shared: int, own: int) -> tuple[str, str]:
    """Two texts that share a beginning of so many shingles, each with so many of its own."""
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    head = words(shared + 4)
    return " ".join(head + words(own)), " ".join(head + words(own))


@pytest.mark.parametrize("held", [1 << 20, 300])
def test_true_similarity_decides(spark, monkeypatch, held):
    monkeypatch.setattr(simhash, "HELD", held, raising=False)  # the smaller: components are compared block by block
    rng, texts = random.Random(3), []
    for shared, own in [(8, 1), (16, 2), (160, 20), (640, 80), (4, 1), (30, 6), (30, 4), (150, 20), (150, 22), (300, 60), (300, 45), (600, 75), (600, 76)] * 4:
        texts += _pair(rng, shared, own)
    chain = [f"c{k}" for k in range(160)]
    for k in range(12):  # neighbours at 0.8 and more, the ends far below
        texts.append(" ".join(chain))
        chain = chain[14:] + [f"c{k}x{n}" for n in range(14)]
    texts += ["one two three four five six seven eight", "one two three four five six seven eight nine", "one two", "one three", "", "Same  words", "same words"]
    found = {r.doc_id: r.component_id for r in simhash.similar_documents(spark.createDataFrame([(k, x, None, None, 0) for k, x in enumerate(texts)], SCHEMA)).collect()}
    assert found == _brute_components({k: _shingles(x) for k, x in enumerate(texts)}, _near)


def test_pairs_of_large_groups_connect_what_is_similar():
    rng = np.random.default_rng(5)
    sets, group = [], np.sort(rng.integers(0, 2, 300))
    for _ in range(300):
        base = np.arange(100) + 1000 * rng.integers(0, 4)
        sets.append(np.unique(np.where(rng.random(100) < rng.uniform(0, 0.2), rng.integers(10**4, 10**9, 100), base)).astype(np.uint64))
    got = simhash._local_roots(300, simhash.similar_pairs(group, sets, 0.8))
    want = _brute_components({k: (group[k], frozenset(x.tolist())) for k, x in enumerate(sets)}, lambda a, b: a[0] == b[0] and _near(a[1], b[1]))
    assert got.tolist() == [want[k] for k in range(300)] and 2 < len(set(want.values())) < 250


def test_pairs_beside_common_elements():
    """Sets that share most of what they hold with all others, pairs just at and just below the share, empty sets, one that holds another."""
    rng = np.random.default_rng(6)
    common, sets = rng.integers(0, 1 << 62, 60), []
    for k in range(60):
        own = np.r_[common, rng.integers(0, 1 << 62, 20)]
        sets.append(own)
        if k % 3 == 0:  # 80 of 100 in all, or 79 of 101
            sets.append(np.r_[own[: 80 - k % 2], rng.integers(0, 1 << 62, 20 + k % 2)])
    sets += [np.empty(0, np.int64), np.empty(0, np.int64), common, np.r_[common, rng.integers(0, 1 << 62, 15)]]
    sets = [np.unique(x).astype(np.uint64) for x in sets]
    got = simhash._local_roots(len(sets), simhash.similar_pairs(np.zeros(len(sets), np.int64), sets, 0.8))
    want = _brute_components({k: frozenset(x.tolist()) for k, x in enumerate(sets)}, lambda a, b: (not a and not b) or _near(a, b))
    assert got.tolist() == [want[k] for k in range(len(sets))]
    assert len(set(want.values())) < len(sets) - 5


def test_one_row_of_each_group_stays(spark):
    text = lambda k: " ".join(f"t{k}x{n}" for n in range(30))
    rows = [(1, text(0)), (2, text(0)), (2, text(1)), (2, text(1)), (3, text(2)), (3, text(3)), (None, text(4)), (None, text(4)), (None, text(5)), (9, text(5)), (None, text(6))]
    docs = spark.createDataFrame([(d, t, "en", "a", len(t)) for d, t in rows], SCHEMA)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    want = [(1, text(0)), (2, text(1)), (3, text(2)), (3, text(3)), (9, text(5)), (None, text(4)), (None, text(6))]
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted((str(d), t) for d, t in want)
