"""Fill-in-middle, audit of sources, pieces: library functions against brute force, on odd tables and at small limits."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from isohyet.llm import divergence, infill, mixing, pieces, simhash, sstable, tokens
from tests.llm.test_corpus import SCHEMA, _texts

MODEL = tokens.vocabulary_path("piece_bpe_32k.model")
UNITS = {"characters": re.compile(r"(?s)."), "words": re.compile(r"[^\x20\x09-\x0D]*[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+"), "lines": re.compile(r"[^\n]*\n|[^\n]+")}


def _rough(rng: random.Random, n: int) -> str:
    return "".join(rng.choice([" ", "\n", "\t", "a", "é", "日", "🙂", "ab ", "\x00"]) if rng.random() < 0.9 else chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(n))


def _units(text: str, unit: str) -> list[str]:
    return UNITS[unit].findall(text)


@pytest.mark.parametrize("unit", sorted(UNITS))
def test_ends_of_units(unit):
    rng = random.Random(5)
    for text in ["", " ", "\n", "a", " a", *(_rough(rng, rng.randrange(40)) for _ in range(400)), _rough(rng, 20_000)]:
        data, want = text.encode(), _units(text, unit)
        mask = infill.ends(data, unit)
        assert mask.bit_count() == len(want)
        lengths = np.cumsum([0, *(len(u.encode()) for u in want)])
        for k in {0, len(want), *(rng.randrange(len(want) + 1) for _ in range(5))}:
            assert infill.place(mask, len(data), k) == lengths[k]
    with pytest.raises(ValueError, match="no such unit"):
        infill.ends(b"x", "pages")


def test_forms(spark, tmp_path):
    rng = random.Random(6)
    form = infill.Form("«P»", "«S»", "«M»", cut_of_100=80, suffix_first_of_100=50, salt="x")
    rows = [(k, _rough(rng, rng.randrange(30)) + ("«M»" if k % 17 == 0 else ""), None, None, None) for k in range(300)] + [(None, "no id", None, None, None)] * 2 + [(3, None, None, None, None), (3, "", None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as n", "2 as form", "3 as output").repartition(3)
    for unit in UNITS:
        found = infill.transform(docs, unit, form)
        got = found.select("*", infill.restored(F.col("output"), F.col("form"), form).alias("back")).collect()
        assert Counter((r.doc_id, r.back) for r in got) == Counter((r[0], r[1] or "") for r in rows)
        names = Counter(r.form for r in got)
        assert names["psm"] > 50 and names["spm"] > 50 and names["plain"] > 30
        for r in got:
            assert r.n == len(_units(r.back, unit)) and (r.prefix_units is None) == (r.form == "plain")
            if r.form == "plain":
                assert r.output == r.back
            else:
                first, second = ("«P»", "«S»") if r.form == "psm" else ("«S»", "«P»")
                a, rest = r.output.removeprefix(first).split(second)
                b, middle = rest.split("«M»")
                prefix = a if r.form == "psm" else b
                assert prefix + middle == r.back[: len(prefix + middle)]
                assert len(_units(prefix, unit)) == r.prefix_units and len(_units(middle, unit)) == r.middle_units
    assert infill.transform(docs.limit(0)).count() == 0


def brute_audit(rows, least=30, top=50):
    """From rows lang, source, text: what the contract says, with whole numbers."""
    word = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, documents = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = word.findall((text or "").translate(lower))
        counts[lang or "", source or ""].update(found)
        documents[lang or ""].update(set(found))
    out = []
    for lang in documents:
        kept = sorted(t for t, n in documents[lang].items() if n >= least)
        sources = [s for x, s in counts if x == lang]

        def share(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p = {s: share(counts[lang, s]) for s in sources}
        q = share(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = [(x, sum(abs(p[s][t] - p[x][t]) for t in kept)) for x in sources if x != s]
            term = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:limit])]
    return sorted(out)


def test_audit(spark):
    rng = random.Random(8)
    rows = [(k, t, rng.choice([None, "en", "fr"]), rng.choice(["hot", "hot", "é", None, "B", "b", "a"]), 1) for k, t in enumerate(_texts(90, 9))]
    rows += [(1, None, "xx", "only", None), (1, "", "yy", "a", None), (2, "--- 1234", "yy", "b", None), (3, "word " * 9, "zz", None, None), (3, "ZZ zz\x00zz", "zz", "s", None)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as term", "2 as n", "3 as ordinal", "4 as chunk", "5 as value").repartition(4)
    want = brute_audit([(r[2], r[3], r[1]) for r in rows], 3, 7)
    assert {r[0] for r in want} >= {"", "en", "fr", "yy", "zz"}
    for limits in ({}, {"chunk_terms": 3, "block": 2}, {"chunk_terms": 10, "chunk_rows": 4, "block": 3}):
        found = divergence.audit(docs, 3, 7, **limits)
        assert sorted(map(tuple, found.collect())) == want, limits
    assert divergence.audit(docs.limit(0)).count() == 0


def test_shares_are_exact():
    counts = np.array([0, 1, 999, 10**12, 8 * 10**15], dtype=np.int64)
    for total, kept in ((int(counts.sum()), 5), (1, 1), (10**13, 3 * 10**8)):
        these = counts[counts <= total]
        assert divergence.shares(these, total, kept).tolist() == [1 + 10**9 * (int(c) + 5) // (total + 5 * kept) for c in these]


def test_terms_over_several_tallies(spark, monkeypatch):
    tally = divergence._Tally()
    tally.add(("en", "a"), "The the ÉÉ x9y".encode())
    tally.add(("en", "b"), b"")
    rows = [tuple(r.values()) for b in tally.flush() for r in b.to_pylist()]
    assert sorted(rows) == [("en", "a", b"", 0, 1), ("en", "a", b"the", 2, 1), ("en", "a", b"x", 1, 1), ("en", "a", b"y", 1, 1), ("en", "a", "ÉÉ".encode(), 1, 1), ("en", "b", b"", 0, 1)]
    assert not tally.by_group and not tally.held


def test_pieces_are_the_librarys():
    own, rng = pieces.codec(MODEL), random.Random(11)
    alphabet = [" ", "▁", "\n", "a", "the", "The", " of", "é", "́", "日", "本", "🙂", "\x00", "\t", "ing", "  ", "1", "<s>", "<0x41>", "﻿", "<unk>"]
    texts = ["", " ", "\n", "  a  b ", "▁▁▁" * 40, "日本語の文章" * 3000, *_texts(20)]
    texts += ["".join(rng.choice(alphabet) if rng.random() < 0.9 else chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(rng.randrange(14))) for _ in range(3000)]
    for text in texts:
        ids = own.library.encode(text, add_bos=True, add_eos=True)
        packed = own.encode(text)
        assert pieces._unpacked(packed) == ids, repr(text)
        assert own.decode(packed) == own.library.decode(ids), repr(text)
    own.check()
    own.memo.fresh.append(("the", pieces._packed([5])))
    with pytest.raises(ValueError, match="not the library's"):
        own.check()


def test_whole_texts_and_segments_merge_alike():
    """Segments are only a saving: merging a text as a whole gives the same ids."""
    own, rng = pieces.codec(MODEL), random.Random(12)
    for _ in range(300):
        text = own.library.normalize(_rough(rng, 60) + rng.choice(["", " the thing.", "a.b,c ...\"x", "1.2)(.", "(see [1].)", "..a.\n.b"]))
        assert "".join(own.merger.split(text)) == text
        assert own.merger.encode(text) == [i for s in own.merger.split(text) for i in own.merger.encode(s)]


def test_equal_scores_merge_from_the_left():
    merger = pieces.Merger({"a": (0.0, 0), "aa": (-1.0, 1), "ab": (-1.0, 2), "b": (0.0, 3), "aab": (-5.0, 4)}, list(range(100, 356)))
    assert merger.encode("aaab") == [1, 2] and merger.encode("aab") == [4] and merger.encode("aaa") == [1, 0] and merger.encode("c") == [199]


def test_pieces_of_tables(spark):
    rows = [(None, "no id", None, None, 1), (None, "no id", None, None, 1), (5, None, None, None, 1), (5, "", None, None, 1), (-7, " x \n\n y", None, None, 1)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as ids", "2 as n_tokens")
    found = pieces.decode(pieces.encode(docs, MODEL), MODEL).collect()
    library = pieces.codec(MODEL).library
    assert Counter((r.doc_id, r.text, tuple(pieces._unpacked(r.ids))) for r in found) == Counter((r[0], r[1] or "", tuple(library.encode(r[1] or "", add_bos=True, add_eos=True))) for r in rows)
    assert pieces.decode(pieces.encode(docs.limit(0), MODEL), MODEL).count() == 0


def test_large_buckets_go_by_their_own_bits(monkeypatch):
    """A bucket without a component: its pairs are found without comparing all, whatever its bits are."""
    rng = np.random.default_rng(21)
    monkeypatch.setattr(simhash, "LARGE", 100)
    for spread in (10, 20, 40, 64):
        fps = rng.integers(0, 1 << 63, size=(1500, 1), dtype=np.uint64) & np.uint64((1 << spread) - 1)
        if spread > 20:
            fps[700:] = fps[:800] ^ (np.uint64(1) << rng.integers(0, spread, size=(800, 1)).astype(np.uint64))
        fps = np.unique(fps, axis=0)
        roots = simhash._local_roots(len(fps), simhash.bucket_links(fps, np.zeros(len(fps), dtype=np.int64), 4))
        near = np.bitwise_count(fps[:, 0][:, None] ^ fps[:, 0][None, :]) <= 4
        assert np.array_equal(roots, simhash._local_roots(len(fps), [np.nonzero(near)]))


def test_large_buckets_take_about_linear_time(monkeypatch):
    rng, compared = np.random.default_rng(22), []
    within = simhash._within
    monkeypatch.setattr(simhash, "_within", lambda fps, planes, query, *more: compared.append(len(query)) or within(fps, planes, query, *more))
    counts = []
    for n in (10_000, 40_000):
        compared.clear()
        fps = rng.integers(0, 1 << 63, size=(n, 1), dtype=np.uint64) & np.uint64((1 << 48) - 1)
        assert sum(len(i) for i, _ in simhash.bucket_links(fps, np.zeros(n, dtype=np.int64), 4)) < n
        counts.append(sum(compared))
    assert counts[1] < 6 * counts[0] and counts[1] < 40_000 * 40  # blocks of 64; all pairs would be 25 million


def test_sets_that_share_half_a_hash_stay_apart(spark):
    rows = [(1, 7, 5), (2, 7, 5), (3, 7, 9), (4, 8, 9)]
    found = simhash.apart(spark.createDataFrame(rows, "doc_id long, node_id long, more long"))
    assert sorted((r.doc_id, r.node_id) for r in found.collect()) == [(1, 7), (2, 7), (3, 9), (4, 8)]
    one = spark.createDataFrame(rows[1:2], "doc_id long, node_id long, more long")
    assert simhash.apart(one) is one


def test_documents_of_one_mark_keep_their_own_copies(spark):
    docs = spark.createDataFrame([(1, "a", None, "s", 1), (2, "b", None, "s", 1), (None, "c", None, "s", 1)], SCHEMA)
    marks = {r.doc_id: r.m for r in docs.select("doc_id", mixing._mark().alias("m")).collect()}
    plan = spark.createDataFrame([(1, marks[1], [0, 1]), (2, marks[1], [0]), (2, marks[2], [1]), (None, marks[None], [0, 0, 1])], "doc_id long, mark long, shards array<int>")
    got = Counter(r.text for r in mixing.materialise(docs, plan).collect())
    assert got == {"a": 2, "b": 1, "c": 3}


def test_cuts_of_shards_are_bounded(spark, tmp_path):
    """Cuts come from a sample that follows the shards; one id of half the rows is cut by texts; rows stay in order."""
    rows = [(7 if k % 2 else None if k % 6 == 0 else k, f"text {k}", None, None, 1) for k in range(3000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(12)
    bounds = sstable.shard_bounds(docs, 12)
    assert len(bounds) == 11 and len(sstable.shard_bounds(docs, 1)) == 0 and len(sstable.shard_bounds(docs.limit(0), 12)) == 0
    assert (np.sort(bounds, order=["doc_id", "mark"]) == bounds).all() and (bounds["doc_id"] == 7).sum() >= 4
    vocabulary = tokens.vocabulary_path("word_bpe_49k.json")
    manifest = sstable.write_shards(docs, f"file://{tmp_path}", vocabulary)
    counts = [r.n_documents for r in manifest.collect()]
    assert sum(counts) == 3000 and max(counts) < 3 * 3000 / 12
    found = sstable.read_shards(manifest).orderBy("start").collect()
    ids = [-(1 << 63) if r.doc_id is None else r.doc_id for r in found]
    assert ids == sorted(ids) and Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1].tolist()]
